"""SimHash near-duplicate groups by a Gray-order hierarchical index.

1. A fingerprint has 64 bits; a bit is 1 if more than half the XXH64 hashes of the text's word
   shingles (repeats included) set it.  Equal fingerprints fold into one row before anything else.
2. The distinct fingerprints are sorted by Gray rank (the place of the bit pattern in the reflected
   Gray code), so that neighbours differ in few bits, and cut into leaves of ``LEAF``.  A node holds
   the bits that all below it share, as a mask and the bits under it; ``FAN`` neighbouring nodes make
   a node of the next level, up to one root.
3. The index is joined with itself from the root downwards.  The shared bits in which two nodes
   differ are differences of every pair below them: beyond ``radius`` the whole pair of groups goes.
   Leaves that are left are compared bit by bit, and each pair of leaves hands on one spanning
   forest of its links, never all pairs.
4. Connected components of the links, by alternating large-star and small-star rounds.

Nodes have bounded size whatever the keys, so a third of all rows around one fingerprint is spread
over as many leaves as it needs.  Every level and round is a written table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import texts
from strata.llm.store import stored

LEAF, FAN = 128, 32
#: Nodes that one task groups into the next level (fixed, so every level is much smaller than the
#: last), and the most of a level that is broadcast: 4096 leaves of 128 longs are 4 MB.
NODES_A_TASK = 4096
#: Pairs of nodes that a task compares, where they are dealt out by number.
PAIRS_A_TASK = 1 << 15
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprints_of(buf: np.ndarray, offs: np.ndarray, shingle: int, seed: int = 42) -> np.ndarray:
    """uint64 fingerprint of each text: lower-cased A-Z, ``shingle`` words joined by one space."""
    starts, ends, at = texts.words(buf, offs)
    out = np.zeros(len(offs) - 1, np.uint64)
    if not len(starts):
        return out
    size = ends - starts
    placed = np.cumsum(size + 1) - size - 1
    plain = np.full(int(placed[-1] + size[-1]), 0x20, np.uint8)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    plain[inner + np.repeat(placed, size)] = texts.LOWER[buf[inner + np.repeat(starts, size)]]
    n_words = np.diff(at)
    n_hashes = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    cuts = np.r_[0, np.cumsum(n_hashes)]
    doc = texts.owner(cuts)
    first = at[:-1][doc] + np.arange(cuts[-1]) - cuts[:-1][doc]
    last = np.minimum(first + shingle, at[1:][doc]) - 1
    raw, digest = plain.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[s:e], seed) for s, e in zip(placed[first].tolist(), (placed[last] + size[last]).tolist())),
        np.uint64, len(first))
    some = n_hashes > 0
    ones = np.zeros((int(some.sum()), 64), np.int64)
    step = 1 << 15
    heads = cuts[:-1][some]
    for a in range(0, len(hashes), step):  # bounded 64-column blocks
        b = min(a + step, len(hashes))
        lo, hi = np.searchsorted(heads, a, "right") - 1, np.searchsorted(heads, b)
        bits = np.unpackbits(hashes[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[lo:hi] += np.add.reduceat(bits, np.maximum(heads[lo:hi] - a, 0), axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > n_hashes[some][:, None], axis=1, bitorder="little")
    out[some] = packed.view(np.uint64).ravel()
    return out


def simhash(docs: DataFrame, shingle: int = 3, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``fp``, the fingerprint as a signed long."""
    return texts.map_texts(
        docs, lambda buf, offs: [fingerprints_of(buf, offs, shingle).view(np.int64)],
        [T.StructField("fp", T.LongType(), False)], text, docs.columns if keep is None else keep)


def gray_rank(fp):
    """Place of the bits of a long in the reflected Gray code, as a long of the same order."""
    rank = fp
    for k in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, k))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


_KIDS = T.ArrayType(T.LongType(), False)
_NODE = T.StructType([T.StructField("node", T.LongType(), False), T.StructField("mask", T.LongType(), False),
                      T.StructField("bits", T.LongType(), False), T.StructField("kids", _KIDS, False),
                      T.StructField("masks", _KIDS, False), T.StructField("patterns", _KIDS, False)])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offs = np.r_[0, np.cumsum([len(x) for x in parts])].astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat.view(np.int64)))


def _group(size: int):
    """Cut each sorted partition into nodes of ``size`` rows of (id, mask, bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = np.zeros((0, 3), np.int64)
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40

        def made(block: np.ndarray, number: int) -> pa.RecordBatch:
            groups = [block[i:i + size].view(np.uint64) for i in range(0, len(block), size)]
            masks, bits = [], []
            for g in groups:
                shared = np.bitwise_and.reduce(g[:, 1]) & ~np.bitwise_or.reduce(g[:, 2] ^ g[0, 2])
                masks.append(shared)
                bits.append(g[0, 2] & shared)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + len(groups))), pa.array(np.array(masks, np.uint64).view(np.int64)),
                 pa.array(np.array(bits, np.uint64).view(np.int64)), *(_lists([g[:, i] for g in groups]) for i in range(3))],
                _NODE.names)

        for batch in batches:
            left = np.concatenate([left, np.stack([batch.column(i).to_numpy(False) for i in range(3)], 1)])
            whole = len(left) // size * size
            if whole:
                yield made(left[:whole], number)
                number += whole // size
                left = left[whole:]
        if len(left):
            yield made(left, number)

    return run


def _level(rows: DataFrame, order: str, size: int) -> DataFrame:
    return rows.sortWithinPartitions(order).select("node", "mask", "bits").mapInArrow(_group(size), _NODE)


def build_index(fps: DataFrame, leaf: int = LEAF, fan: int = FAN) -> list[tuple[DataFrame, int]]:
    """Levels of the index over distinct longs ``fp`` and their numbers of nodes, leaves first; the
    last level has one node at most."""
    rows = fps.select(F.col("fp").alias("node"), F.lit(-1).cast("long").alias("mask"), F.col("fp").alias("bits"))
    ranked = rows.withColumn("rank", gray_rank(F.col("node"))).repartitionByRange("rank")
    level = stored(_level(ranked, "rank", leaf), "gray-leaves")
    levels = [(level, level.count())]
    while levels[-1][1] > 1:
        nodes, tasks = level.select("node", "mask", "bits"), -(-levels[-1][1] // NODES_A_TASK)
        nodes = nodes.coalesce(1) if tasks == 1 else nodes.repartitionByRange(tasks, "node")
        level = stored(_level(nodes, "node", fan), "gray-nodes")
        levels.append((level, level.count()))
    return levels


def _columns(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(batch.schema.get_field_index(name))
    return column.offsets.to_numpy(), column.values.to_numpy(False).view(np.uint64)


def _descend(radius: int):
    """Pairs of nodes to those pairs of their children that can hold a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = (batch.column(0).to_numpy() == batch.column(1).to_numpy()).tolist()
            (ao, ak), (_, am), (_, ap), (bo, bk), (_, bm), (_, bp) = (
                _columns(batch, n) for n in ("kids_a", "masks_a", "patterns_a", "kids_b", "masks_b", "patterns_b"))
            out: list[list[np.ndarray]] = [[], []]
            for i, twin in enumerate(same):
                x, y = slice(ao[i], ao[i + 1]), slice(bo[i], bo[i + 1])
                near = np.bitwise_count((ap[x, None] ^ bp[None, y]) & am[x, None] & bm[None, y]) <= radius
                p, q = np.nonzero(np.triu(near) if twin else near)
                out[0].append(ak[x][p])
                out[1].append(bk[y][q])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in out], ["a", "b"])

    return run


def _compare(radius: int):
    """Pairs of leaves to a spanning forest of the links in them: (fingerprint, one it is linked to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = (batch.column(0).to_numpy() == batch.column(1).to_numpy()).tolist()
            (ao, ak), (bo, bk) = _columns(batch, "kids_a"), _columns(batch, "kids_b")
            out: list[list[np.ndarray]] = [[], []]
            for i, twin in enumerate(same):
                x, y = ak[ao[i]:ao[i + 1]], bk[bo[i]:bo[i + 1]]
                near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
                p, q = np.nonzero(np.triu(near, 1) if twin else near)
                if not len(p):
                    continue
                both = x if twin else np.concatenate([x, y])
                q = q if twin else q + len(x)
                head = np.arange(len(both))
                while True:  # smallest place within reach, at most as many rounds as the leaves have rows
                    low = np.minimum(head[p], head[q])
                    new = head.copy()
                    np.minimum.at(new, p, low)
                    np.minimum.at(new, q, low)
                    new = new[new]
                    if (new == head).all():
                        break
                    head = new
                moved = np.flatnonzero(head != np.arange(len(both)))
                out[0].append(both[moved])
                out[1].append(both[head[moved]])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in out], ["u", "v"])

    return run


def _with_nodes(pairs: DataFrame, level: DataFrame, n: int, names: list[str]) -> DataFrame:
    """Pairs with both nodes' lists.  ``NODES_A_TASK`` nodes take a few MB and are broadcast, to pairs
    dealt out evenly; beyond that neither side is, however well the pairs' file compresses."""
    if n <= NODES_A_TASK:
        pairs = pairs.repartition(-(-pairs.count() // PAIRS_A_TASK) or 1, "a", "b")
    for side in ("a", "b"):
        level_side = level.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in names])
        pairs = pairs.join(F.broadcast(level_side) if n <= NODES_A_TASK else level_side.hint("merge"), side)
    return pairs.select("a", "b", *[f"{c}_{side}" for side in "ab" for c in names])


def links(fps: DataFrame, radius: int = 2, leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """Links (u, v) that connect all fingerprints at ``radius`` or fewer differing bits, as spanning
    forests; ``fps`` has distinct longs ``fp``."""
    levels = build_index(fps, leaf, fan)
    pairs = levels[-1][0].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level, n in reversed(levels[1:]):
        wide = _with_nodes(pairs, level, n, ["kids", "masks", "patterns"])
        pairs = stored(wide.mapInArrow(_descend(radius), "a long, b long"), "gray-pairs")
    return stored(_with_nodes(pairs, *levels[0], ["kids"]).mapInArrow(_compare(radius), "u long, v long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(u, root): the smallest vertex that each vertex of ``edges`` (u, v) reaches, itself apart.

    Large-star hangs each larger neighbour of a vertex onto the smallest one, small-star the smaller
    ones; the rounds end when nothing changes, after about the logarithm of the longest path.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    state = None
    while True:
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        both = both.select("e.*")
        # joins with tables, not with aggregates, can be split at a vertex of very many links
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), "lowest")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = stored(large, "large-stars")
        low = stored(large.groupBy("u").agg(F.min("v").alias("low")), "lowest")
        hung = large.join(low, "u")  # what a vertex hangs on, and the smallest of that
        small = hung.select(F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
        seen = Observation()
        count = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")
        edges = stored(small.select("e.*").where("u != v").distinct().observe(seen, *count), "stars")
        now = seen.get
        if now == state:
            return edges.select("u", F.col("v").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, doc_id: str = "doc_id",
                    text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id`` (and ``keep``), ``fp`` (long) and ``component_id`` of every row.

    ``component_id`` is the smallest id among the documents that can be reached over links, itself
    included.  Null and empty texts have fingerprint zero and are linked like any other.  Repeated
    rows stay; a null id is larger than any other, so a component of null ids alone has a null one.
    No rows give no rows; other columns are ignored whatever their names.
    """
    cols = [doc_id, *[c for c in keep or [] if c != doc_id]]
    marked = stored(simhash(docs, shingle, text, cols), "fingerprints")
    own = marked.groupBy("fp").agg(F.min(F.col(f"`{doc_id}`")).alias("_least"))
    own = stored(own, "distinct-fingerprints")
    roots = components(links(own.select("fp"), radius))
    named = own.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("_least").alias("component_id"))
    of = named.join(least, "root").select("fp", "component_id")
    return marked.join(of, "fp").select(*[marked[f"`{c}`"] for c in marked.columns], "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each near-duplicate group, whole: that of the smallest id, of equal ids that of the
    least hash of id and text.  Ids that are null come last.

    Groups are found on ids and hashes alone; the rows themselves are moved once.
    """
    key = [F.xxhash64(docs[f"`{doc_id}`"], docs[f"`{text}`"]).alias("k1"), F.xxhash64(F.lit(7), docs[f"`{text}`"], docs[f"`{doc_id}`"]).alias("k2")]
    marked = near_duplicates(docs.select(docs[f"`{doc_id}`"].alias("id"), docs[f"`{text}`"].alias("text"), *key), shingle, radius, "id", "text", ["k1", "k2"])
    group = marked.select("k1", "k2", "id", F.struct(F.col("component_id").isNull(), "component_id").alias("group"))
    first = group.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "k1", "k2")).alias("first"))
    first = first.select("first.k1", "first.k2").distinct()
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *key)
    kept = rows.join(first, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("row").alias("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
