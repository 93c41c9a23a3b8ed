"""Document fingerprints: SimHash over weighted terms, and a search by permuted block tables.

A term is a pair of neighbouring words (the word itself in a text of one word); its weight is
``1 + ln`` of its count.  Every term hash votes with its weight for each set bit and against each
clear one; the signs of the sums are the 64 bits.

Search: the bits are cut into ``BLOCKS`` blocks.  Two fingerprints within ``radius`` bits agree on
at least ``BLOCKS - radius`` blocks whole, so in the table that brings those blocks to the front
they share its key.  Each choice of blocks is a table; a candidate counts in its first table only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm import texts
from strata.llm.store import stored

#: Blocks of the fingerprint in a table search.
BLOCKS = 5
#: Query fingerprints of one key are compared in lists of about this many.
LIST = 256


def fingerprints_of(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """uint64 fingerprint of each text, zero without a word."""
    n = len(offs) - 1
    out = np.zeros(n, np.uint64)
    low = texts.LOWER[buf]
    starts, ends, at = texts.words(buf, offs)
    size = np.diff(at)
    doc = texts.owner(at)
    last = np.minimum(np.arange(len(starts)) + 1, at[1:][doc] - 1)
    head = (np.arange(len(starts)) < last) | (size[doc] == 1)
    if not head.any():
        return out
    word = texts.span_hash(texts.byte_hash(low), starts, ends)
    term = texts.mixed(word * np.uint64(3) + np.where(np.arange(len(word)) < last, word[last], 0))[head]
    doc = doc[head]
    order = np.argsort(texts.mixed(doc.astype(np.uint64) + np.uint64(1)) ^ term, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    term, doc = term[order], doc[order]
    new = np.r_[True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])]
    first = np.flatnonzero(new)
    weight = (1 + np.log(np.diff(np.r_[first, len(term)]))).astype(np.float32)
    term, doc = term[first], doc[first]
    heads = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    votes, step = np.zeros((len(heads), 64)), 1 << 14
    for a in range(0, len(term), step):  # bounded 64-column blocks
        b = min(a + step, len(term))
        lo, hi = np.searchsorted(heads, a, "right") - 1, np.searchsorted(heads, b)
        bits = np.unpackbits(term[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        bits -= 0.5
        bits *= weight[a:b, None]
        votes[lo:hi] += np.add.reduceat(bits, np.maximum(heads[lo:hi] - a, 0), axis=0)
    out[doc[heads]] = np.packbits(np.round(votes, 3) > 0, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cosine that the differing bits stand for, no less than 0; 1 for equal fingerprints."""
    return np.maximum(0.0, np.cos(np.pi * np.bitwise_count(x ^ y) / 64))


def fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``fp``, a long.  Null and empty texts have 0."""
    return texts.map_texts(docs, lambda buf, offs: [fingerprints_of(buf, offs).view(np.int64)],
                           [T.StructField("fp", T.LongType(), False)], text, docs.columns if keep is None else keep)


def _edits(kind: pa.DataType):
    """Rows in order of id to results; a part's first and last row also go on, for the seams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() if TaskContext.get() else 0
        left, first = None, True
        for batch in batches:
            for part in texts.chunks(batch, "text"):
                rows = [*zip(part.column(0).to_pylist(), part.column(1).fill_null("").to_pylist())]
                if first:
                    yield _seam(rows[0], number, "head", kind)
                    first = False
                rows = [left, *rows] if left else rows
                if len(rows) > 1:
                    yield _edited(rows[:-1], [t for _, t in rows[1:]], kind)
                left = rows[-1]
        if left:
            yield _seam(left, number, "tail", kind)

    return run


def _fp(rows: list[str]) -> np.ndarray:
    return fingerprints_of(*texts.buffers(pa.array(rows, pa.large_string())))


def _edited(rows: list[tuple], after: list[str], kind: pa.DataType) -> pa.RecordBatch:
    own = [t for _, t in rows]
    cut = [len(t) // 4 for t in own]
    new = [t[:len(t) - k] + nxt[:k] for t, nxt, k in zip(own, after, cut)]
    fps, edited = _fp([*own, after[-1]]), _fp(new)
    near_next = likeness(fps[:-1], fps[1:])
    n = len(rows)
    return pa.RecordBatch.from_arrays([
        pa.array([i for i, _ in rows], kind), pa.array([len(t) for t in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]), pa.array(fps[:-1].view(np.int64)),
        pa.array(edited.view(np.int64)), pa.array(likeness(fps[:-1], edited)), pa.array(near_next),
        pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], _NAMES)


def _seam(row: tuple, number: int, what: str, kind: pa.DataType) -> pa.RecordBatch:
    none = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array([row[0]], kind), *none, pa.array([what]), pa.array([number], pa.int64()),
                                       pa.array([row[1]], pa.string())], _NAMES)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next", "seam", "part", "text"]
_TYPES = ["long", "string", "long", "long", "double", "double", "string", "long", "string"]


def edit_stability(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, and likenesses.

    The edited text has its last ``floor(n / 4)`` code points replaced by the first as many of the
    next document in ascending ``doc_id`` (null ids first, equal ids by a hash of the text; after
    the last the first).  A single document is followed by itself.  Null texts are empty.

    The texts are range-partitioned by id once.  A part looks for the next text within itself; its
    first and last rows, one of each a part, meet their neighbours in a second small step.
    """
    kind = docs.schema[doc_id].dataType
    arrow = to_arrow_type(kind)
    schema = ", ".join(f"{n} {t}" for n, t in zip(_NAMES, [kind.simpleString(), *_TYPES]))
    rows = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), F.coalesce(docs[f"`{text}`"], F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    parts = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    done = stored(parts.mapInArrow(texts.tidy(_edits(arrow)), schema), "edits")

    seams = done.where("seam IS NOT NULL")
    heads = seams.where("seam = 'head'").select("part", F.col("text").alias("after"))
    order = heads.select("part").withColumn("next", F.lead("part").over(Window.orderBy("part")))  # one row a part
    order = order.withColumn("next", F.coalesce("next", F.min("part").over(Window.partitionBy())))
    tails = seams.where("seam = 'tail'").select("part", "doc_id", "text").join(order, "part")
    tails = tails.join(heads.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "after")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t, nxt in zip(*(c.to_pylist() for c in batch.columns)):
                yield _edited([(i, t)], [nxt], arrow)

    return done.where("seam IS NULL").unionByName(tails.mapInArrow(texts.tidy(close), schema)).drop("seam", "part", "text")


def _tables(fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(fp, other columns, table, key): one row for each choice of ``blocks - radius`` blocks."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    mask = [sum(1 << b for b in range(edge[i], edge[i + 1])) for i in range(blocks)]
    keys = []
    for chosen in combinations(range(blocks), blocks - radius):
        bits = sum(mask[i] for i in chosen)
        keys.append(F.col("fp").bitwiseAND(F.lit(bits - (1 << 64) if bits >> 63 else bits)))
    return fps.select("*", F.posexplode(F.array(*keys)).alias("table", "key"))


def near_counts(queries: DataFrame, fps: DataFrame, radius: int = 3, blocks: int = BLOCKS) -> DataFrame:
    """For each distinct ``fp`` of ``queries``, the rows of ``fps`` (``fp`` and multiplicity ``n``) within
    ``radius`` bits, itself included: (fp, n_near).

    Queries of a key are gathered in salted lists of about ``LIST``; the rows of a hot key meet each
    list, and a task hands on sums for the queries of its lists, never the pairs.
    """
    asked = _tables(queries.select("fp").distinct(), radius, blocks)
    much = asked.groupBy("table", "key").agg(F.ceil(F.count("*") / LIST).alias("lists"))
    lists = asked.join(much, ["table", "key"]).groupBy("table", "key", F.pmod(F.xxhash64("fp"), F.col("lists")).alias("list"))
    lists = lists.agg(F.collect_list("fp").alias("asked"))
    met = _tables(fps.select("fp", "n"), radius, blocks).join(lists, ["table", "key"]).select("table", "fp", "n", "asked")
    edge = [64 * i // blocks for i in range(blocks + 1)]
    mask = np.array([sum(1 << b for b in range(edge[i], edge[i + 1])) for i in range(blocks)], np.uint64)
    choices = [sum(1 << i for i in c) for c in combinations(range(blocks), blocks - radius)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            offs, flat = batch.column(3).offsets.to_numpy(), batch.column(3).values.to_numpy().view(np.uint64)
            offs, flat = offs - offs[0], flat[offs[0]:offs[-1]]
            row = np.repeat(np.arange(len(n)), np.diff(offs))
            differ = flat ^ batch.column(1).to_numpy().view(np.uint64)[row]
            same = sum((((differ & m) == 0).astype(np.int64) << i) for i, m in enumerate(mask))
            first = np.full(len(row), len(choices))
            for k in range(len(choices) - 1, -1, -1):
                first[(same & choices[k]) == choices[k]] = k
            hit = (np.bitwise_count(differ) <= radius) & (first == table[row])
            found, which = np.unique(flat[hit], return_inverse=True)
            total = np.bincount(which, n[row[hit]], len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(total)], ["fp", "n"])

    return met.mapInArrow(count, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n_near"))
