"""Merkle manifest of a dataset by a nested-struct rollup.

Every row is a leaf, the digest of its fields.  Per group, leaves stand in ascending order; runs of
``FAN`` neighbours become their digest until one node remains, the group's subroot.  The subroots, in
order of the groups (null first), make a second tree of the same kind, whose last node is the root.

1. Leaves are written, sorted by range and numbered: each part's place in its group and the counts of
   the parts before it give the rank.
2. A rank's octal digits are its path.  They are grouped away one after the other, each time nesting
   the children as structs in their parent; ``LEVELS`` digits make a block of at most
   ``FAN ** LEVELS`` leaves, and all of them need one exchange by block.  Blocks are the next tier's
   nodes, until every group is one block.
3. From the top tier down, a block meets the path of siblings above it by a union and one grouping,
   and transforms and explodes hand every child its siblings and that path.  No join, no collected
   group beyond a block.

A block never grows with its group, so a group with most of the rows is only more blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.store import stored

FAN_BITS = 3
FAN = 1 << FAN_BITS
#: Digits of the rank that one block nests.
LEVELS = 3


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts laid end to end."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row's fields: each ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings, level by level, give."""
    return F.aggregate(proof, leaf, lambda at, step: digest(step["left"], at, step["right"]))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (stored; with a non-null text ``_g``) and ``rank`` from 0 and ``size`` among those of
    equal ``_g``, ascending by ``order``.  Rows that agree in all of ``order`` may stand either way."""
    keys = ["_g", *order, "_salt"]  # the salt spreads repeated rows over parts
    sorted_ = rows.withColumn("_salt", F.rand(11)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(sorted_.drop("_salt").withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    parts = placed.groupBy("_g", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("_g")
    before = F.sum("_n").over(group.orderBy("_part")) - F.col("_n")
    parts = parts.select(F.col("_g").alias("_pg"), "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(group).alias("size"))
    placed = placed.withColumn("_p", part)
    found = placed.join(parts, (placed["_g"] == parts["_pg"]) & (placed["_p"] == parts["_part"]))
    return found.withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_p", "_pg", "_part", "_shift")


def _rolled(nodes: DataFrame) -> DataFrame:
    """Blocks (_g, size, block, digest, kids) of nodes (_g, size, rank, digest, row): one digit of the
    rank after the other is grouped away.  A level that the group's size does not need hands on its only child."""
    block = F.shiftright("rank", FAN_BITS * LEVELS)
    rows = nodes.select("_g", "size", block.alias("block"), "rank", "digest", F.col("row").alias("kids")).repartition("_g", "block")
    for k in range(LEVELS):
        keys = ["_g", "size", "block"]
        if k < LEVELS - 1:
            rows, keys = rows.withColumn("_up", F.shiftright("rank", FAN_BITS)), [*keys, "_up"]
        kids = F.array_sort(F.collect_list(F.struct("rank", "digest", "kids")), lambda a, b: (a["rank"] - b["rank"]).cast("int"))
        rows = rows.groupBy(*keys).agg(kids.alias("kids"))
        joined = F.sha2(F.array_join(F.transform("kids", lambda x: x["digest"]), ""), 256)
        rows = rows.withColumn("digest", F.when(F.col("size") > FAN ** k, joined).otherwise(F.col("kids")[0]["digest"]))
        if k < LEVELS - 1:
            rows = rows.withColumnRenamed("_up", "rank")
    return rows


def _climbed(nodes: DataFrame) -> list[DataFrame]:
    """Tables of blocks, from the nodes' own tier to that where every group is one block."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    tiers = []
    while True:
        tiers.append(stored(_rolled(nodes), "blocks"))
        if most <= FAN ** LEVELS:
            return tiers
        most = -(-most // FAN ** LEVELS)
        size = F.ceil(F.col("size") / F.lit(FAN ** LEVELS)).cast("long")
        nodes = tiers[-1].select("_g", size.alias("size"), F.col("block").alias("rank"), "digest", F.lit(None).cast("int").alias("row"))


def _step(digests: str, i: Column) -> Column:
    every = F.col(digests)
    return F.struct(F.array_join(F.slice(every, F.lit(1), i), "").alias("left"),
                    F.array_join(F.slice(every, i + 2, F.lit(FAN)), "").alias("right"))


def _unrolled(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(_g, rank, digest, row, up) of the nodes in the blocks; ``above`` (_g, block, up) has what stands
    over each block, ``up`` with ``proof``, the siblings level by level, which the nodes' own come before."""
    down = F.struct("size", "kids").alias("down")
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    lower = blocks.select("_g", "block", down)
    both = lower.withColumn("up", none(above, "up")).unionByName(above.select("_g", "block", none(lower, "down"), "up"))
    met = both.groupBy("_g", "block").agg(F.first("down", ignorenulls=True).alias("down"), F.first("up", ignorenulls=True).alias("up"))
    rows = met.select("_g", "up", F.col("down.size").alias("size"), F.col("down.kids").alias("kids"))
    for k in reversed(range(LEVELS)):
        rows = rows.withColumn("_ds", F.transform("kids", lambda x: x["digest"]))
        # one child and its siblings a row
        each = F.transform("kids", lambda x, i: F.struct(x.alias("kid"), _step("_ds", i).alias("step")))
        rows = rows.select("_g", "size", "up", F.explode(each).alias("_x"))
        proof = F.when(F.col("size") > FAN ** k, F.concat(F.array("_x.step"), "up.proof")).otherwise(F.col("up.proof"))
        rows = rows.select("_g", "size", F.col("up").withField("proof", proof).alias("up"),
                           F.col("_x.kid.rank").alias("rank"), F.col("_x.kid.digest").alias("digest"), F.col("_x.kid.kids").alias("kids"))
    return rows.select("_g", "rank", "digest", F.col("kids").alias("row"), "up")


def _proved(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """All nodes of the first tier with what stands over them; ``above`` (_g, up) is over each group's last block."""
    above = above.select("_g", F.lit(0).cast("long").alias("block"), "up")
    for blocks in reversed(tiers[1:]):
        above = _unrolled(blocks, above).select("_g", F.col("rank").alias("block"), "up")
    return _unrolled(tiers[0], above)


def manifest(docs: DataFrame, fields: list[str], group: str = "lang", order: str = "doc_id",
             keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``leaf``, ``subroot``, ``root`` and ``proof``: for each level
    from the leaf to the root, the digests of the run's nodes to the left and to the right as two texts.

    Leaves digest ``fields`` in their order (a null is ``-``).  Rows of a group ascend by ``order``, nulls
    first, and rows of equal order by their leaf; repeated rows are leaves each.  A null group is one of
    its own and comes first; an empty text is a field like any other, however long one may be.  A group
    of one row has its leaf as subroot, a table of one group its subroot as root.  An empty table gives
    no rows.  A kept column with the name of a new one (all in lower case) is replaced by it.
    """
    new = ("leaf", "subroot", "root", "proof")
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    key = docs[f"`{group}`"].cast("string")
    own = F.struct(F.lit(1).alias("_"), *[docs[f"`{c}`"] for c in names])
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), key), F.lit("")).alias("_g"), docs[f"`{order}`"].alias("_order"),
                         leaf_digest(*[docs[f"`{c}`"] for c in fields]).alias("digest"), own.alias("row"))
    tiers = _climbed(_ranked(stored(leaves, "leaves"), ["_order", "digest"]))

    subroots = tiers[-1].select(F.lit("").alias("_g"), F.col("_g").alias("_order"), "digest", F.col("_g").alias("row"))
    top = _climbed(_ranked(stored(subroots, "subroots"), ["_order"]))
    # one row, the root itself, over the tree of subroots
    root = top[-1].select("_g", F.struct(F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("proof")).alias("up"))
    over = _proved(top, root)
    over = over.select(F.col("row").alias("_g"), F.struct(F.col("digest").alias("subroot"), "up.root", "up.proof").alias("up"))
    found = _proved(tiers, over)
    return found.select(*[F.col("row").getField(c).alias(c) for c in names], F.col("digest").alias("leaf"), "up.subroot", "up.root", "up.proof")
