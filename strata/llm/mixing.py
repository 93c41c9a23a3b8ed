"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  The tokens of the cells are raked: in turn,
the cells of each source, of each language and of each topic are scaled to that margin's target,
until all margins fit or a number of sweeps is done.  Targets that contradict each other (a source
that holds one language alone, with another share than that language) can't all be met: then the margin
raked last fits, the others come to lie between, and ``misfits`` says by how much.  A document's inclusion probability is its cell's raked tokens over its
tokens, scaled so that the largest is 1; a hash of the id decides, so a draw can be repeated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.llm.store import stored

DIMS = ("source", "lang", "topic")
#: Margins are pulled from the corpus' shares towards even ones: target share ~ share ** power.
POWER = {"source": 0.9, "lang": 0.9, "topic": 0.95}
#: Most sweeps over all margins, and the largest relative misfit of a margin that ends them sooner.
SWEEPS, TOLERANCE = 50, 1e-9
#: Value of a missing source or language.
MISSING = "(none)"

#: Topics by what a text holds; the first that fits.
TOPICS = (("license", r"(?i)licen[cs]e|copyright|all rights reserved"), ("contact", r"[^\s@]@[^\s@]+\.[a-z]|\d{3}[ -]\d{3,4}"),
          ("markup", r"[#*$%&|<>]{3}"), ("shouting", r"!!"))


def topic_of(text: Column) -> Column:
    """Stand-in topic where a table has none: by marks in the text, else ``prose``."""
    first = reduce(lambda rest, t: F.when(text.rlike(t[1]), t[0]).otherwise(rest), reversed(TOPICS), F.lit("prose"))
    return F.coalesce(first, F.lit("prose"))


def token_count(text: Column) -> Column:
    """Words of a text, one at least, as its weight."""
    return F.greatest(F.lit(1), F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))).cast("long")


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(dim, target): shares of the margin raised to ``power``, of 1 in all."""
    margin = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t")).withColumn("p", F.pow("t", F.lit(power)))
    return margin.select(dim, (F.col("p") / margin.agg(F.sum("p")).scalar()).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (the margins' columns and ``tokens``) with ``weight``, the raked share of each cell.

    ``targets`` has (dim, target) for each margin; values without a target get weight 0.  Each step is
    a map-side sum by one margin, joined back and written, as a plan that held several would double
    with every step.  A sweep over all margins that moves none by more than ``tolerance`` is the last;
    without such a sweep, the margin of the last of ``targets`` fits alone (see ``misfits``).
    """
    for dim, target in targets.items():
        cells = cells.join(target.withColumnRenamed("target", f"t_{dim}"), dim, "left")
    cells = stored(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    for _ in range(sweeps):
        off = 0.0
        for dim in targets:
            sums = cells.groupBy(dim).agg(F.sum("weight").alias("now"))
            ratio = F.coalesce(F.col(f"t_{dim}") / F.nullif("now", F.lit(0.0)), F.lit(0.0))
            seen = Observation()
            scaled = cells.join(sums, dim).withColumn("ratio", ratio).observe(seen, F.max(F.abs(F.when(F.col("ratio") > 0, F.col("ratio") - 1))).alias("off"))
            cells = stored(scaled.withColumn("weight", F.col("weight") * F.col("ratio")).drop("now", "ratio"), "cells")
            off = max(off, seen.get["off"] or 0.0)
        if off < tolerance:
            break
    return cells.drop(*[f"t_{d}" for d in targets])


def misfits(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """How well raked ``cells`` meet their targets: a row (margin, value, target, reached, misfit) for each
    value of a target or of the cells; ``misfit`` is reached - target, shares of all."""
    rows = []
    for dim, target in targets.items():
        reached = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("weight").alias("reached"))
        both = target.select(F.col(dim).alias("value"), "target").join(reached, "value", "full")
        got, want = F.coalesce("reached", F.lit(0.0)), F.coalesce("target", F.lit(0.0))
        rows.append(both.select(F.lit(dim).alias("margin"), F.col("value").cast("string").alias("value"), want.alias("target"),
                                got.alias("reached"), (got - want).alias("misfit")))
    return reduce(DataFrame.unionByName, rows)


def probabilities(cells: DataFrame) -> DataFrame:
    """``cells`` with ``prob``: raked over own tokens, the largest 1."""
    rate = cells.withColumn("rate", F.col("weight") / F.col("tokens"))
    return rate.withColumn("prob", F.col("rate") / rate.agg(F.max("rate")).scalar()).drop("rate")


def draw(doc_id: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    text = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(text, 1, 12), 16, 10).cast("double") / float(1 << 48)


def mix(docs: DataFrame, topic: Column | None = None, power: dict[str, float] = POWER, seed: int = 0, doc_id: str = "doc_id",
        text: str = "text", source: str = "source", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default), the document's ``mix_topic``, ``mix_tokens``, ``mix_prob`` and
    ``mix_kept``.

    A null source or language is the value ``(none)`` of its margin; a null or empty text weighs one
    token.  Rows with equal ids are kept or dropped together if they share a cell.  No rows give no
    rows.  Kept columns with the name of a new one are replaced.  What is fitted is one row a cell,
    summed on the map side, so a source that holds a third of all rows is one row as well.
    """
    new = ["mix_topic", "mix_tokens", "mix_prob", "mix_kept"]
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    body = docs[f"`{text}`"]
    value = lambda c: F.coalesce(docs[f"`{c}`"].cast("string"), F.lit(MISSING))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"), value(source).alias("source"), value(lang).alias("lang"),
                       (topic_of(body) if topic is None else topic).alias("topic"), token_count(body).alias("tokens"),
                       draw(docs[f"`{doc_id}`"], seed).alias("draw"))
    rows = stored(rows, "mixed-rows")  # topics and words are found once
    cells = stored(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "cells")
    fitted = probabilities(rake(cells, {d: tempered(cells, d, power[d]) for d in DIMS}))
    found = rows.join(fitted.select(*DIMS, "prob"), list(DIMS))
    return found.select(*[F.col("row").getField(c).alias(c) for c in names], F.col("topic").alias(new[0]), F.col("tokens").alias(new[1]),
                        F.col("prob").alias(new[2]), (F.col("draw") < F.col("prob")).alias(new[3]))
