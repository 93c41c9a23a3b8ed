"""Frequencies, ranking and distribution statistics.

Everything is a grouped aggregation (partial aggregation on the map side, so
hot keys are combined before the shuffle) or a top-k (TakeOrderedAndProject,
no global sort).  Scalars a statistic depends on (totals, min/max) are scalar
subqueries of the same plan, so building a plan starts no job.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F


# --------------------------------------------------------------------------- frequencies

def value_counts(df: DataFrame, column: str, name: str = "n", dropna: bool = True,
                 weight: str | None = None) -> DataFrame:
    """Frequency of each value, most frequent first (ties by value).

    ``dropna`` leaves out nulls, like a pandas frequency; a plain group count
    keeps null as a group.  ``weight`` sums a pre-aggregated count column
    instead of counting rows.
    """
    src = df.filter(F.col(column).isNotNull()) if dropna else df
    agg = F.sum(weight) if weight else F.count(F.lit(1))
    return (src.groupBy(column).agg(agg.cast("bigint").alias(name))
            .orderBy(F.col(name).desc(), F.col(column).asc_nulls_last()))


def with_share(counts: DataFrame, count_col: str = "n", name: str = "share") -> DataFrame:
    """Add each group's share of the total; null if that is null or zero.

    The input is an aggregated frequency table (one row per group).  The total
    is a scalar subquery, whose exchanges are those of the table itself.
    """
    total = F.nullif(counts.agg(F.sum(count_col).cast("double")).scalar(), F.lit(0.0))
    return counts.withColumn(name, F.col(count_col) / total)


def top_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Top ``n`` rows by an ordering; give a full tie-break for determinism."""
    return df.orderBy(*order).limit(n)


def top_values(df: DataFrame, column: str, k: int, name: str = "n", buckets: int = 1 << 16,
               tracked: int = 10_000) -> DataFrame:
    """The ``k`` most frequent values with their exact counts (ties by value), nulls left out.

    For columns of very many distinct values, where a full frequency table is
    one shuffled row a value.  A sketch of ``tracked`` items names ``k``
    candidates; these are counted exactly, and the least of their counts is a
    bound that no value of the result stays below.  Counts a hash bucket, at
    most ``buckets`` rows, rule out all values of a bucket whose total is below
    the bound; only values of the other buckets are counted one by one.

    The result is exact whatever the sketch finds: a bad candidate only lowers
    the bound, and fewer than ``k`` candidates drop it.  The pruning pays as
    long as the k-th count is above the rows of an average bucket.  The column
    is scanned four times; the plan is lazy.
    """
    src = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    items = src.agg(F.expr(f"approx_top_k(v, {int(k)}, {int(tracked)})")["item"].alias("items")).scalar()
    candidates = src.where(F.array_contains(items, F.col("v"))).groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    least = candidates.agg(F.when(F.count(F.lit(1)) >= k, F.min("c")).otherwise(0)).scalar()
    bucket = F.pmod(F.xxhash64("v"), F.lit(int(buckets)))
    totals = src.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("total"))
    # At most ``buckets`` rows of one number each.
    kept = F.broadcast(totals.where(F.col("total") >= least).select("b"))
    rows = src.withColumn("b", bucket).join(kept, "b", "left_semi")
    return (rows.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
            .orderBy(F.col("c").desc(), F.col("v").asc()).limit(k)
            .select(F.col("v").alias(column), F.col("c").alias(name)))


def rows_at_max(df: DataFrame, column: str) -> DataFrame:
    """All rows whose ``column`` equals the column maximum (ties kept); the
    maximum is a scalar subquery."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def mean(df: DataFrame, column: str, name: str = "mean", scale: int = 6) -> DataFrame:
    """Column mean, summed exactly as decimal and rounded (order-independent)."""
    return df.agg(F.round(F.avg(F.col(column).cast("decimal(20,4)")), scale)
                  .cast("double").alias(name))


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


# --------------------------------------------------------------------------- histogram

def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed.

    Output: one row per bin (empty bins included) with its edges and count.
    A constant column puts every value in the middle bin, as a plotting
    histogram centres a zero-width range on the value; without values all
    counts and edges are zero.
    """
    v = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias("span")).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")
    place = F.least(F.floor((v - lo) / F.nullif(hi - lo, F.lit(0.0)) * F.lit(bins)).cast("int"), F.lit(bins - 1))
    counts = (df.filter(v.isNotNull()).groupBy(F.when(hi == lo, bins // 2).otherwise(place).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    first = F.coalesce(F.when(hi == lo, lo - 0.5).otherwise(lo), F.lit(0.0))
    width = F.coalesce(F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo), F.lit(0.0)) / F.lit(float(bins))
    i = F.col("id").cast("double")
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), (first + i * width).alias("bin_lo"), (first + (i + 1) * width).alias("bin_hi"))
    # ``bins`` rows: a proven bound, so the edge table is broadcast.
    return (counts.join(F.broadcast(edges), "bin", "right")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


# --------------------------------------------------------------------------- box statistics

_PROBS = ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
#: Even steps that a sketch is asked for, and its accuracy (its ranks are off by 1 / accuracy at most).
STEPS, ACCURACY = 200, 4_000


def _sketched(pairs: DataFrame, by: list[str], weighted: bool) -> DataFrame:
    """Bounds of each group's quartiles, by a mergeable sketch: by, _w (all counts), and _lo and _hi, arrays
    of a value that is at most, and one that is at least, what the quartile interpolates between.

    A count is the sum of its binary digits: the values of each digit have a sketch of their own, whose
    ranks count as often as the digit says, so counts cost no repeated rows.  The sketches' steps, put
    in order, bound every rank to one step and twice the accuracy."""
    digit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(62)), lambda i: F.getbit(F.col("_c"), i) == 1)) if weighted else F.lit(0)
    even = F.expr(f"array({', '.join(f'{i / STEPS}D' for i in range(STEPS + 1))})")
    planes = pairs.select(*by, "_v", digit.alias("_d")).groupBy(*by, "_d").agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", even, ACCURACY).alias("_q"))
    worth = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_d"))  # what one value of the plane counts
    whole = Window.partitionBy(*by)
    points = planes.select(*by, (worth * F.col("_n")).alias("_w"), worth.alias("_unit"), F.posexplode("_q").alias("_j", "_v"))
    mass = F.when(F.col("_j") > 0, F.col("_w") / STEPS).otherwise(0.0)
    first = F.col("_j") == 0
    points = points.select(*by, "_v", mass.alias("_m"), F.when(first, F.col("_w")).alias("_w"), F.when(first, F.col("_unit")).alias("_unit"))
    points = points.groupBy(*by, "_v").agg(F.sum("_m").alias("_m"), F.sum("_w").alias("_w"), F.sum("_unit").alias("_unit"))
    upto = F.sum("_m").over(whole.orderBy("_v"))
    points = points.select(*by, "_v", upto.alias("_upto"), (upto - F.col("_m")).alias("_before"),
                           F.sum("_w").over(whole).alias("_w"), F.sum("_unit").over(whole).alias("_unit"))
    slack = F.col("_w") * (2.0 / ACCURACY) + F.col("_unit") * 2
    rank = lambda p: (F.col("_w") - 1) * F.lit(p)
    lows = [F.coalesce(F.max(F.when(F.col("_before") + F.col("_w") / STEPS + slack <= F.floor(rank(p)), F.col("_v"))), F.min("_v")) for p, _ in _PROBS]
    highs = [F.coalesce(F.min(F.when(F.col("_upto") - slack >= F.ceil(rank(p)) + 1, F.col("_v"))), F.max("_v")) for p, _ in _PROBS]
    return points.groupBy(*by).agg(F.max("_w").alias("_w"), F.array(*lows).alias("_lo"), F.array(*highs).alias("_hi"))


def _fences(q1: Column, q3: Column) -> tuple[Column, Column]:
    return q1 - F.lit(1.5) * (q3 - q1), q3 + F.lit(1.5) * (q3 - q1)


def _outlined(pairs: DataFrame, by: list[str], weighted: bool, fences: bool) -> DataFrame:
    """Each group's values, in full only where a quartile (or a fence) can lie: by, _at (the value, or null
    for a stretch between), _first and _last value, _c of them."""
    bounds = _sketched(pairs, by, weighted)
    if fences:
        lo, hi = F.col("_lo"), F.col("_hi")
        far = (F.abs(lo[0]) + F.abs(hi[2])) * 1e-9  # rounding of the interpolated quartiles
        low = (_fences(lo[0], hi[2])[0] - far, _fences(hi[0], lo[2])[0] + far)
        high = (_fences(hi[0], lo[2])[1] - far, _fences(lo[0], hi[2])[1] + far)
        bounds = bounds.select(*by, F.concat(lo, F.array(low[0], high[0])).alias("_lo"), F.concat(hi, F.array(low[1], high[1])).alias("_hi"))
    n = len(_PROBS) + 2 * fences
    within = F.expr(" OR ".join(f"(_v >= _lo[{k}] AND _v <= _hi[{k}])" for k in range(n)))
    stretch = F.expr(" + ".join(f"IF(_hi[{k}] < _v, 1D, 0D)" for k in range(n)))
    rows = pairs.join(bounds.select(*by, "_lo", "_hi"), by).select(*by, "_v", "_c", within.alias("_in"), F.when(within, F.col("_v")).otherwise(stretch).alias("_key"))
    rows = rows.groupBy(*by, "_in", "_key").agg(F.sum("_c").alias("_c"), F.min("_v").alias("_first"), F.max("_v").alias("_last"))
    return rows.select(*by, F.when(F.col("_in"), F.col("_key")).alias("_at"), "_first", "_last", "_c")


def _placed(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` (see ``_outlined``) and, on each, its group's n, min, max, q1, median and q3."""
    whole = Window.partitionBy(*by)
    upto = F.sum("_c").over(whole.orderBy("_first"))
    rows = rows.select("*", upto.alias("_upto"), F.sum("_c").over(whole).cast("bigint").alias("n"),
                       F.min("_first").over(whole).alias("min"), F.max("_last").over(whole).alias("max"))
    # the sketch's bounds are wide enough for every wanted value to stand alone; else the query must not go on
    alone = F.when(F.col("_at").isNotNull(), F.col("_at")).otherwise(F.raise_error("a quartile fell outside its sketch's bounds").cast("double"))

    def at(rank: Column) -> Column:
        here = (F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(here, alone)).over(whole)

    def quartile(p: float) -> Column:
        rank = (F.col("n") - 1) * F.lit(p)
        low, high = at(F.floor(rank)), at(F.ceil(rank))
        return low + (high - low) * (rank - F.floor(rank))

    return rows.select("*", *[quartile(p).alias(name) for p, name in _PROBS])


def quartiles(pairs: DataFrame, by: list[str], weighted: bool = True) -> DataFrame:
    """Exact quartiles of (by, _v, _c) pairs, the value and how often it counts: by, n, min, max, q1, median, q3.

    Two passes over the pairs.  The first makes a mergeable quantile sketch a group, which bounds each
    quartile; the second counts what lies between the bounds and keeps only the values within, about one
    in ``STEPS / 2`` each, however the values are spread.  Those alone are put in order."""
    names = ["n", "min", "max", *[name for _, name in _PROBS]]
    return _placed(_outlined(pairs, by, weighted, False), by).groupBy(*by).agg(*[F.max(c).alias(c) for c in names])


def box_stats(df: DataFrame, column: str, by: list[str] | None = None,
              approx: bool = False, accuracy: int = 100_000,
              weight: str | None = None) -> DataFrame:
    """Box-plot statistics per group.

    Quartiles interpolate linearly between order statistics.  Whiskers are the
    most extreme data within 1.5 IQR of the box; points beyond are outliers.

    Exact statistics take two passes, see ``quartiles``; the second also keeps
    what lies where a fence can be, so that whiskers and outliers need no third.
    ``weight`` names a count column when the input is (value, count) pairs.
    ``approx=True`` uses ``percentile_approx`` (unweighted rows only).
    """
    grouped = bool(by)
    by = list(by) if grouped else ["_g"]
    base = df if grouped else df.withColumn("_g", F.lit(0))
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    src = base.select(*by, F.col(column).cast("double").alias("_v"), w.alias("_c")).filter(F.col("_v").isNotNull() & (F.col("_c") > 0))
    if approx:
        if weight:
            raise ValueError("approximate quartiles take unweighted rows")
        probs = F.array(*[F.lit(p) for p, _ in _PROBS])
        quart = src.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"),
                                     F.percentile_approx("_v", probs, accuracy).alias("_q"))
        quart = quart.select(*by, "n", "min", "max", *[F.col("_q")[i].alias(name) for i, (_, name) in enumerate(_PROBS)])
        rows = src.join(quart, by).withColumn("_first", F.col("_v")).withColumn("_last", F.col("_v"))
    else:
        rows = _placed(_outlined(src, by, weight is not None, True), by)
    low, high = _fences(F.col("q1"), F.col("q3"))
    # a stretch lies on one side of each fence
    inside = (F.col("_first") >= low) & (F.col("_last") <= high)
    out = rows.withColumn("iqr", F.col("q3") - F.col("q1")).groupBy(*by, "n", "min", "q1", "median", "q3", "max", "iqr").agg(
        F.min(F.when(inside, F.col("_first"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_last"))).alias("whisker_hi"),
        F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).cast("bigint").alias("n_outliers"))
    return out if grouped else out.drop("_g")


# --------------------------------------------------------------------------- density

#: Bandwidths that a box is wide, moments that it keeps, and bandwidths beyond which it is not evaluated.
BOX, MOMENTS, REACH = 0.5, 14, 9.0


def density_grid(df: DataFrame, column: str, points: int = 1000) -> DataFrame:
    """Gaussian kernel density on an even grid, by a fast Gauss transform.

    Bandwidth: Scott's rule, ``n^(-1/5) * std`` (sample std).  Grid: ``points``
    values from min - range/2 to max + range/2.  Values fall into boxes of half a
    bandwidth; each box keeps the sums of the first ``MOMENTS`` powers of the
    values' places in it, one partially aggregated pass.  They are the
    coefficients of its kernels' sum in Hermite functions, which is evaluated at
    the grid points within ``REACH`` bandwidths: about ``REACH / BOX * points``
    evaluations, however many rows.  A kernel (1 at its peak) is off by less than
    1.09 * 0.25**14 / sqrt(14!) * 1.07 = 2e-14 by the terms left out, and by
    2.6e-18 by boxes out of reach.

    A column without two distinct values has no bandwidth: its grid has null
    densities, and without values null places as well.
    """
    values = df.select(F.col(column).cast("double").alias("_v")).where("_v IS NOT NULL")
    stats_ = values.agg(F.struct(F.count("_v").alias("n"), F.stddev_samp("_v").alias("sd"),
                                 F.min("_v").alias("lo"), F.max("_v").alias("hi")).alias("st")).scalar()
    lo, hi, n = F.col("_st.lo"), F.col("_st.hi"), F.col("_st.n").cast("double")
    bw = F.nullif(F.col("_st.sd") * F.pow(n, F.lit(-0.2)), F.lit(0.0))
    first, step = lo - (hi - lo) / 2, (hi - lo) * 2 / (points - 1)
    rows = values.select("_v", stats_.alias("_st")).withColumn("_bw", bw).where("_bw IS NOT NULL")
    rows = rows.withColumn("_box", F.floor((F.col("_v") - lo) / (F.col("_bw") * BOX)))
    centre = lo + (F.col("_box") + 0.5) * F.col("_bw") * BOX
    rows = rows.select("_box", "_st", "_bw", ((F.col("_v") - centre) / (F.col("_bw") * math.sqrt(2))).alias("_t"))
    power = [F.lit(1.0), F.col("_t")]
    for k in range(2, MOMENTS):
        power.append(power[k // 2] * power[k - k // 2])
    boxes = rows.groupBy("_box", "_st", "_bw").agg(F.array(*[F.sum(x) for x in power]).alias("_m"))

    # each box at the grid points in its reach
    boxes = boxes.select("_m", "_bw", first.alias("_first"), step.alias("_step"), centre.alias("_c"))
    near = [(F.col("_c") + sign * (REACH + BOX) * F.col("_bw") - F.col("_first")) / F.col("_step") for sign in (-1, 1)]
    reach = [F.greatest(F.ceil(near[0]), F.lit(0)), F.least(F.floor(near[1]), F.lit(points - 1))]
    at = boxes.select("*", F.explode(F.when(reach[0] <= reach[1], F.sequence(*reach))).alias("i"))
    y = (F.col("_first") + F.col("i") * F.col("_step") - F.col("_c")) / (F.col("_bw") * math.sqrt(2))
    at = at.select("i", "_m", y.alias("_y"))
    # Hermite functions by their recurrence: next = 2 y h - 2 n before
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("before"), F.exp(-F.col("_y") * F.col("_y")).alias("h"),
                    F.lit(0.0).alias("n"), F.lit(1.0).alias("f"))
    total = F.aggregate("_m", zero, lambda a, m: F.struct(
        (a["s"] + m / a["f"] * a["h"]).alias("s"), a["h"].alias("before"), (F.col("_y") * 2 * a["h"] - a["n"] * 2 * a["before"]).alias("h"),
        (a["n"] + 1).alias("n"), (a["f"] * (a["n"] + 1)).alias("f")), lambda a: a["s"])
    sums = at.groupBy("i").agg(F.sum(total).alias("_s"))

    grid = df.sparkSession.range(points).select(F.col("id").alias("i"), stats_.alias("_st"))
    grid = grid.select("i", (first + F.col("i").cast("double") * step).alias("x"), (1 / (n * bw * math.sqrt(2 * math.pi))).alias("_norm"))
    return grid.join(sums, "i", "left").select(F.col("i").cast("int").alias("i"), "x", (F.coalesce("_s", F.lit(0.0)) * F.col("_norm")).alias("density"))


# --------------------------------------------------------------------------- scatter

def xy_pairs(df: DataFrame, x, y, keep: list[str] | None = None, fraction: float | None = None,
             seed: int = 7) -> DataFrame:
    """The two columns of a scatter chart, with ``keep`` before them; ``fraction`` samples."""
    out = df.select(*(keep or []), x, y)
    return out.sample(fraction=fraction, seed=seed) if fraction else out
