"""Validity-interval operators: overlap join, clipping, per-start dedupe,
segment closing and study-window clipping.

Scale notes
-----------
* ``overlap_join`` never compares all intervals of a large key with each other.
  A key with few right rows is joined as it is, each row once.  The intervals of
  other keys are cut into the nodes of a tree of days that cover them, and the
  sides meet on (key, node) where a cover holds the other's start, so each pair
  is produced once and a long interval is a dozen rows.  A hot key is split by
  time; AQE splits a hot (key, node) further, as the exchanges are the join's own.
* ``keep_latest`` is a top-1 per key with a partial (map-side) limit, so
  duplicate (key, start) rows are cut down before any shuffle.  Where
  ``close_segments`` follows, ``together`` before it brings all rows of a closing
  key to one place, and both windows share that one shuffle and one sort.
* ``close_segments`` is a ``lead`` per key.  After ``keep_latest`` a
  (key, start day) is unique, so a key holds at most one row per calendar
  day: about 36,500 in a century.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, IntegralType, StringType

OPEN_END = "9999-12-31"


#: A leaf of the tree of days holds ``LEAF_DAYS`` days, a node above ``FAN`` of the level below.
FAN, LEAF_DAYS = 4, 128
#: Keys with at most ``FEW`` right rows are not cut.  Which are, both sides know by the key's hash bucket.
FEW, BUCKETS = 64, 8192
#: The node of a row that is not cut.
UNCUT = -1


def _hashes_alike(kind) -> bool:
    return isinstance(kind, (IntegralType, DateType)) or kind == StringType()


def _covering(way: int) -> str:
    """The nodes that make up the leaves from _ovl_a to _ovl_b and share none: of leaves, their parents (whole
    ones from _ovl_p up to before _ovl_q) and grandparents (_ovl_r, _ovl_t), what no whole node above holds.
    A node's number is its place on its level, 8 times, and its level and ``way``."""
    def run(level: int, first: str, last: str) -> str:
        own = level + 4 * way
        return f"IF({first} < {last}, sequence({first} * 8 + {own}, ({last} - 1) * 8 + {own}, 8L), array())"

    edges = f"{run(0, '_ovl_a', f'_ovl_p * {FAN}')}, {run(0, f'_ovl_q * {FAN}', '(_ovl_b + 1)')}"
    upper = f"{run(1, '_ovl_p', f'_ovl_r * {FAN}')}, {run(1, f'_ovl_t * {FAN}', '_ovl_q')}, {run(2, '_ovl_r', '_ovl_t')}"
    return (f"CASE WHEN _ovl_b < _ovl_a THEN array() WHEN _ovl_p >= _ovl_q THEN {run(0, '_ovl_a', '(_ovl_b + 1)')} "
            f"WHEN _ovl_r >= _ovl_t THEN concat({edges}, {run(1, '_ovl_p', '_ovl_q')}) ELSE concat({edges}, {upper}) END")


def _above(way: int) -> str:
    """The leaf _ovl_a, its parent and its grandparent, numbered like the nodes of a cover."""
    return f"array({', '.join(f'_ovl_a div {FAN ** k} * 8 + {k + 4 * way}' for k in range(3))})"


def _noded(df: DataFrame, start: str, end: str, last: Column, days: int) -> DataFrame:
    """``df`` without null bounds, and the places of the interval in the tree (see ``_covering``).  Leaves
    after ``last`` are one."""
    leaf = lambda c: F.least(F.floor(F.datediff(F.col(c), F.to_date(F.lit("0001-01-01"))) / F.lit(days)), last + 1)
    # an interval that ends before it starts covers nothing
    ends = F.when(F.col(start) <= F.col(end), leaf(end)).otherwise(F.lit(-1).cast("bigint"))
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select("*", leaf(start).alias("_ovl_a"), ends.alias("_ovl_b"))
    return rows.selectExpr("*", f"(_ovl_a + {FAN - 1}) div {FAN} AS _ovl_p", f"(_ovl_b + 1) div {FAN} AS _ovl_q",
                           f"(_ovl_a + {FAN * FAN - 1}) div {FAN * FAN} AS _ovl_r", f"(_ovl_b + 1) div {FAN * FAN} AS _ovl_t")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str],
                 left_start: str, left_end: str, right_start: str, right_end: str,
                 bin_days: int = LEAF_DAYS) -> DataFrame:
    """Inner join of rows with equal ``keys`` whose inclusive date intervals
    overlap: ``right_start <= left_end and right_end >= left_start``.

    Column names other than ``keys`` must differ between the sides; the keys
    appear once in the output.  Rows with a null bound never match.

    A key with ``FEW`` right rows at most sends each row once, and a left row is
    compared with those few.  For other keys: the later start of a pair lies in the
    other's interval.  So each side sends the few nodes of a tree of days that cover
    its interval, and the nodes above its start, and a pair meets where one's cover
    holds the other's start: once, as a cover's nodes share no day.  ``bin_days`` is
    the size of a leaf.  Days after the right side's last start share a leaf, so open
    ends such as 9999-12-31 cost no more than others.  The last start and the
    ``BUCKETS`` flags that say which keys are cut are a scalar subquery of the same plan.
    """
    counted = right.dropna(subset=keys).groupBy(*keys).agg(F.max(right_start).alias("_ovl_s"), F.count(F.lit(1)).alias("_ovl_n"))
    # a hash must not depend on the side: other types of keys are all cut
    plain = all(left.schema[k].dataType == right.schema[k].dataType and _hashes_alike(left.schema[k].dataType) for k in keys)
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(BUCKETS)).cast("int")
    many = F.collect_set(F.when(F.col("_ovl_n") > FEW, bucket))
    seen = counted.agg(F.max("_ovl_s").alias("_ovl_s"), many.alias("_ovl_m"))
    flags = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.array_contains("_ovl_m", i))
    seen = seen.select(F.struct(F.col("_ovl_s").alias("start"), flags.alias("cut")).alias("_ovl")).scalar()
    cut = F.get(seen["cut"], bucket) if plain else F.lit(True)
    latest = F.datediff(seen["start"], F.to_date(F.lit("0001-01-01")))
    # without any right start there is no pair; any leaf will do
    last = F.coalesce(F.floor(latest / F.lit(bin_days)), F.lit(0).cast("bigint"))

    def sent(df: DataFrame, s: str, e: str, cover: int, node: str) -> DataFrame:
        # covers of one side meet starts of the other
        nodes = F.when(cut, F.expr(f"concat({_covering(cover)}, {_above(1 - cover)})")).otherwise(F.array(F.lit(UNCUT)))
        return _noded(df, s, e, last, bin_days).select(*df.columns, F.explode(nodes).alias(node))

    lb = sent(left, left_start, left_end, 0, "_ovl_l")
    rb = sent(right, right_start, right_end, 1, "_ovl_r")
    rb = rb.select(*[F.col(k).alias(f"_ovl_r_{k}") for k in keys], *[c for c in rb.columns if c not in keys])
    cond = [F.col(k) == F.col(f"_ovl_r_{k}") for k in keys]
    cond += [F.col("_ovl_l") == F.col("_ovl_r"),
             F.col(right_start) <= F.col(left_end), F.col(right_end) >= F.col(left_start),
             (F.col("_ovl_l") == UNCUT) | ((F.col(right_start) >= F.col(left_start)) == (F.col("_ovl_l").bitwiseAND(4) == 0))]
    joined = lb.join(rb, cond, "inner")
    return joined.drop("_ovl_l", "_ovl_r", *[f"_ovl_r_{k}" for k in keys])


def clip(left_start: str, left_end: str, right_start: str, right_end: str):
    """Intersection of two overlapping intervals: (later start, earlier end)."""
    return (F.greatest(F.col(left_start), F.col(right_start)),
            F.least(F.col(left_end), F.col(right_end)))


def keep_latest(df: DataFrame, keys: list[str], order_col: str,
                tie_break: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the largest ``order_col``.

    Ties go to the largest ``tie_break`` columns in order (nulls lowest); by
    default every other column, which makes the pick deterministic.

    Written as ``row_number() = 1``: Spark plans it as a partial
    WindowGroupLimit before the shuffle (a map-side top-1 per key and task)
    and a final one after it, so duplicates of a hot key are cut down before
    they are shuffled.
    """
    others = [c for c in df.columns if c not in keys and c != order_col]
    tie_break = list(tie_break) if tie_break is not None else others
    order = [F.col(c).desc_nulls_last() for c in [order_col, *tie_break]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_kl_rn", F.row_number().over(w))
            .filter(F.col("_kl_rn") == 1).drop("_kl_rn"))


def close_segments(df: DataFrame, keys: list[str], start: str, end_name: str = "end_date",
                   open_end: str = OPEN_END) -> DataFrame:
    """Set each row's end to the next start of the same key minus one day.

    The last row of a key ends one day before ``open_end``.  ``(keys, start)``
    must be unique (see ``keep_latest``).  Gaps between rows are filled and
    the old end is replaced.  Null keys are one key.
    """
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    end = F.date_add(F.coalesce(following, F.to_date(F.lit(open_end))), -1).alias(end_name)
    cols = [c for c in df.columns if c != end_name]
    pos = cols.index(start) + 1
    return df.select(*cols[:pos], end, *cols[pos:])


def study_window(segments: DataFrame, last_dates: DataFrame, key: str, study_start: str,
                 last_date_col: str = "date", start: str = "start_date",
                 end: str = "end_date") -> DataFrame:
    """Clip closed segments to a study window.

    * start becomes ``study_start`` when that day lies inside the segment;
    * end becomes the key's last date when that day lies inside the segment;
      both tests use the unclipped bounds;
    * segments ending before ``study_start`` are dropped;
    * keys without a last date are dropped (inner join).
    """
    first_day, last_day = F.to_date(F.lit(study_start)), F.col("_last")

    def inside(day: Column, bound: str) -> Column:
        return F.when((day >= F.col(start)) & (day <= F.col(end)), day).otherwise(F.col(bound))

    rows = segments.join(last_dates.select(key, F.col(last_date_col).alias("_last")), key)
    others = [c for c in segments.columns if c not in (key, start, end)]
    rows = rows.select(key, inside(first_day, start).alias("_s"), inside(last_day, end).alias("_e"), *others)
    return rows.where(F.col("_e") >= first_day).select(key, F.col("_s").alias(start), F.col("_e").alias(end), *others)


def last_date_per_key(df: DataFrame, key: str, date_col: str = "date", name: str = "date") -> DataFrame:
    """Latest date per key, as a date (partial + final aggregate)."""
    return df.groupBy(key).agg(F.max(F.col(date_col)).cast("date").alias(name))
