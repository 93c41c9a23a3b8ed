"""Positional access to rows and columns.

Row positions need an explicit order.  Small ones come from a top-k: only the
first ``max(positions) + 1`` rows by that order are materialised.  Larger ones
are looked up among the positions of all rows, which ``with_positions`` finds
without passing the rows through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.sources.shared import written

#: Largest position that a top-k finds, as the rows before it pass through one task.
MAX_HEAD = 100_000
#: ``monotonically_increasing_id`` has the partition from this bit on and the row's place in it below.
PLACE_BITS = 33


def with_positions(df: DataFrame, order_by: list[Column | str], name: str = "position") -> DataFrame:
    """Every row with its 0-based position by ``order_by`` in column ``name``.

    The rows are range partitioned and sorted once, and written with their
    partition and place in it; a partition's first position is the sum of the
    sizes of those before it, from one small row a partition.  Rows that tie in
    ``order_by`` keep the order in which the input's partitions hold them, so a
    value that most rows hold is still dealt over many partitions.

    Writes to the shared folder when called.  Empty input gives no rows; a
    column called ``name`` is an error.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    tie, at = "_strata_tie", "_strata_at"
    placed = df.withColumn(tie, F.monotonically_increasing_id()).orderBy(*order_by, tie).drop(tie)
    placed = written(placed.withColumn(at, F.monotonically_increasing_id()), "positions")
    part = F.shiftright(at, PLACE_BITS)
    sizes = placed.groupBy(part.alias("_strata_part")).agg(F.count(F.lit(1)).alias("_strata_size"))
    before = Window.orderBy("_strata_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_strata_part", F.coalesce(F.sum("_strata_size").over(before), F.lit(0)).alias("_strata_start"))
    # One row a range partition: as many as shuffle partitions, whatever the input's size.
    rows = placed.join(F.broadcast(starts), part == F.col("_strata_part"))
    place = F.col(at).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.withColumn(name, F.col("_strata_start") + place).drop(at, "_strata_part", "_strata_start")


def rows_at_positions(df: DataFrame, positions: list[int], order_by: list[Column | str]) -> DataFrame:
    """Rows at 0-based ``positions`` by ``order_by``; those past the end give none.

    Positions to ``MAX_HEAD`` are a lazy top-k; with a larger one all rows are
    placed by ``with_positions``, which writes to the shared folder.
    """
    if not positions:
        return df.limit(0)
    if min(positions) < 0:
        raise ValueError("positions must not be negative")
    if max(positions) > MAX_HEAD:
        return with_positions(df, order_by, "_pos").filter(F.col("_pos").isin(*positions)).drop("_pos")
    head = df.orderBy(*order_by).limit(max(positions) + 1)
    # ``head`` holds at most max(positions)+1 rows, so this window is bounded.
    w = Window.orderBy(*order_by)
    return (head.withColumn("_pos", F.row_number().over(w) - 1)
            .filter(F.col("_pos").isin(*positions)).drop("_pos"))


def columns_by_position(df: DataFrame, start: int | None = None, stop: int | None = None,
                        indices: list[int] | None = None) -> DataFrame:
    cols = df.columns
    picked = [cols[i] for i in indices] if indices is not None else cols[start:stop]
    return df.select(*picked)
