"""Element-wise text functions and positional row/column access.

``part.p_name`` (blank-separated words) and ``customer`` rows stand in for a
string matrix: column 1 is the second column, row positions follow the
primary key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions import capitalize, concat_text, lower, repeat, title, upper
from strata.operators.frames import columns_by_position, rows_at_positions
from strata.plans.tables import Tables

POSITIONS = [0, 2, 4]
REPEAT = 3


def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    p = Tables(spark, sf).part
    return p.select(
        "p_partkey",
        upper("p_name").alias("upper_name"),
        lower("p_brand").alias("lower_brand"),
        concat_text("p_name", F.lit(" "), "p_type").alias("name_type"),
        repeat(F.concat(F.col("p_brand"), F.lit(" ")), REPEAT).alias("brand_repeated"),
        capitalize("p_name").alias("capitalized"),
        title("p_name").alias("titled"))


def slice_by_position(spark: SparkSession, sf: str) -> DataFrame:
    c = Tables(spark, sf).customer
    rows = rows_at_positions(c, POSITIONS, [F.col("c_custkey")])
    return columns_by_position(rows, 1, 3)


def upper_column(spark: SparkSession, sf: str) -> DataFrame:
    c = columns_by_position(Tables(spark, sf).customer, indices=[1])
    return c.select(upper("c_name").alias("c_name_upper"))


QUERIES = {
    "text_functions": text_functions,
    "slice_by_position": slice_by_position,
    "upper_column": upper_column,
}

_POS = ", ".join(str(p) for p in POSITIONS)

ORACLE = {
    "text_functions": f"""
SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand,
       concat(p_name, ' ', p_type) AS name_type, repeat(p_brand || ' ', {REPEAT}) AS brand_repeated,
       upper(p_name[1]) || lower(p_name[2:]) AS capitalized,
       array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS titled
FROM part""",
    "slice_by_position": f"""
SELECT c_name, c_nationkey FROM (
  SELECT c_name, c_nationkey, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer)
WHERE pos IN ({_POS})""",
    "upper_column": "SELECT upper(c_name) AS c_name_upper FROM customer",
}
