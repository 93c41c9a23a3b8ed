"""Document-collection exploration over the driver tables.

* ``events`` rows are documents whose ``props`` JSON text parses to a nested
  struct (``props.k``): nested select and nested average.
* ``orders`` become documents with an array field: the sorted set of the
  return flags of their lines (``flags``).  Arrays are group keys (element
  order matters, null is a group) and are rendered as text for output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.operators.codebook import remap_by_table
from strata.plans.tables import Tables
from strata.sources.writers import row_count

PROPS_SCHEMA = "k int"
HAVING_MIN = 100
CODED_SIZE = 25


def event_documents(t: Tables) -> DataFrame:
    return t.events.select("event_id", "event_type", "user_id",
                           F.from_json("props", PROPS_SCHEMA).alias("props"))


def order_documents(t: Tables) -> DataFrame:
    """One document per order with an array field.  The per-order set holds
    at most the number of distinct flags, however many lines an order has."""
    flags = (t.lineitem.groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_set("l_returnflag")).alias("flags")))
    return t.orders.select("o_orderkey", "o_custkey").join(
        flags, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def array_text(c) -> F.Column:
    """``[a, b]`` rendering of an array; null elements print as ``null``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(c, ", ", "null"), F.lit("]")))


def nested_select(spark: SparkSession, sf: str) -> DataFrame:
    docs = event_documents(Tables(spark, sf))
    return docs.select("event_id", "event_type", F.col("props.k").alias("k"))


def nested_avg(spark: SparkSession, sf: str) -> DataFrame:
    docs = event_documents(Tables(spark, sf)).select("props.k")
    return docs.agg({"k": "avg"}).withColumnRenamed("avg(k)", "avg_k")


def struct_array_select(spark: SparkSession, sf: str) -> DataFrame:
    """A whole struct, an array and a nested field in one projection."""
    t = Tables(spark, sf)
    docs = order_documents(t).withColumn("customer", F.struct(F.col("o_custkey").alias("key"), (F.col("o_custkey") % 7).alias("group")))
    rows = docs.select("o_orderkey", "customer", "flags", "customer.group")
    return rows.select("o_orderkey", F.to_json("customer").alias("customer"), array_text("flags").alias("flags"), "group")


def remap_part_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Each order's part keys as an array, mapped by a codebook that is a table: the brands of the parts
    up to a size; other keys stay."""
    t = Tables(spark, sf)
    keys = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.col("l_partkey").cast("string"))).alias("codes"))
    brands = t.part.where(F.col("p_size") <= CODED_SIZE).select(F.col("p_partkey").cast("string").alias("code"), F.col("p_brand").alias("sequence"))
    return remap_by_table(keys, "codes", brands).select("l_orderkey", array_text("codes").alias("codes"))


def array_group_count(spark: SparkSession, sf: str) -> DataFrame:
    docs = order_documents(Tables(spark, sf))
    counts = docs.groupBy("flags").count()
    return counts.select(array_text("flags").alias("flags"), F.col("count").alias("n")) \
                 .orderBy(F.col("n").desc())


def sql_having(spark: SparkSession, sf: str) -> DataFrame:
    docs = order_documents(Tables(spark, sf))
    out = spark.sql("""
        select flags, count(o_orderkey) as count from {order_docs}
        group by flags having count > {least} order by count desc""", order_docs=docs, least=HAVING_MIN)
    return out.select(array_text("flags").alias("flags"), F.col("count").alias("n"))


def document_count(spark: SparkSession, sf: str) -> DataFrame:
    return row_count(event_documents(Tables(spark, sf)), "n")


QUERIES = {
    "nested_select": nested_select,
    "nested_avg": nested_avg,
    "struct_array_select": struct_array_select,
    "array_group_count": array_group_count,
    "remap_part_codes": remap_part_codes,
    "sql_having": sql_having,
    "document_count": document_count,
}

_FLAGS = """
WITH f AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS flags FROM lineitem GROUP BY l_orderkey),
d AS (SELECT o_orderkey, flags FROM orders LEFT JOIN f ON o_orderkey = l_orderkey)"""

ORACLE = {
    "nested_select": """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "nested_avg": """
SELECT avg(CAST(json_extract(props, '$.k') AS INTEGER)) AS avg_k FROM events""",
    "struct_array_select": _FLAGS.replace("SELECT o_orderkey, flags", "SELECT o_orderkey, o_custkey, flags") + """
SELECT o_orderkey, '{"key":' || o_custkey || ',"group":' || (o_custkey % 7) || '}' AS customer,
       CASE WHEN flags IS NOT NULL THEN '[' || array_to_string(flags, ', ') || ']' END AS flags, o_custkey % 7 AS "group"
FROM d""",
    "remap_part_codes": f"""
SELECT l_orderkey, '[' || string_agg(CASE WHEN p_size <= {CODED_SIZE} THEN p_brand ELSE l_partkey::VARCHAR END, ', '
       ORDER BY encode(l_partkey::VARCHAR)) || ']' AS codes
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "array_group_count": _FLAGS + """
SELECT CASE WHEN flags IS NOT NULL THEN '[' || array_to_string(flags, ', ') || ']' END AS flags,
       count(*) AS n FROM d GROUP BY d.flags""",
    "sql_having": _FLAGS + f"""
SELECT CASE WHEN flags IS NOT NULL THEN '[' || array_to_string(flags, ', ') || ']' END AS flags,
       count(o_orderkey) AS n FROM d GROUP BY d.flags HAVING count(o_orderkey) > {HAVING_MIN}""",
    "document_count": "SELECT count(*) AS n FROM events",
}
