"""Sources and sinks over the driver tables: written to the shared folder by a sink, read back by the source.

These queries write while they are built.  What they return is what the files hold, so the oracle SQL, which never
sees the files, checks writer and reader together.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from strata.operators.frames import with_positions
from strata.plans.documents import PROPS_SCHEMA, array_text, order_documents
from strata.plans.sales import REVENUE_BONUS, YEAR
from strata.plans.tables import Tables
from strata.sources import files, writers
from strata.sources.bson import read_bson, write_bson
from strata.sources.shared import shared_path


@contextmanager
def catalog_table_at(spark: SparkSession, path: str, columns: str, partition_by: str | None = None):
    """A catalog table over a folder for the length of a block; the files stay."""
    name = f"strata_{uuid.uuid4().hex}"
    keys = f"PARTITIONED BY ({partition_by})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {keys} LOCATION '{path}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


# --------------------------------------------------------------------------- text files

def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """CSV with a header and a date column."""
    orders = Tables(spark, sf).orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"),
                                             "o_totalprice", "o_orderpriority")
    path = shared_path(spark, "csv")
    writers.write_csv(orders, path)
    return files.read_sales_csv(spark, path, orders.schema)


def ctrl_a_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Fields between bytes 0x01."""
    customers = Tables(spark, sf).customer.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment")
    path = shared_path(spark, "ctrl-a")
    writers.write_ctrl_a(customers, path)
    return files.read_ctrl_a(spark, path, customers.schema)


def quoted_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Fully quoted fields that hold quotes themselves: JSON text."""
    events = Tables(spark, sf).events.select("event_id", "event_type", "props")
    path = shared_path(spark, "quoted")
    writers.write_quoted_csv(events, path)
    return files.read_quoted_csv(spark, path, events.schema)


def plain_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Comma-separated fields by position."""
    parts = Tables(spark, sf).part.select("p_partkey", "p_brand", "p_size")
    path = shared_path(spark, "plain")
    writers.write_unquoted_csv(parts, path)
    return files.read_unquoted_csv(spark, path, parts.schema)


# --------------------------------------------------------------------------- documents

def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Nested documents as JSON lines, one array each."""
    docs = order_documents(Tables(spark, sf)).select("o_orderkey", F.struct(F.col("o_custkey").alias("key")).alias("customer"), "flags")
    path = shared_path(spark, "json")
    docs.write.json(path)
    back = files.read_json_documents(spark, path, docs.schema, multiline=False)
    return back.select("o_orderkey", F.col("customer.key").alias("customer"), array_text("flags").alias("flags"))


def document_collection(spark: SparkSession, sf: str) -> DataFrame:
    """Event documents appended to a dump and scanned by it: a nested field, times to the millisecond."""
    docs = Tables(spark, sf).events.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value",
                                           F.from_json("props", PROPS_SCHEMA).alias("props"))
    path = shared_path(spark, "collection")
    write_bson(docs, path)
    wanted = f"event_id long, event_type string, ts timestamp, value double, props struct<{PROPS_SCHEMA.replace(' ', ': ')}>"
    back = read_bson(spark, path, wanted)
    return back.select("event_id", "event_type", "value", F.col("props.k").alias("k"), F.unix_millis("ts").alias("ts_ms"))


# --------------------------------------------------------------------------- tables

def dynamic_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by year, then one year's partition written anew with a bonus; the other years stay."""
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    path = shared_path(spark, "dynamic")
    with catalog_table_at(spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, order_year INT", "order_year") as name:
        writers.overwrite_partitions(orders, name)
        again = orders.where(F.col("order_year") == YEAR).withColumn("o_totalprice", F.col("o_totalprice") + REVENUE_BONUS)
        writers.overwrite_partitions(again, name)
    return files.read_documents(spark, path, schema=StructType(orders.schema.fields))


def append_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders appended whole, open ones inserted by name without their priority, which becomes null."""
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = shared_path(spark, "append")
    writers.append_to(orders.where(F.col("o_orderstatus") == "F"), path)
    with catalog_table_at(spark, path, "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING") as name:
        writers.insert_by_name(orders.where(F.col("o_orderstatus") == "O").select("o_orderstatus", "o_orderkey"), name)
    return files.read_documents(spark, path, schema=orders.schema)


def order_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Every order's place by price, dearest first."""
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return with_positions(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


QUERIES = {
    "csv_round_trip": csv_round_trip,
    "ctrl_a_round_trip": ctrl_a_round_trip,
    "quoted_csv_round_trip": quoted_csv_round_trip,
    "plain_csv_round_trip": plain_csv_round_trip,
    "json_round_trip": json_round_trip,
    "document_collection": document_collection,
    "dynamic_overwrite": dynamic_overwrite,
    "append_by_name": append_by_name,
    "order_positions": order_positions,
}

ORACLE = {
    "csv_round_trip": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice, o_orderpriority FROM orders""",
    "ctrl_a_round_trip": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer""",
    "quoted_csv_round_trip": "SELECT event_id, event_type, props FROM events",
    "plain_csv_round_trip": "SELECT p_partkey, p_brand, p_size FROM part",
    "json_round_trip": """
WITH f AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS flags FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, o_custkey AS customer,
       CASE WHEN flags IS NOT NULL THEN '[' || array_to_string(flags, ', ') || ']' END AS flags
FROM orders LEFT JOIN f ON o_orderkey = l_orderkey""",
    "document_collection": """
SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k, epoch_us(ts) // 1000 AS ts_ms FROM events""",
    "dynamic_overwrite": f"""
SELECT o_orderkey, o_totalprice + CASE WHEN year(o_orderdate) = {YEAR} THEN {REVENUE_BONUS} ELSE 0 END AS o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders""",
    "append_by_name": """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "order_positions": """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position FROM orders""",
}
