"""API flight documents -> exploded records -> flat rows / date partitions.

The analogue: every order is a flight record, and API response pages hold up
to ``PAGE_SIZE`` records each (``data`` array).  A page is keyed by
``o_orderkey div PAGE_SIZE`` and order keys are unique, so a page never holds
more than ``PAGE_SIZE`` records: the packing step has a proven group bound.
Packing orders into pages, to explode them again, is what the analogue needs;
landed API documents are exploded as they are read, without that shuffle.
Record fields:

  flight_date        o_orderdate as yyyy-MM-dd
  flight_status      landed (F) / active (O) / scheduled (other)
  departure          {airport: o_orderpriority, timezone: UTC}
  arrival            {airport: CUST<custkey>, timezone: UTC, terminal: o_orderstatus,
                      gate: null for status P else G<orderkey mod 50>}
  airline            {name: o_orderpriority}
  flight             {number: text of o_orderkey}
  aircraft           null for status P, else {registration: N<custkey>}
  live               only for status O: {updated: flight_date, latitude: totalprice,
                      longitude: -totalprice, altitude: custkey, direction:
                      orderkey mod 360, speed_horizontal: 0.00, speed_vertical: 0,
                      is_ground: totalprice > 200000}
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.operators.nested import explode_records, flatten_flight, partitioned_records
from strata.plans.tables import Tables

PAGE_SIZE = 100


def flight_record(orders: DataFrame) -> DataFrame:
    o = F.col
    status = o("o_orderstatus")
    price = o("o_totalprice").cast("decimal(12,2)")
    return orders.select(
        (o("o_orderkey") / F.lit(PAGE_SIZE)).cast("long").alias("page"),
        F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("flight_date"),
            F.when(status == "F", "landed").when(status == "O", "active")
             .otherwise("scheduled").alias("flight_status"),
            F.struct(o("o_orderpriority").alias("airport"), F.lit("UTC").alias("timezone")).alias("departure"),
            F.struct(F.concat(F.lit("CUST"), o("o_custkey").cast("string")).alias("airport"),
                     F.lit("UTC").alias("timezone"), status.alias("terminal"),
                     F.when(status != "P", F.concat(F.lit("G"), (o("o_orderkey") % 50).cast("string")))
                      .alias("gate")).alias("arrival"),
            F.struct(o("o_orderpriority").alias("name")).alias("airline"),
            F.struct(o("o_orderkey").cast("string").alias("number")).alias("flight"),
            F.when(status != "P", F.struct(F.concat(F.lit("N"), o("o_custkey").cast("string"))
                                          .alias("registration"))).alias("aircraft"),
            F.when(status == "O", F.struct(
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated"),
                price.alias("latitude"), (-price).alias("longitude"),
                o("o_custkey").alias("altitude"), (o("o_orderkey") % 360).cast("int").alias("direction"),
                F.lit(0).cast("decimal(12,2)").alias("speed_horizontal"),
                F.lit(0).alias("speed_vertical"),
                (o("o_totalprice") > 200000).alias("is_ground"))).alias("live"),
        ).alias("record"))


def api_pages(t: Tables) -> DataFrame:
    """API response pages: ``(page, data array<record>)``, <= PAGE_SIZE per page."""
    rec = flight_record(t.orders)
    return rec.groupBy("page").agg(F.collect_list("record").alias("data"))


def explode_flatten(spark: SparkSession, sf: str) -> DataFrame:
    pages = api_pages(Tables(spark, sf))
    return flatten_flight(explode_records(pages, "data", "data"), "data")


def partition_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = partitioned_records(api_pages(Tables(spark, sf)))
    return rows.select("flight_dt", F.col("data.flight.number").alias("flight_number"),
                       F.col("data.flight_status").alias("flight_status"))


QUERIES = {
    "explode_flatten": explode_flatten,
    "partition_key": partition_key,
}

_REC = """
WITH r AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS flight_date,
         CASE o_orderstatus WHEN 'F' THEN 'landed' WHEN 'O' THEN 'active' ELSE 'scheduled' END AS flight_status,
         o.*, CAST(o_totalprice AS DECIMAL(12,2)) AS price
  FROM orders o)"""

ORACLE = {
    "explode_flatten": _REC + """
SELECT flight_date, flight_status, o_orderpriority AS DEPAIRPORT, 'UTC' AS DEPTIMEZONE,
       'CUST' || CAST(o_custkey AS VARCHAR) AS ARRAIRPORT, 'UTC' AS ARRTIMEZONE, o_orderstatus AS ARRTERMINAL,
       CASE WHEN o_orderstatus <> 'P' THEN 'G' || CAST(o_orderkey % 50 AS VARCHAR) END AS ARRGATE,
       o_orderpriority AS AIRLINENAME, CAST(o_orderkey AS VARCHAR) AS FLIGHTNUMBER,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'N' || CAST(o_custkey AS VARCHAR) END AS AIRCRAFTREGISTRATION,
       CASE WHEN o_orderstatus = 'O' THEN flight_date ELSE '' END AS LIVEUPDATED,
       CASE WHEN o_orderstatus = 'O' THEN CAST(price AS VARCHAR) ELSE '' END AS LATITUDE,
       CASE WHEN o_orderstatus = 'O' THEN CAST(-price AS VARCHAR) ELSE '' END AS LONGITUDE,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS ALTITUDE,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey % 360 AS VARCHAR) ELSE '' END AS DIRECTION,
       CASE WHEN o_orderstatus = 'O' THEN '0.00' ELSE '' END AS SPEEDHORIZONTAL,
       CASE WHEN o_orderstatus = 'O' THEN '0' ELSE '' END AS SPEEDVERTICAL,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice > 200000 AS VARCHAR) ELSE '' END AS ISGROUND
FROM r""",
    "partition_key": _REC + """
SELECT CAST(replace(flight_date, '-', '') AS INTEGER) AS flight_dt,
       CAST(o_orderkey AS VARCHAR) AS flight_number, flight_status FROM r""",
}
