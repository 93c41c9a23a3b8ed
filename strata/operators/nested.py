"""Nested records: explode arrays to rows and flatten nested structs.

Everything is a projection over the nested columns (no per-row Python);
Catalyst prunes the nested fields that are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType

from strata.functions.dates import date_key


def explode_records(df: DataFrame, array_col: str = "data", name: str | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """One row per array element.  Null and empty arrays give no rows."""
    return df.select(*(keep or []), F.explode(array_col).alias(name or array_col))


# Output columns of the flattened flight record, in order.
FLIGHT_COLUMNS = [
    "flight_date", "flight_status", "DEPAIRPORT", "DEPTIMEZONE", "ARRAIRPORT",
    "ARRTIMEZONE", "ARRTERMINAL", "ARRGATE", "AIRLINENAME", "FLIGHTNUMBER",
    "AIRCRAFTREGISTRATION", "LIVEUPDATED", "LATITUDE", "LONGITUDE", "ALTITUDE",
    "DIRECTION", "SPEEDHORIZONTAL", "SPEEDVERTICAL", "ISGROUND",
]

_LIVE_FIELDS = [
    ("LIVEUPDATED", "updated"), ("LATITUDE", "latitude"), ("LONGITUDE", "longitude"),
    ("ALTITUDE", "altitude"), ("DIRECTION", "direction"),
    ("SPEEDHORIZONTAL", "speed_horizontal"), ("SPEEDVERTICAL", "speed_vertical"),
    ("ISGROUND", "is_ground"),
]


def flatten_flight(df: DataFrame, record: str = "data", none_as_text: bool = False) -> DataFrame:
    """Nested flight record -> 19 flat columns.

    * scalar leaves are rendered as text; a null leaf stays SQL null
      (``none_as_text=True`` renders it as ``None``, and booleans as
      ``True``/``False``);
    * a missing ``aircraft`` object gives registration ``''``; a missing
      ``live`` object gives ``''`` for all eight live fields;
    * flight number and registration keep their type and may be null.
    """
    r = lambda path: F.col(f"{record}.{path}")

    ground = f"{record}.live.is_ground"
    is_boolean = isinstance(df.select(ground).schema[0].dataType, BooleanType)

    def text(c: Column, boolean: bool = False) -> Column:
        t = c.cast("string")
        if none_as_text and boolean:
            t = F.initcap(t)
        return F.coalesce(t, F.lit("None")) if none_as_text else t

    live = r("live")
    aircraft = r("aircraft")
    cols = [
        text(r("flight_date")).alias("flight_date"),
        text(r("flight_status")).alias("flight_status"),
        text(r("departure.airport")).alias("DEPAIRPORT"),
        text(r("departure.timezone")).alias("DEPTIMEZONE"),
        text(r("arrival.airport")).alias("ARRAIRPORT"),
        text(r("arrival.timezone")).alias("ARRTIMEZONE"),
        text(r("arrival.terminal")).alias("ARRTERMINAL"),
        text(r("arrival.gate")).alias("ARRGATE"),
        text(r("airline.name")).alias("AIRLINENAME"),
        r("flight.number").alias("FLIGHTNUMBER"),
        F.when(aircraft.isNull(), F.lit("")).otherwise(r("aircraft.registration"))
         .alias("AIRCRAFTREGISTRATION"),
    ]
    for out, field in _LIVE_FIELDS:
        cols.append(F.when(live.isNull(), F.lit("")).otherwise(
            text(r(f"live.{field}"), boolean=is_boolean and field == "is_ground")).alias(out))
    return df.select(*cols)


def partitioned_records(docs: DataFrame, array_col: str = "data", date_field: str = "flight_date",
                        key: str = "flight_dt") -> DataFrame:
    """Explode API documents to one record per row beside its date partition
    key: ``(key, record)``."""
    rec = explode_records(docs, array_col, "data")
    return rec.select(date_key(F.col(f"data.{date_field}")).alias(key), "data")
