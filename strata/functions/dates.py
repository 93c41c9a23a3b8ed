"""Date helpers."""

from pyspark.sql import Column, functions as F

from strata.functions._col import col
from strata.functions.casts import safe_int


def month_name(c) -> Column:
    """Full English month name of a date (``May``)."""
    return F.date_format(col(c), "MMMM")


def date_from_parts(year, month_name_col, day) -> Column:
    """Date from a year, a full month name and a day of month; null if a part
    is null or there is no such day."""
    text = F.concat(col(year).cast("string"), F.lit("-"), col(month_name_col), F.lit("-"), col(day).cast("string"))
    return F.try_to_date(text, "yyyy-MMMM-d")


def date_key(c) -> Column:
    """``yyyy-MM-dd`` text -> int ``yyyymmdd``; null or malformed -> null."""
    return safe_int(F.regexp_replace(col(c).cast("string"), "-", ""))


def today_key() -> Column:
    return F.date_format(F.current_date(), "yyyyMMdd")
