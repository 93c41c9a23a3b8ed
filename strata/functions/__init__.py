"""Column-level helpers: everything here returns a ``Column`` built from
``pyspark.sql.functions``, so it stays inside whole-stage codegen."""

from strata.functions.casts import safe_int, text_or_empty
from strata.functions.text import (capitalize, title, repeat, concat_text, has_digit,
                                   first_digits, upper, lower)
from strata.functions.dates import date_from_parts, date_key, today_key, month_name
from strata.functions.ages import fine_age_band, coarse_age_band

__all__ = [
    "safe_int", "text_or_empty", "capitalize", "title", "repeat", "concat_text",
    "has_digit", "first_digits", "upper", "lower", "date_from_parts", "date_key", "today_key",
    "month_name", "fine_age_band", "coarse_age_band",
]
