"""Casts with the lenient text->int behaviour of the old non-ANSI cast.

Spark 4 runs with ANSI on: ``cast('2-5' as int)`` raises and ``try_cast('3.0'
as int)`` is null, where the old cast gave null and 3.  ``safe_int`` restores
the old result for every numeric-looking text: optional sign, digits, at most
one dot, surrounding blanks; anything else (``2-5``, ``1e2``, ``A``) is null.
Fractions truncate toward zero.
"""

from pyspark.sql import Column, functions as F

from strata.functions._col import col

NUMERIC_TEXT = r"^\s*[+-]?[0-9]*[.]?[0-9]*\s*$"
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def safe_int(c) -> Column:
    """Regex guards keep text that is not a number away from the casts: a
    failing cast is far slower than a pattern test.  Integer texts take the
    plain cast; the decimal round trip is only for fractions."""
    text = col(c).cast("string")
    return (F.when(text.rlike(INTEGER_TEXT), F.trim(text).try_cast("int"))
             .when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("decimal(38,18)").try_cast("int")))


def text_or_empty(c) -> Column:
    """Value as text, ``''`` when missing (a missing nested object renders empty)."""
    return F.coalesce(col(c).cast("string"), F.lit(""))
