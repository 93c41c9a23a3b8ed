"""String helpers (element-wise, JVM side)."""

from pyspark.sql import Column, functions as F

from strata.functions._col import col


def upper(c) -> Column:
    return F.upper(col(c))


def lower(c) -> Column:
    return F.lower(col(c))


def capitalize(c) -> Column:
    """First character upper case, the rest lower case."""
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.lit(2147483647))))


def title(c) -> Column:
    """Title case per blank-separated word (``initcap``).

    Differs from a letter-run title case on apostrophes and hyphens:
    ``they're a-b`` -> ``They're A-b`` here.
    """
    return F.initcap(col(c))


def repeat(c, n: int) -> Column:
    return F.repeat(col(c), n)


def concat_text(*cols) -> Column:
    return F.concat(*[col(c) for c in cols])


def has_digit(c) -> Column:
    """True when the text holds at least one digit."""
    return col(c).cast("string").rlike("[0-9]")


def first_digits(c) -> Column:
    """The first run of digits, ``''`` without one."""
    return F.regexp_extract(col(c).cast("string"), "[0-9]+", 0)
