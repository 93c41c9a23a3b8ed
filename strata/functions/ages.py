"""Age band codes.

The bounds below are fixed values: they must equal the coding used by the
demographic feed.  Bands are inclusive.  A text age that is not an integer
gives null; ages under the first band give null.
"""

from pyspark.sql import Column, functions as F

from strata.functions.casts import safe_int

# Fine age code per inclusive band, then code for "above".
FINE_AGE_BANDS = [
    (2, 5, 19), (6, 8, 20), (9, 11, 21), (12, 14, 22), (15, 17, 23),
    (18, 18, 2), (19, 19, 3), (20, 20, 4), (21, 21, 5), (22, 24, 6),
    (25, 29, 7), (30, 34, 8), (35, 39, 9), (40, 44, 10), (45, 49, 11),
    (50, 54, 12), (55, 59, 13), (60, 64, 14), (65, 69, 15), (70, 74, 16),
    (75, 85, 17),
]
FINE_AGE_ABOVE = (85, 18)

# Coarse age code per inclusive band, then code for "above".
COARSE_AGE_BANDS = [
    (2, 17, 1), (18, 20, 2), (21, 24, 3), (25, 29, 4), (30, 34, 5),
    (35, 39, 6), (40, 44, 7), (45, 49, 8), (50, 54, 9), (55, 64, 10),
]
COARSE_AGE_ABOVE = (64, 11)


def _banded(age_text, bands, above, age_int=None) -> Column:
    """The code is looked up by the age itself, which costs the same for every band."""
    age = safe_int(age_text) if age_int is None else age_int
    codes = ["NULL"] * (above[0] + 1)
    for lo, hi, code in bands:
        codes[lo:hi + 1] = [str(code)] * (hi + 1 - lo)
    return F.when(age > above[0], F.lit(above[1])).otherwise(F.get(F.expr(f"array({', '.join(codes)})"), age))


def fine_age_band(age_text=None, age_int: Column | None = None) -> Column:
    """Fine age code of a text age (or of an already converted int age)."""
    return _banded(age_text, FINE_AGE_BANDS, FINE_AGE_ABOVE, age_int)


def coarse_age_band(age_text=None, age_int: Column | None = None) -> Column:
    return _banded(age_text, COARSE_AGE_BANDS, COARSE_AGE_ABOVE, age_int)
