import datetime as dt

from pyspark.sql import functions as F

from strata.functions import (capitalize, coarse_age_band, date_from_parts, date_key,
                              fine_age_band, has_digit, repeat, safe_int, title)


def _col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_safe_int_matches_lenient_cast(spark):
    values = [None, "", " ", "007", "3.0", "1.5", "1e2", "2-5", "A", " 42 ", "-7", "+3", "99999999999"]
    assert _col(spark, values, safe_int) == [None, None, None, 7, 3, 1, None, None, None, 42, -7, 3, None]


def test_capitalize_and_title(spark):
    assert _col(spark, ["jOE bLOGGS", "joe", ""], capitalize) == ["Joe bloggs", "Joe", ""]
    # initcap splits on blanks only: apostrophes and hyphens do not start words.
    assert _col(spark, ["they're a-b", "i love netherlands"], title) == ["They're A-b", "I Love Netherlands"]


def test_repeat_and_digit(spark):
    assert _col(spark, ["joe "], lambda c: repeat(c, 3)) == ["joe joe joe "]
    assert _col(spark, ["a1", "abc", None], has_digit) == [True, False, None]


def test_date_from_parts(spark):
    df = spark.createDataFrame([(2016, "May", 3), (2017, "December", 31)], "y int, m string, d int")
    out = [r[0] for r in df.select(date_from_parts("y", "m", "d")).collect()]
    assert out == [dt.date(2016, 5, 3), dt.date(2017, 12, 31)]


def test_date_from_missing_parts(spark):
    df = spark.createDataFrame([(2016, None, 3), (None, "May", 3), (2016, "May", None), (2016, "May", 40), (2016, "Mai", 3)], "y int, m string, d int")
    assert [r[0] for r in df.select(date_from_parts("y", "m", "d")).collect()] == [None] * 5


def test_date_key(spark):
    assert _col(spark, ["2020-11-02", None, "bad-date"], date_key) == [20201102, None, None]


def test_age_bands(spark):
    ages = ["1", "2", "17", "18", "24", "74", "75", "85", "86", "999", None, "abc"]
    fine = _col(spark, ages, lambda c: fine_age_band(c))
    coarse = _col(spark, ages, lambda c: coarse_age_band(c))
    assert fine == [None, 19, 23, 2, 6, 16, 17, 17, 18, 18, None, None]
    assert coarse == [None, 1, 1, 2, 3, 11, 11, 11, 11, 11, None, None]
