import datetime as dt

from pyspark.sql import functions as F

from strata.operators.codebook import Codebook
from strata.operators.intervals import close_segments, keep_latest
from strata.operators.packed import NULL, SEPARATOR, pack, together, unpack
from strata.plans.demographics import closed_segments, encoded_segments, latest_per_start
from test_overlap_few import _executed

D = dt.date
SCHEMA = "k int, a string, i int, b boolean, l bigint, d date, z string"


def _rows():
    texts = [None, "", " ", "7", "a,b", NULL, SEPARATOR, f"x{SEPARATOR}{NULL}y", "ü", "\\", "null"]
    return [(i % 3 if i % 5 else None, a, None if i % 2 else -i, [True, False, None][i % 3], 2 ** 40 + i, D(2020, 1, 1), z)
            for i, (a, z) in enumerate((a, z) for a in texts for z in texts)]


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_packed_columns_come_back(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    columns = ["a", "i", "b", "l", "z"]
    got = unpack(pack(df, columns), columns, df.schema).select(*df.columns)
    assert got.dtypes == df.dtypes and _sorted(got) == sorted(_rows(), key=repr)
    assert pack(df, columns).columns == ["k", "d", "_packed", "_packed_odd"]
    moved = together(df, ["k"], ["d"])
    assert moved.dtypes == df.dtypes and _sorted(moved) == sorted(_rows(), key=repr)


def test_segments_are_deduped_and_closed_in_one_shuffle(spark):
    book = Codebook.packaged()
    keys = [k.demographic_key.lower() for k in book.keys]
    rows = spark.range(500).select((F.col("id") % 7).alias("tv_respondent_id"), F.date_add(F.to_date(F.lit("2020-01-01")), (F.col("id") % 40).cast("int")).alias("start_date"),
                                   F.to_date(F.lit("2021-01-01")).alias("end_date"), *[F.when(F.col("id") % 3 > 0, (F.col("id") % 11).cast("string")).alias(k) for k in keys])
    plain = close_segments(keep_latest(rows, ["tv_respondent_id", "start_date"], "end_date"), ["tv_respondent_id"], "start_date", "end_date")
    closed = closed_segments(latest_per_start(rows))
    assert _sorted(closed) == _sorted(plain) and closed.columns == plain.columns
    got = encoded_segments(closed, book)
    got.collect()
    assert sum("ShuffleExchange" in n.getClass().getSimpleName() for n in _executed(got._jdf.queryExecution().executedPlan())) == 1
