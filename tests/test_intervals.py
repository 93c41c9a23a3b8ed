import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators.intervals import (FAN, LEAF_DAYS, _above, _covering, _noded, close_segments, keep_latest, overlap_join,
                                        study_window)

D = dt.date


def _pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_overlap_join_edges(spark):
    left = spark.createDataFrame([
        (1, "a", D(2020, 1, 1), D(2020, 1, 10)),   # touches right at 2020-01-10
        (1, "b", D(2020, 2, 1), D(2020, 2, 10)),   # one day before right 2
        (1, "c", D(2020, 3, 1), None),             # null end never matches
    ], "k int, lid string, ls date, le date")
    right = spark.createDataFrame([
        (1, "x", D(2020, 1, 10), D(2020, 1, 20)),
        (1, "y", D(2020, 2, 11), D(2020, 2, 20)),
        (1, "z", D(2020, 3, 5), D(2020, 3, 6)),
        (2, "w", D(2020, 1, 1), D(2020, 12, 31)),
    ], "k int, rid string, rs date, re date")
    out = overlap_join(left, right, ["k"], "ls", "le", "rs", "re", bin_days=7)
    assert _pairs(out.select("lid", "rid")) == [("a", "x")]


def _brute(left, right):
    out = []
    for k, lid, ls, le in left:
        for k2, rid, rs, re in right:
            if k == k2 and None not in (ls, le, rs, re) and rs <= le and re >= ls:
                out.append((lid, rid))
    return sorted(out)


def test_overlap_join_matches_brute_force_with_hot_key(spark):
    rng = random.Random(3)
    base = D(2015, 1, 1)

    def interval(max_len):
        s = base + dt.timedelta(days=rng.randrange(0, 2000))
        return s, s + dt.timedelta(days=rng.randrange(-3, max_len))  # some inverted

    left, right = [], []
    for i in range(400):
        k = 0 if i % 3 == 0 else rng.randrange(1, 20)  # key 0 holds a third of rows
        left.append((k, f"l{i}", *interval(90)))
    for i in range(200):
        k = 0 if i % 3 == 0 else rng.randrange(1, 20)
        s, e = interval(700)
        right.append((k, f"r{i}", s, D(9999, 12, 31) if i % 17 == 0 else e))
    ldf = spark.createDataFrame(left, "k int, lid string, ls date, le date")
    rdf = spark.createDataFrame(right, "k int, rid string, rs date, re date")
    for bins in (1, 31, 91):
        out = overlap_join(ldf, rdf, ["k"], "ls", "le", "rs", "re", bin_days=bins)
        assert _pairs(out.select("lid", "rid")) == _brute(left, right)


def test_long_open_and_one_day_intervals(spark):
    rng = random.Random(8)
    far = [D(1, 1, 1), D(1969, 12, 31), D(2013, 12, 30), D(2020, 2, 29), D(9999, 12, 31)]

    def interval():
        s = rng.choice([rng.choice(far), D(2013, 1, 1) + dt.timedelta(days=rng.randrange(4000))])
        e = rng.choice([s, s, D(9999, 12, 31), min(D(9999, 12, 31) - dt.timedelta(days=9000), s) + dt.timedelta(days=rng.randrange(9000)), rng.choice(far)])
        return s, e

    left = [(i % 3, f"l{i}", *interval()) for i in range(150)]
    right = [(i % 3, f"r{i}", *interval()) for i in range(150)]
    ldf = spark.createDataFrame(left, "k int, lid string, ls date, le date")
    rdf = spark.createDataFrame(right, "k int, rid string, rs date, re date")
    for days in (1, 64, 100_000):
        assert _pairs(overlap_join(ldf, rdf, ["k"], "ls", "le", "rs", "re", bin_days=days).select("lid", "rid")) == _brute(left, right)
    late = rdf.where("rs between '2013-01-01' and '2025-12-31' and re < '9000-01-01'")
    assert _pairs(overlap_join(ldf, late, ["k"], "ls", "le", "rs", "re").select("lid", "rid")) == _brute(left, [tuple(r) for r in late.collect()])
    assert overlap_join(ldf, rdf.limit(0), ["k"], "ls", "le", "rs", "re").collect() == []


def test_ten_years_are_a_dozen_nodes(spark):
    day = D(2011, 3, 5)
    rows = [(day, day), (day, day + dt.timedelta(3652)), (day, day - dt.timedelta(1)), (D(1, 1, 1), D(9999, 12, 31)), (day, day + dt.timedelta(700))]
    df = spark.createDataFrame(rows, "s date, e date")
    last = (D(2040, 1, 1) - D(1, 1, 1)).days // LEAF_DAYS
    leaf = lambda d: min((d - D(1, 1, 1)).days // LEAF_DAYS, last + 1)
    rows = _noded(df, "s", "e", F.lit(last).cast("long"), LEAF_DAYS).select("s", "e", F.expr(_covering(0)).alias("cover"), F.expr(_above(0)).alias("above"))
    holds = lambda n: range(n // 8 * FAN ** (n % 4), (n // 8 + 1) * FAN ** (n % 4))
    for r in rows.collect():
        leaves = sorted(x for n in r.cover for x in holds(n))
        assert leaves == (list(range(leaf(r.s), leaf(r.e) + 1)) if r.s <= r.e else [])
        assert len(r.cover) <= 14 or r.s == D(1, 1, 1)
        assert all(leaf(r.s) in holds(n) for n in r.above) and len(r.above) == 3


def test_dates_after_2013_are_split_by_time(spark):
    day = F.to_date(F.lit("2013-12-30"))
    left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("l"), F.date_add(day, F.col("id").cast("int")).alias("ls"))
    left = left.withColumn("le", F.date_add("ls", 60))
    right = left.select("k", F.col("l").alias("r"), F.col("ls").alias("rs"), F.col("le").alias("re"))
    out = overlap_join(left, right, ["k"], "ls", "le", "rs", "re")
    assert out.count() == sum(min(i + 60, 3999) - max(i - 60, 0) + 1 for i in range(4000))


def test_hot_key_and_bin_is_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") < 100_000, 0).otherwise(F.col("id") % 50)
        day = F.to_date(F.lit("2020-01-01"))
        left = spark.range(0, 110_000, 1, 8).select(hot.alias("k"), F.col("id").alias("l"), day.alias("ls"), F.date_add(day, 3).alias("le"))
        right = spark.range(50).select(F.col("id").alias("k"), day.alias("rs"), day.alias("re"))
        out = overlap_join(left, right, ["k"], "ls", "le", "rs", "re")
        done = out.agg(F.count("*").alias("n"), F.sum(F.xxhash64("l") % 1000).alias("s"))
        assert done.collect()[0].n == 110_000
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_close_segments_with_null_key_and_a_century_of_days(spark):
    rows = spark.createDataFrame([(None, D(2019, 12, 1)), (None, D(2020, 3, 1))], "k int, start_date date")
    got = close_segments(rows, ["k"], "start_date").orderBy("start_date").collect()
    assert [tuple(r) for r in got] == [(None, D(2019, 12, 1), D(2020, 2, 29)), (None, D(2020, 3, 1), D(9999, 12, 30))]
    days = spark.range(30_000).select(F.lit(1).alias("k"), F.date_add(F.to_date(F.lit("1930-01-01")), F.col("id").cast("int")).alias("start_date"))
    out = close_segments(days, ["k"], "start_date")
    assert out.where("end_date = start_date").count() == 29_999


def test_keep_latest_ties_are_deterministic(spark):
    rows = [(1, D(2020, 1, 1), D(2020, 1, 31), "b"), (1, D(2020, 1, 1), D(2020, 1, 31), "c"),
            (1, D(2020, 1, 1), D(2020, 1, 15), "z"), (2, D(2020, 1, 1), D(2020, 1, 2), None),
            (2, D(2020, 1, 1), D(2020, 1, 2), "a")]
    df = spark.createDataFrame(rows, "k int, s date, e date, v string")
    out = sorted(tuple(r) for r in keep_latest(df, ["k", "s"], "e").collect())
    assert out == [(1, D(2020, 1, 1), D(2020, 1, 31), "c"), (2, D(2020, 1, 1), D(2020, 1, 2), "a")]


def test_close_segments_fills_gaps_and_crosses_years(spark):
    rows = [(1, D(2019, 12, 30)), (1, D(2020, 1, 5)), (1, D(2024, 6, 1)),  # gap years
            (2, D(2021, 3, 3))]                                            # single segment
    df = spark.createDataFrame(rows, "k int, start_date date").withColumn("end_date", F.lit(None).cast("date"))
    out = sorted(tuple(r) for r in close_segments(df, ["k"], "start_date").collect())
    assert out == [(1, D(2019, 12, 30), D(2020, 1, 4)), (1, D(2020, 1, 5), D(2024, 5, 31)),
                   (1, D(2024, 6, 1), D(9999, 12, 30)), (2, D(2021, 3, 3), D(9999, 12, 30))]


def test_close_segments_random_vs_python(spark):
    rng = random.Random(5)
    rows = set()
    for _ in range(500):
        k = 0 if rng.random() < 0.4 else rng.randrange(1, 30)
        rows.add((k, D(2000, 1, 1) + dt.timedelta(days=rng.randrange(0, 8000))))
    rows = sorted(rows)
    df = spark.createDataFrame(rows, "k int, start_date date").withColumn("end_date", F.lit(None).cast("date"))
    got = sorted(tuple(r) for r in close_segments(df, ["k"], "start_date").collect())
    want = []
    for i, (k, s) in enumerate(rows):
        nxt = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == k else D(9999, 12, 31)
        want.append((k, s, nxt - dt.timedelta(days=1)))
    assert got == want
    # invariant: closed segments of a key do not overlap
    for (k1, s1, e1), (k2, s2, e2) in zip(got, got[1:]):
        if k1 == k2:
            assert e1 < s2


def test_study_window_rules(spark):
    seg = spark.createDataFrame([
        (1, D(2013, 1, 1), D(2013, 12, 1)),    # ends before study start: dropped
        (1, D(2013, 12, 2), D(2014, 6, 30)),   # contains study start and last weight date
        (1, D(2014, 7, 1), D(9999, 12, 30)),   # starts after last weight date: kept, unclipped
        (2, D(2014, 1, 1), D(2014, 2, 1)),     # respondent without weights: dropped
        (3, D(2014, 1, 1), D(2014, 2, 1)),     # null last weight date: end unclipped
    ], "id int, start_date date, end_date date")
    last = spark.createDataFrame([(1, D(2014, 3, 1)), (3, None)], "id int, date date")
    out = sorted(tuple(r) for r in study_window(seg, last, "id", "2013-12-30").collect())
    assert out == [(1, D(2013, 12, 30), D(2014, 3, 1)), (1, D(2014, 7, 1), D(9999, 12, 30)),
                   (3, D(2014, 1, 1), D(2014, 2, 1))]
