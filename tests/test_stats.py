import math

import pytest
from pyspark.sql import functions as F

from strata.operators import stats
from strata.operators.frames import columns_by_position, rows_at_positions


def test_value_counts_excludes_null_and_orders_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("b",), ("c",)], "k string")
    assert [tuple(r) for r in stats.value_counts(df, "k").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert len(stats.value_counts(df, "k", dropna=False).collect()) == 4


def test_share_sums_to_one(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1)], "k string, n bigint")
    shares = {r.k: r.share for r in stats.with_share(df).collect()}
    assert shares == {"a": 0.75, "b": 0.25}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double")
    h = stats.histogram(df, "v", bins=10).orderBy("bin").collect()
    assert len(h) == 10 and sum(r.n for r in h) == 3
    assert h[-1].n == 1 and h[0].n == 1 and h[1].n == 1     # max lands in the last bin
    const = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    hc = stats.histogram(const, "v", bins=30).collect()
    assert sum(r.n for r in hc) == 2 and len(hc) == 30


def test_box_stats_interpolation_and_outlier(spark):
    df = spark.createDataFrame([(float(x),) for x in range(4)], "v double")
    r = stats.box_stats(df, "v").first()
    assert (r.q1, r.median, r.q3) == (0.75, 1.5, 2.25)
    df2 = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 100]], "v double")
    r2 = stats.box_stats(df2, "v").first()
    assert r2.n_outliers == 1 and r2.whisker_hi == 5.0 and r2.max == 100.0
    ra = stats.box_stats(df2, "v", approx=True).first()
    assert ra.n == 6


def test_box_stats_weighted_equals_rows(spark):
    rows = spark.createDataFrame([("g", 1.0), ("g", 1.0), ("g", 3.0), ("h", 2.0)], "g string, v double")
    pairs = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("w"))
    a = sorted(tuple(r) for r in stats.box_stats(rows, "v", by=["g"]).collect())
    b = sorted(tuple(r) for r in stats.box_stats(pairs, "v", by=["g"], weight="w").collect())
    assert a == b


def test_exact_quartiles_against_numpy(spark):
    import random

    import numpy as np
    rng = random.Random(11)
    groups = {"uniform": [rng.random() * 1e5 for _ in range(3001)], "skewed": [rng.lognormvariate(0, 4) for _ in range(2000)],
              "one": [5.0], "two": [1.0, 9.0], "same": [3.5] * 500, "tight": [1e9 + i * 1e-6 for i in range(300)] + [0.0],
              "ties": [float(rng.randrange(4)) for _ in range(1000)], "signed": [rng.gauss(0, 1) for _ in range(777)]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("none", None)], "g string, v double")
    got = {r.g: r for r in stats.box_stats(df, "v", by=["g"]).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        r = got[g]
        assert (r.n, r.min, r.max) == (len(vs), min(vs), max(vs))
        for have, want in zip((r.q1, r.median, r.q3), np.quantile(vs, [0.25, 0.5, 0.75])):
            assert math.isclose(have, want, rel_tol=1e-12), g


def test_box_plan_has_no_whole_group_percentile(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    plan = stats.box_stats(df, "v", by=["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan and plan.count("Range (") == 2  # mergeable sketches only, and two passes


def test_outlier_leaves_the_kept_values_few(spark):
    import numpy as np

    rows = spark.range(1_000_000).select(F.when(F.col("id") == 0, 1e12).otherwise((F.col("id") * 48271 % 99991).cast("double") + F.col("id") / 1e7).alias("v"))
    values = rows.toPandas().v.to_numpy()
    r = stats.box_stats(rows, "v").first()
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (r.q1, r.median, r.q3) == pytest.approx((q1, median, q3), rel=1e-14)
    assert r.max == 1e12 and r.n_outliers == 1 and r.whisker_hi == np.sort(values)[-2] and r.whisker_lo == values.min()
    pairs = rows.select(F.lit(0).alias("g"), F.col("v").alias("_v"), F.lit(1).cast("long").alias("_c"))
    kept = stats._outlined(pairs, ["g"], False, True)
    assert kept.count() < 40_000 and kept.agg(F.sum("_c")).first()[0] == 1_000_000


@pytest.mark.parametrize("seed", range(3))
def test_weighted_boxes_against_numpy(spark, seed):
    import random

    import numpy as np

    rng = random.Random(seed)
    rows = []
    for g in range(12):
        heavy = rng.choice([1, 5, 3000])
        draw = rng.choice([lambda: rng.gauss(0, 1), lambda: float(rng.randrange(9)), lambda: rng.lognormvariate(0, 3), lambda: -1e300 * rng.random()])
        rows += [(g, draw(), rng.randrange(0, heavy + 1)) for _ in range(rng.choice([1, 2, 3, 50, 700]))]
    df = spark.createDataFrame(rows, "g int, v double, w long").repartition(5)
    got = {r.g: r for r in stats.box_stats(df, "v", by=["g"], weight="w").collect()}
    for g in range(12):
        values = np.repeat([r[1] for r in rows if r[0] == g], [r[2] for r in rows if r[0] == g])
        if not len(values):
            assert g not in got
            continue
        r, quart = got[g], np.quantile(values, [0.25, 0.5, 0.75])
        assert r.n == len(values) and (r.q1, r.median, r.q3) == pytest.approx(tuple(quart), rel=1e-12, abs=1e-300)
        low, high = r.q1 - 1.5 * r.iqr, r.q3 + 1.5 * r.iqr
        inside = values[(values >= low) & (values <= high)]
        assert (r.whisker_lo, r.whisker_hi, r.n_outliers) == (inside.min(), inside.max(), len(values) - len(inside))


def test_share_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, n bigint")
    assert stats.with_share(empty).collect() == []
    zero = spark.createDataFrame([("a", 0), ("b", None)], "k string, n bigint")
    assert [r.share for r in stats.with_share(zero).collect()] == [None, None]


def test_histogram_without_values(spark):
    h = stats.histogram(spark.createDataFrame([(None,)], "v double"), "v", bins=4).collect()
    assert len(h) == 4 and {(r.bin_lo, r.bin_hi, r.n) for r in h} == {(0.0, 0.0, 0)}


def test_bounded_positions(spark):
    df = spark.range(5)
    assert rows_at_positions(df, [4, 7], ["id"]).collect()[0].id == 4
    with pytest.raises(ValueError):
        rows_at_positions(df, [-1], ["id"])
    assert [r.id for r in rows_at_positions(df, [3, 10**7], ["id"]).collect()] == [3]


def test_density(spark):
    const = stats.density_grid(spark.createDataFrame([(1.0,), (1.0,), (None,)], "v double"), "v", points=5).collect()
    assert [(r.x, r.density) for r in const] == [(1.0, None)] * 5
    none = stats.density_grid(spark.createDataFrame([], "v double"), "v", points=5).collect()
    assert [(r.x, r.density) for r in none] == [(None, None)] * 5
    import numpy as np
    data = np.array([0.0, 1.0, 1.0, 4.0])
    df = spark.createDataFrame([(float(x),) for x in data], "v double")
    d = stats.density_grid(df, "v", points=200).orderBy("i").collect()
    bw = data.std(ddof=1) * len(data) ** (-0.2)
    for r in d:
        want = np.exp(-0.5 * ((r.x - data) / bw) ** 2).sum() / (len(data) * bw * math.sqrt(2 * math.pi))
        assert math.isclose(r.density, want, rel_tol=1e-12)
    assert len(d) == 200 and d[0].x == -2.0 and math.isclose(d[-1].x, 6.0)


def test_density_of_continuous_and_far_values(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    for data in (rng.normal(size=4000), np.r_[rng.gamma(2, 3, 3000), 1e9], np.r_[-1e-12, 0, 1e-12]):
        df = spark.createDataFrame([(float(x),) for x in data], "v double")
        bw = data.std(ddof=1) * len(data) ** (-0.2)
        peak = 1 / (bw * math.sqrt(2 * math.pi))
        for r in stats.density_grid(df, "v", points=150).collect():
            want = np.exp(-0.5 * ((r.x - data) / bw) ** 2).sum() / (len(data) * bw * math.sqrt(2 * math.pi))
            assert abs(r.density - want) <= 2e-13 * peak, (r.x, r.density, want)


def test_rows_at_max_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0)], "id int, r double")
    assert sorted(r.id for r in stats.rows_at_max(df, "r").collect()) == [2, 3]


def test_positions(spark):
    df = spark.createDataFrame([(i, f"n{i}", i * 10, "x") for i in range(10)], "k int, a string, b int, c string")
    rows = rows_at_positions(df, [0, 2, 4], ["k"])
    assert [tuple(r) for r in columns_by_position(rows, 1, 3).orderBy("a").collect()] == \
        [("n0", 0), ("n2", 20), ("n4", 40)]
    assert columns_by_position(df, indices=[1]).columns == ["a"]
