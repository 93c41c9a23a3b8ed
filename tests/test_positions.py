import random
import re
import threading

import pytest
from pyspark.sql import functions as F

from strata.operators.frames import rows_at_positions, with_positions
from strata.operators.stats import top_values
from strata.sources.writers import overwrite_partitions


def _frequent(values, k):
    counts = {}
    for v in values:
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
    return sorted(counts.items(), key=lambda p: (-p[1], p[0]))[:k]


@pytest.mark.parametrize("buckets,tracked", [(1 << 16, 10_000), (7, 16), (1, 8)])
def test_top_values_equal_a_full_count(spark, buckets, tracked):
    r = random.Random(5)
    values = [r.randrange(3000) for _ in range(6000)] + [7] * 900 + [11] * 900 + [2999] * 40 + [None] * 5000
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(6)
    got = [tuple(x) for x in top_values(df, "v", 4, buckets=buckets, tracked=tracked).collect()]
    assert got == _frequent(values, 4)


def test_top_values_of_few_or_no_values_and_of_text(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("",)], "`t` string")
    assert [tuple(x) for x in top_values(df, "t", 10).collect()] == [("b", 2), ("", 1), ("a", 1)]
    assert top_values(df.where("false"), "t", 3).collect() == []
    assert top_values(df.where("t is null"), "t", 3).collect() == []


def test_top_values_counts_few_values_one_by_one(spark, capsys):
    """Distinct values beside a few hot ones: what is shuffled does not follow the distinct count."""
    ids = spark.range(200_000, numPartitions=4).select(F.when(F.col("id") % 10 < 3, F.col("id") % 3).otherwise(F.col("id") + 100).alias("v"))
    out = top_values(ids, "v", 3)
    assert [tuple(r) for r in out.collect()] == [(0, 20_000), (1, 20_000), (2, 20_000)]
    capsys.readouterr()
    out.explain("formatted")
    # the first stage shown is the last exchange: the hot values and those that share their buckets, a task
    left = re.search(r"ShuffleQueryStage[^\n]*rowCount=([0-9.E+]+)\)", capsys.readouterr().out).group(1)
    assert float(left) < 1000


def test_positions_of_all_rows_with_hot_ties(spark):
    df = spark.range(30_000, numPartitions=5).select("id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("k"),
                                                     F.lit("x").alias("a.b"))
    out = with_positions(df, [F.col("k").desc()])
    assert out.columns == ["id", "k", "a.b", "position"]
    rows = out.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(30_000))
    keys = [r.k for r in rows]
    assert keys == sorted(keys, reverse=True)
    # the value that a third of the rows hold lies in more than one partition's range of ids, still in input order
    hot = [r.id for r in rows if r.k == 1]
    assert hot == sorted(hot)


def test_positions_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([(None,), (2,), (None,), (1,)], "v int")
    got = [(r.v, r.position) for r in with_positions(df, [F.col("v").asc_nulls_last()]).orderBy("position").collect()]
    assert got == [(1, 0), (2, 1), (None, 2), (None, 3)]
    assert with_positions(df.where("false"), ["v"]).collect() == []
    with pytest.raises(ValueError):
        with_positions(df, ["v"], name="v")


def test_rows_far_beyond_a_head(spark):
    df = spark.range(150_000).select((F.lit(149_999) - F.col("id")).alias("id"))
    got = rows_at_positions(df, [0, 149_999, 120_000, 200_000], ["id"]).collect()
    assert sorted(r.id for r in got) == [0, 120_000, 149_999]


def test_dynamic_and_static_overwrites_side_by_side(spark):
    """The mode belongs to the write: a static overwrite of the same session at the same time stays static."""
    for name in ("side_dynamic", "side_static"):
        spark.sql(f"CREATE TABLE {name} (v STRING, p INT) USING parquet PARTITIONED BY (p)")
        spark.createDataFrame([("old", p) for p in range(3)], "v string, p int").write.mode("overwrite").insertInto(name)
    new = spark.createDataFrame([("new", 1), ("new", 5)], "v string, p int")
    failed = []

    def run(write):
        try:
            write()
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=run, args=(w,)) for w in
               (lambda: overwrite_partitions(new, "side_dynamic"), lambda: new.write.mode("overwrite").insertInto("side_static"))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert sorted(tuple(r) for r in spark.table("side_dynamic").collect()) == [("new", 1), ("new", 5), ("old", 0), ("old", 2)]
    assert sorted(tuple(r) for r in spark.table("side_static").collect()) == [("new", 1), ("new", 5)]


def test_failed_overwrite_leaves_the_partitions(spark):
    spark.sql("CREATE TABLE kept_parts (v STRING, p INT) USING parquet PARTITIONED BY (p)")
    overwrite_partitions(spark.createDataFrame([("old", 1), ("old", 2)], "v string, p int"), "kept_parts")
    bad = spark.range(20).select(F.when(F.col("id") == 19, F.raise_error(F.lit("stop"))).otherwise("new").alias("v"), F.lit(1).alias("p"))
    with pytest.raises(Exception, match="stop"):
        overwrite_partitions(bad, "kept_parts")
    assert sorted(tuple(r) for r in spark.table("kept_parts").collect()) == [("old", 1), ("old", 2)]
    spark.sql("CREATE TABLE no_parts (v STRING) USING parquet")
    with pytest.raises(ValueError):
        overwrite_partitions(spark.createDataFrame([("x",)], "v string"), "no_parts")
