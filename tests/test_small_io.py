import datetime as dt
import os

from pyspark.sql import functions as F

from strata.functions import today_key
from strata.sources import (append_to, catalog_table, literal_rows, peek, read_documents, read_json_text,
                            read_sales_csv, write_csv)
from strata.sources.writers import overwrite_partitions_at


def test_read_sales_csv_with_dates(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sales.csv")
    with open(path, "w") as fh:
        fh.write("Date,Year,Month,Day,Country,Revenue\n2016-05-03,2016,May,3,Canada,10.5\n")
    df = read_sales_csv(spark, path, "Date date, Year int, Month string, Day int, Country string, Revenue double")
    r = df.first()
    assert r.Date == dt.date(2016, 5, 3) and r.Month == "May" and r.Revenue == 10.5


def test_today_key_and_peek(spark):
    key = spark.range(1).select(today_key().alias("k")).first().k
    assert len(key) == 8 and key.isdigit()
    df = spark.createDataFrame([(i,) for i in range(10)], "i int")
    assert [r.i for r in peek(df, 3, [F.col("i").desc()]).collect()] == [9, 8, 7]


def test_partition_count_of_writers(spark, tmpdir_path):
    df = spark.range(100)
    for n in (1, 3):
        path = os.path.join(tmpdir_path, f"out{n}")
        write_csv(df, path, partitions=n)
        append_to(df, path + "-p", partitions=n)
        assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == n
        assert len([f for f in os.listdir(path + "-p") if f.endswith(".parquet")]) == n
    parts = os.path.join(tmpdir_path, "parts")
    overwrite_partitions_at(df.withColumn("p", F.col("id") % 2), parts, ["p"], partitions=1)
    assert all(len([f for f in os.listdir(os.path.join(parts, d)) if f.endswith(".parquet")]) == 1
               for d in os.listdir(parts) if d.startswith("p="))


def test_json_schema_is_found_in_the_texts(spark):
    texts = spark.createDataFrame([('{"a": {"b": 1}, "c": ["x", "y"]}',), ('{"a": {"b": 2}, "d": 1.5}',), (None,), ("not json",)], "value string")
    out = read_json_text(spark, texts).collect()
    assert [(r.a.b if r.a else None, r.c) for r in out][:2] == [(1, ["x", "y"]), (2, None)]
    assert float(out[1].d) == 1.5 and len(out) == 4 and out[2].a is None


def test_readers_of_collections_and_catalog(spark, tmpdir_path):
    spark.range(3).write.parquet(os.path.join(tmpdir_path, "docs"))
    assert read_documents(spark, os.path.join(tmpdir_path, "docs")).count() == 3
    spark.range(4).write.mode("overwrite").saveAsTable("small_ids")
    assert catalog_table(spark, "small_ids").count() == 4
    assert literal_rows(spark, [(1, "a")], "k int, v string").collect()[0].v == "a"
