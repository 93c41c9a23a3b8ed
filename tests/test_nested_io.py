import glob
import json
import os

from pyspark.sql import functions as F

from strata.operators.nested import FLIGHT_COLUMNS, explode_records, flatten_flight, partitioned_records
from strata.sources import (append_to, insert_by_name, overwrite_partitions, read_ctrl_a,
                            read_json_documents, read_quoted_csv, read_unquoted_csv, row_count,
                            schema_rows, write_csv, read_json_text)
from strata.sources.writers import overwrite_partitions_at

FLIGHT = {
    "flight_date": "2020-11-02", "flight_status": "active",
    "departure": {"airport": "Taoyuan", "timezone": "Asia/Taipei"},
    "arrival": {"airport": "Narita", "timezone": "Asia/Tokyo", "terminal": "1", "gate": None},
    "airline": {"name": "Air X"}, "flight": {"number": "123"},
    "aircraft": {"registration": "B-1"},
    "live": {"updated": "2020-11-02T01:00:00", "latitude": 25.5, "longitude": 121.25,
             "altitude": 1000.0, "direction": 90.0, "speed_horizontal": 800.5,
             "speed_vertical": 0.0, "is_ground": False},
}


def _docs(spark, tmp):
    second = dict(FLIGHT, flight_date="2020-11-03", aircraft=None, live=None,
                  flight={"number": None})
    third = dict(FLIGHT, flight_date=None)
    pages = [{"data": [FLIGHT, second]}, {"data": []}, {"data": None}, {"data": [third]}]
    path = os.path.join(tmp, "api")
    os.makedirs(path)
    for i, p in enumerate(pages):
        with open(os.path.join(path, f"page{i}.json"), "w") as fh:
            json.dump(p, fh)
    return read_json_documents(spark, path)


def test_flatten_flight_null_objects(spark, tmpdir_path):
    docs = _docs(spark, tmpdir_path)
    rows = flatten_flight(explode_records(docs, "data", "data"), "data").collect()
    assert len(rows) == 3  # empty and null arrays give no rows
    assert rows[0].__fields__ == FLIGHT_COLUMNS
    by_date = {r.flight_date: r for r in rows}
    full = by_date["2020-11-02"]
    assert full.ISGROUND == "false" and full.LATITUDE == "25.5" and full.ARRGATE is None
    assert full.AIRCRAFTREGISTRATION == "B-1" and full.FLIGHTNUMBER == "123"
    bare = by_date["2020-11-03"]
    assert bare.AIRCRAFTREGISTRATION == "" and bare.FLIGHTNUMBER is None
    assert all(getattr(bare, c) == "" for c in FLIGHT_COLUMNS[11:])
    strict = flatten_flight(explode_records(docs, "data", "data"), "data", none_as_text=True)
    assert {r.ARRGATE for r in strict.collect()} == {"None"}
    assert {r.ISGROUND for r in strict.collect()} == {"False", ""}


def test_partition_key_and_dynamic_overwrite(spark, tmpdir_path):
    docs = _docs(spark, tmpdir_path)
    rec = partitioned_records(docs)
    keys = sorted((r.flight_dt for r in rec.collect()), key=lambda x: (x is None, x))
    assert keys == [20201102, 20201103, None]
    spark.sql("CREATE TABLE flights_p (data STRING, flight_dt INT) USING parquet PARTITIONED BY (flight_dt)")
    first = rec.select(F.to_json("data").alias("data"), "flight_dt")
    overwrite_partitions(first, "flights_p")
    assert spark.table("flights_p").count() == 3
    # rewrite only 2020-11-02: the other partitions must survive
    again = first.filter(F.col("flight_dt") == 20201102).withColumn("data", F.lit("new"))
    overwrite_partitions(again, "flights_p")
    got = sorted((r.flight_dt or 0, r.data) for r in spark.table("flights_p").collect())
    assert [g[0] for g in got] == [0, 20201102, 20201103] and got[1][1] == "new"
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    # the path-based variant
    out = os.path.join(tmpdir_path, "by_path")
    overwrite_partitions_at(first, out, ["flight_dt"])
    overwrite_partitions_at(again, out, ["flight_dt"])
    assert spark.read.parquet(out).count() == 3


def test_insert_by_name_and_append(spark, tmpdir_path):
    spark.sql("CREATE TABLE active_flights (flight_date STRING, FLIGHTNUMBER STRING, "
              "AIRCRAFTREGISTRATION STRING) USING parquet")
    df = spark.createDataFrame([("2020-11-02", "B-1")], "flight_date string, AIRCRAFTREGISTRATION string")
    insert_by_name(df, "active_flights")
    r = spark.table("active_flights").first()
    assert r.FLIGHTNUMBER is None and r.AIRCRAFTREGISTRATION == "B-1"
    path = os.path.join(tmpdir_path, "coll")
    append_to(df, path)
    append_to(df, path)
    assert row_count(spark.read.parquet(path)).first().n == 2


def test_csv_sinks_render_arrays(spark, tmpdir_path):
    df = spark.createDataFrame([(["US", "FR"], 3), (None, 1), (["US", None], 2)], "countries array<string>, count bigint")
    out = os.path.join(tmpdir_path, "genre")
    write_csv(df, out, single_file=True)
    parts = glob.glob(os.path.join(out, "part-*.csv"))
    assert len(parts) == 1
    text = open(parts[0]).read()
    assert text.startswith("countries,count") and '"[US, FR]"' in text


def test_array_group_key_order_and_null(spark):
    df = spark.createDataFrame([(["US", "FR"],), (["FR", "US"],), (["US", None],), (None,), (["US", "FR"],)],
                               "countries array<string>")
    counts = {str(r.countries): r["count"] for r in df.groupBy("countries").count().collect()}
    assert counts == {"['US', 'FR']": 2, "['FR', 'US']": 1, "['US', None]": 1, "None": 1}


def test_readers(spark, tmpdir_path):
    ctrl = os.path.join(tmpdir_path, "t_emails")
    with open(ctrl, "w", encoding="utf-8") as fh:
        fh.write("a\x01b\x01c\nd\x01e\x01f\n")
    df = read_ctrl_a(spark, ctrl)
    assert [tuple(r) for r in df.collect()] == [("a", "b", "c"), ("d", "e", "f")]
    q = os.path.join(tmpdir_path, "values.csv")
    with open(q, "w") as fh:
        fh.write('"k", "1", "say ""hi""", "2"\n')
    qdf = read_quoted_csv(spark, q, "k string, v string, name string, seq string")
    assert qdf.first().name == 'say "hi"'
    u = os.path.join(tmpdir_path, "keys.csv")
    with open(u, "w") as fh:
        fh.write("1,Age,age,1,0,1\n")
    udf = read_unquoted_csv(spark, u, "id string, name string, key string, seq string, lk string, tf string")
    assert udf.first().key == "age"
    texts = spark.createDataFrame([('{"data": [{"a": 1}]}',)], "value string")
    parsed = read_json_text(spark, texts)
    assert parsed.select(F.explode("data.a")).first()[0] == 1
    assert [r.column for r in schema_rows(qdf).collect()] == ["k", "v", "name", "seq"]
