import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources import bson
from strata.sources.bson import read_bson, write_bson

SCHEMA = "id long, name string, at timestamp, ok boolean, x double, raw binary, tags array<string>, at_home struct<k: int, deep: struct<v: string>>"


def _rows(n, seed=1):
    r = random.Random(seed)
    return [(i, None if i % 7 == 0 else "né\0w" * r.randrange(5), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i),
             i % 2 == 0, r.random(), bytes(r.randrange(256) for _ in range(r.randrange(40))),
             [None if j % 3 == 2 else f"t{j}" for j in range(r.randrange(6))],
             None if i % 5 == 0 else (i, (str(i),) if i % 3 else None)) for i in range(n)]


@pytest.mark.parametrize("split", [64, 300, 5000, 1 << 20])
def test_round_trip_in_splits(spark, tmpdir_path, split):
    rows = spark.createDataFrame(_rows(400), SCHEMA).repartition(3, "id")
    path = os.path.join(tmpdir_path, "docs")
    write_bson(rows, path)
    back = read_bson(spark, path, SCHEMA, split_bytes=split)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def _dump(path, documents):
    with open(path, "wb") as fh:
        fh.write(b"".join(documents))


def _doc(i, size=0):
    return bson.record(StructType.fromDDL("id long, pad string"))({"id": i, "pad": "x" * size})


def test_document_longer_than_its_split(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "one.bson")
    _dump(path, [_doc(0), _doc(1, 3000), _doc(2), _doc(3, 50)])
    assert sorted(r.id for r in read_bson(spark, path, "id long", split_bytes=100).collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize("split", [40, 1 << 20])
def test_torn_document(spark, tmpdir_path, split):
    path = os.path.join(tmpdir_path, "torn.bson")
    _dump(path, [_doc(i, 30) for i in range(20)] + [_doc(20, 30)[:-9]])
    with pytest.raises(Exception, match="torn document"):
        read_bson(spark, path, "id long", split_bytes=split).collect()
    assert sorted(r.id for r in read_bson(spark, path, "id long", split_bytes=split, torn="skip").collect()) == list(range(20))


def test_a_dump_inside_a_document_is_no_silent_error(spark, tmpdir_path):
    """Documents held as bytes by another look like documents to a split that begins among them."""
    inner = b"".join(_doc(100 + i, 20) for i in range(10))
    path = os.path.join(tmpdir_path, "inner.bson")
    _dump(path, [_doc(0), bson.record(StructType.fromDDL("held binary"))({"held": inner}), _doc(1)])
    with pytest.raises(Exception, match="borders|torn document"):
        read_bson(spark, path, "id long", split_bytes=120).collect()
    assert [r.id for r in read_bson(spark, path, "id long").collect()] == [0, None, 1]


def test_values_that_do_not_fit_and_missing_fields(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "mixed.bson")
    rows = spark.createDataFrame([(2 ** 40, 1.5, [1, 2], True)], "a long, b double, c array<int>, d boolean")
    write_bson(rows, path)
    got = read_bson(spark, path, "a int, b long, c string, d int, e string").first()
    assert tuple(got) == (None, None, "[1, 2]", None, None)


def test_other_kinds_are_stepped_over_or_hexadecimal(spark, tmpdir_path):
    body = (b"\x07_id\0" + bytes(range(12)) + b"\x0br\0a+\0i\0" + b"\x13d\0" + bytes(16) + b"\x11t\0" + (5).to_bytes(8, "little")
            + b"\xffm\0" + b"\x10id\0" + (7).to_bytes(4, "little"))
    path = os.path.join(tmpdir_path, "kinds.bson")
    _dump(path, [(len(body) + 5).to_bytes(4, "little") + body + b"\0"] * 3)
    got = read_bson(spark, path, "_id string, id int, t long, m string", split_bytes=30).collect()
    assert [tuple(r) for r in got] == [(bytes(range(12)).hex(), 7, 5, None)] * 3


def test_empty_overwritten_and_appended(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "modes")
    write_bson(spark.range(0), path)
    assert read_bson(spark, path, "id long").count() == 0
    write_bson(spark.range(3), path)
    write_bson(spark.range(3, 5), path)
    assert sorted(r.id for r in read_bson(spark, path, "id long").collect()) == [0, 1, 2, 3, 4]
    write_bson(spark.range(2), path, mode="overwrite")
    assert sorted(r.id for r in read_bson(spark, path, "id long").collect()) == [0, 1]


def test_failed_write_leaves_the_collection(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "failed")
    write_bson(spark.range(3), path)
    with pytest.raises(Exception):
        write_bson(spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id")), path, "overwrite")
    assert read_bson(spark, path, "id long").count() == 3


def test_random_bytes_are_no_documents():
    r = random.Random(3)
    for _ in range(2000):
        data = bytes(r.randrange(256) for _ in range(r.randrange(60)))
        try:
            assert bson.document_end(data, 0, len(data)) <= len(data)
        except bson.Broken:
            pass


def test_dates_maps_and_edges_of_numbers(spark, tmpdir_path):
    schema = "d date, n timestamp_ntz, m map<string, array<int>>, f float, x double, y double, s short"
    rows = spark.createDataFrame([(dt.date(1950, 2, 3), dt.datetime(1960, 1, 1, 0, 0, 0, 999000), {"a": [1, None], "b": None}, 0.5, float("nan"),
                                   float("-inf"), -32768), (None,) * 7], schema)
    path = os.path.join(tmpdir_path, "edges")
    write_bson(rows, path)
    assert sorted(map(str, read_bson(spark, path, schema).collect())) == sorted(map(str, rows.collect()))
    narrow = read_bson(spark, path, "x long, y int, s byte, f int, d string, m struct<a: string>").select("x", "y", "s", "f", "d", "m.a").collect()
    assert sorted(map(str, (tuple(r) for r in narrow))) == sorted(map(str, [
        (None, None, None, None, "1950-02-03T00:00:00+00:00", "[1, null]"), (None,) * 6]))
