"""Oracle parity: every registered query against its DuckDB SQL (sf0.001),
plus invariants of the flagship output."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans import registry, round_trips
from strata.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["tv_respondent_id", "start_date", "end_date", "values_text"]
    assert df.count() > 0


def test_flagship_invariants(spark):
    from strata.plans import demographics as d
    closed = d.segments_closed(spark, SF).orderBy("tv_respondent_id", "start_date").collect()
    for a, b in zip(closed, closed[1:]):
        if a.tv_respondent_id == b.tv_respondent_id:
            assert a.end_date == b.start_date - dt.timedelta(days=1)
        else:
            assert a.end_date == dt.date(9999, 12, 30)
    final = d.demographic_segments(spark, SF).collect()
    assert all(r.end_date >= dt.date(1997, 1, 1) for r in final)
    keys = [(r.tv_respondent_id, r.start_date) for r in final]
    assert len(keys) == len(set(keys))


def test_histogram_and_share_invariants(spark):
    h = QUERIES["histogram_30"](spark, SF).collect()
    n = spark.read.parquet(f"{SF}/lineitem.parquet").filter("l_quantity is not null").count()
    assert sum(r.n for r in h) == n
    s = QUERIES["country_share"](spark, SF).collect()
    assert math.isclose(sum(r.share for r in s), 1.0)


def test_building_a_query_starts_no_job(spark, monkeypatch):
    """Over tables whose footers are read already; round trips write while they are built."""
    known = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in DRIVER_TABLES}
    monkeypatch.setattr("strata.plans.tables.table", lambda _, __, name: known[name])
    started = {}
    for name in sorted(set(QUERIES) - set(round_trips.QUERIES)):
        spark.sparkContext.setJobGroup(f"building {name}", "plans")
        QUERIES[name](spark, SF)
        started[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"building {name}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {n for n, jobs in started.items() if jobs} == set()


def test_queries_leave_no_views(spark):
    for name in ("sql_having", "max_revenue_rows"):
        QUERIES[name](spark, SF).collect()
    assert [t.name for t in spark.catalog.listTables() if t.isTemporary] == []
