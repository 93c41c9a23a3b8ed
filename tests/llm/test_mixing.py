import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import mixing, queries

NEW = ["mix_topic", "mix_tokens", "mix_prob", "mix_kept"]


def test_query_against_sql(spark):
    got = queries.op8_mixing(spark, "/root/testdata/sf0.001").toPandas().sort_values("doc_id")
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(queries.ORACLE["op8_mixing"]).df().sort_values("doc_id")[list(got.columns)]
    assert got.values.tolist() == want.values.tolist()
    assert 0 < got.kept.sum() < len(got)


def test_rake_reaches_the_margins(spark):
    rng = random.Random(6)
    cells = spark.createDataFrame([(f"s{i}", f"l{j}", f"t{k}", rng.randrange(1, 9999)) for i in range(6) for j in range(4)
                                   for k in range(3) if rng.random() < 0.9], "source string, lang string, topic string, tokens long")
    share = {"source": [.4, .2, .1, .1, .1, .1], "lang": [.7, .1, .1, .1], "topic": [.5, .3, .2]}
    targets = {d: spark.createDataFrame([(f"{d[0]}{i}", x) for i, x in enumerate(v)], f"{d} string, target double") for d, v in share.items()}
    out = mixing.rake(cells, targets)
    for dim, v in share.items():
        got = {r[dim]: r.w for r in out.groupBy(dim).agg(F.sum("weight").alias("w")).collect()}
        assert got == pytest.approx({f"{dim[0]}{i}": x for i, x in enumerate(v)}, rel=1e-6)
    # weights over tokens are a product of one factor a margin
    odds = {(r.source, r.lang, r.topic): r.weight / r.tokens for r in out.collect()}
    for (s, la, t), x in odds.items():
        other = [(s, la, "t0"), ("s0", "l0", t), ("s0", "l0", "t0")]
        if all(k in odds for k in other):
            assert x * odds[other[2]] == pytest.approx(odds[other[0]] * odds[other[1]], rel=1e-6)


def test_value_without_target_gets_nothing(spark):
    cells = spark.createDataFrame([("a", 5), ("b", 5)], "source string, tokens long")
    out = mixing.rake(cells, {"source": spark.createDataFrame([("a", 1.0)], "source string, target double")})
    assert {r.source: r.weight for r in out.collect()} == {"a": 1.0, "b": 0.0}


def test_misfits_of_targets_that_contradict(spark):
    # each source holds one language, with another target share
    cells = spark.createDataFrame([("a", "x", 50), ("b", "y", 50)], "source string, lang string, tokens long")
    targets = {"source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, target double"),
               "lang": spark.createDataFrame([("x", 0.3), ("y", 0.6), ("z", 0.1)], "lang string, target double")}
    raked = mixing.rake(cells, targets, sweeps=3)
    found = {(r.margin, r.value): r for r in mixing.misfits(raked, targets).collect()}
    assert {k: r.target for k, r in found.items()} == {("source", "a"): 0.9, ("source", "b"): 0.1, ("lang", "x"): 0.3, ("lang", "y"): 0.6, ("lang", "z"): 0.1}
    assert found["lang", "x"].misfit == pytest.approx(0) and found["lang", "y"].misfit == pytest.approx(0)
    assert found["lang", "z"].misfit == pytest.approx(-0.1) and found["source", "a"].misfit == pytest.approx(-0.6)
    assert found["source", "b"].reached == pytest.approx(0.6)
    # and of targets that agree, none
    fits = {"source": targets["source"], "lang": spark.createDataFrame([("x", 0.9), ("y", 0.1)], "lang string, target double")}
    assert all(abs(r.misfit) < 1e-9 for r in mixing.misfits(mixing.rake(cells, fits), fits).collect())


def test_edge_rows(edge, edge_rows):
    out = mixing.mix(edge)
    assert out.columns == edge.columns + NEW and out.count() == len(edge_rows)
    for r in out.collect():
        assert r.mix_tokens == max(1, len(re.findall("[^\x20\x09-\x0d]+", r.text or "")))
        assert 0 < r.mix_prob <= 1
    assert out.agg(F.max("mix_prob")).first()[0] == 1
    again = mixing.mix(edge)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_no_rows(empty):
    assert mixing.mix(empty).collect() == []
