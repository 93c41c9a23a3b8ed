import math
from fractions import Fraction

import numpy as np
import pytest

from strata.llm import queries, whitening as wh

SCHEMA = "vec_id long, embedding array<float>, deviation string, _vector string"


def spectrum(values, seed=3):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = q * np.array(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    [5.0], [3, 1], [1, 2, 3], [4, 4, 4, 4], [9, 9, 9, 1, 1], [1e8, 1, 1e-4, 0, 0], list(range(40)), [2.0 ** -i for i in range(50)],
    [1 + 1e-9 * i for i in range(6)] + [5], [-3, -1, 0, 2, 7]])
def test_components_against_eigh(values):
    a = spectrum(values)
    for k in (1, 2, len(values)):
        got, vectors = wh.components(a, k)
        want = np.linalg.eigvalsh(a)[::-1][:k]
        scale = np.abs(values).max()
        assert len(got) == min(k, len(values)) and np.allclose(got, want, atol=1e-13 * scale * len(values), rtol=0)
        assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-13)
        assert np.linalg.norm(a @ vectors - vectors * got) <= 1e-12 * scale * len(values)


def test_polar_is_the_matrix_sign():
    a = spectrum([5, 3, -1e-9, 2, -4])
    values, q = np.linalg.eigh(a)
    assert np.allclose(wh.polar(a), q * np.sign(values) @ q.T, atol=1e-6)
    upper, lower = wh.split(spectrum([5, 3, 1]))
    assert upper.shape[1] + lower.shape[1] == 3 and np.allclose(upper.T @ lower, 0, atol=1e-14)


def plain(vectors):
    """n, S, deviations and covariance of lists of numbers, exactly."""
    xs = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, dim = len(xs), len(xs[0])
    s = [sum(x[i] for x in xs) for i in range(dim)]
    deviation = [sum((n * x[i] - s[i]) ** 2 for i in range(dim)) for x in xs]
    cov = [[float(Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in xs), n ** 3)) for j in range(dim)] for i in range(dim)]
    return xs, s, deviation, np.array(cov)


def check(rows, vectors, k=8):
    """rows: (vector's number, component, n, deviation, whitened, explained, error)."""
    xs, s, deviation, cov = plain(vectors)
    n, dim = len(xs), len(xs[0])
    values, q = np.linalg.eigh(cov)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    y = np.array([[float(Fraction(n * x[i] - s[i], n)) for i in range(dim)] for x in xs])
    want = y @ q / np.sqrt(values)
    got = np.full((n, min(k, dim)), np.nan)
    for v, c, number, d, w, e, error in rows:
        assert number == n and d == deviation[v] and error < 1e-9
        assert e == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
        got[v, c - 1] = w
    for c in range(min(k, dim)):
        assert min(np.abs(got[:, c] - want[:, c]).max(), np.abs(got[:, c] + want[:, c]).max()) < 1e-8


def test_query_against_plain(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    out = queries.op11_whitening(spark, sf)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    place = {r.vec_id: i for i, r in enumerate(table)}
    rows = [(place[r[0]], *r[1:]) for r in out.collect()]
    assert len(rows) == 8 * len(table)
    check(rows, [r.embedding for r in table])


def test_unusable_rows_and_few_dimensions(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((30, 3)).astype("float32").tolist()
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]
    rows = [(i, v, "x", "y") for i, v in enumerate(good + bad)] + [(0, good[0], "x", "y"), (None, good[1], "x", "y")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    model = wh.fit(df)
    assert model.n == 32 and model.vectors.shape == (3, 3)
    out = wh.whiten(df, model)
    assert out.columns == ["vec_id", "embedding", "_vector", "deviation", "whitened"]
    found = out.collect()
    assert sorted(r.vec_id for r in found if r.vec_id is not None) == sorted([*range(30), 0])
    vectors = [r.embedding for r in found]
    error = wh.identity_error(out)
    check([(i, c + 1, model.n, r.deviation, w, model.explained[c], error) for i, r in enumerate(found) for c, w in enumerate(r.whitened)], vectors)


def test_no_variance_and_empty(spark):
    df = spark.createDataFrame([(i, [1.0, float(i % 2), 3.0], "", "") for i in range(6)], SCHEMA)
    model = wh.fit(df)
    rows = wh.whiten(df, model, keep=["vec_id"]).collect()
    assert all(abs(abs(r.whitened[0]) - 1) < 1e-12 and r.whitened[1:] == [None, None] for r in rows)
    assert model.explained[0] == pytest.approx(1) and wh.identity_error(wh.whiten(df, model)) < 1e-12
    same = spark.createDataFrame([(1, [2.0, 2.0], "", "")] * 5, SCHEMA)
    rows = wh.whiten(same, wh.fit(same)).collect()
    assert [(r.deviation, r.whitened) for r in rows] == [(0, [None, None])] * 5 and wh.identity_error(wh.whiten(same, wh.fit(same))) is None
    for none in (same.where("false"), spark.createDataFrame([(1, None, "", ""), (2, [], "", "")], SCHEMA)):
        out = wh.whiten(none, wh.fit(none), keep=["vec_id"])
        assert out.columns == ["vec_id", "deviation", "whitened"] and out.count() == 0 and wh.identity_error(out) is None


def test_large_entries(spark):
    df = spark.createDataFrame([(i, [float(10 ** i), 0.5, 1e300 if i == 3 else -1.0], "", "") for i in range(8)], SCHEMA.replace("float", "double"))
    model = wh.fit(df)
    rows = wh.whiten(df, model).collect()
    assert all(r.deviation is None for r in rows) and wh.identity_error(wh.whiten(df, model)) < 1e-6
