import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import mil, queries, texts


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    bags = [rng.normal(0, 1, (k, mil.N_FEATURES)) for k in (1, 4, 2)]
    x, cuts, y = np.concatenate(bags), np.array([0, 1, 5, 7]), np.array([1.0, 0.0, 1.0])
    p = mil.train(bags, np.array([1, 1, 1])) | {"c": rng.normal(0, 1, mil.HIDDEN), "d": np.array([0.1])}
    loss = lambda q: -np.mean(np.log(np.where(y == 1, (s := mil._forward(q, x, cuts)["s"]), 1 - s)))
    g = mil._gradient(p, x, cuts, y)
    for k in g:
        at = tuple(rng.integers(n) for n in p[k].shape)
        for step in (1e-5,):
            up, down = p[k].copy(), p[k].copy()
            up[at] += step
            down[at] -= step
            want = (loss(p | {k: up}) - loss(p | {k: down})) / (2 * step)
            assert abs(want - np.asarray(g[k])[at]) < 1e-6, k


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for i in range(1200):
        bag = rng.normal(0, 1, (rng.integers(2, 12), mil.N_FEATURES)).astype(np.float32)
        if i % 2:
            bag[rng.integers(len(bag)), :3] += 4
        bags.append(bag)
        labels.append(1 - i % 2)
    p = mil.train(bags[:1000], np.array(labels[:1000]))
    x, cuts = np.concatenate(bags[1000:]), np.r_[0, np.cumsum([len(b) for b in bags[1000:]])]
    f = mil._forward(p, (x - p["mean"]) * p["scale"], cuts)
    assert np.mean((f["s"] >= 0.5) == labels[1000:]) > 0.85


def test_held_out_documents(spark):
    got = queries.op6_quality_classifier(spark, "/root/testdata/sf0.01").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    seen = got.merge(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas(), on="doc_id")
    out = seen[seen.held_out]
    rank = out.score.rank()
    good = out.quality == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.95


def test_passages_cover_whole_texts():
    words = [f"w{i}" for i in range(200)]
    x, cuts = mil.passages(*texts.buffers(pa.array(["", " ".join(words), None, "one"])))
    assert np.diff(cuts).tolist() == [1, 4, 1, 1]
    assert not x[0].any() and x[4].any() and not x[5].any()


def test_scores_against_plain_loops():
    rng = np.random.default_rng(4)
    made = mil.train([rng.normal(0, 1, (3, mil.N_FEATURES)).astype(np.float32) for _ in range(8)], np.arange(8) % 2)
    body = [" ".join(f"w{rng.integers(50)}" for _ in range(n)) for n in (0, 5, 64, 65, 400)]
    x, cuts = mil.passages(*texts.buffers(pa.array(body)))
    score, n, top = mil.score_texts(*texts.buffers(pa.array(body)), made)
    p = {k: np.asarray(v, float) for k, v in made.items()}
    sig = lambda t: 1 / (1 + np.exp(-t))
    for i in range(len(body)):
        coded, gate = [], []
        for row in x[cuts[i]:cuts[i + 1]]:
            h = np.tanh(p["b"] + sum(((row[j] - p["mean"][j]) * p["scale"][j]) * p["W"][j] for j in range(mil.N_FEATURES)))
            coded.append(h)
            gate.append(float(p["w"] @ (np.tanh(h @ p["V"]) * sig(h @ p["U"]))))
        weight = np.exp(np.array(gate) - max(gate))
        weight /= weight.sum()
        want = sig(sum(a * h for a, h in zip(weight, coded)) @ p["c"] + p["d"][0])
        assert abs(score[i] - want) < 1e-6 and n[i] == len(coded) and abs(top[i] - weight.max()) < 1e-6


def test_small_shares_still_draw(spark):
    ids = spark.range(300_000).select(F.xxhash64("id").alias("h"))
    for share in (1e-9, 1e-4, 0.3, 1.0):
        assert abs(ids.where(mil.drawn(F.col("h"), share)).count() - 300_000 * share) <= 1 + 5 * (300_000 * share) ** 0.5
    assert spark.range(1).select(mil.drawn(F.lit(0).cast("long"), 1e-14)).first()[0]


def test_passages_to_the_driver_are_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} " * n) for i, n in enumerate([10, 64 * 400, 64 * 30, 0])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality long")
    seen = []
    monkeypatch.setattr(mil, "train", lambda bags, y: seen.append(([len(b) for b in bags], y.tolist())))
    mil.fit(docs, labels, train_passages=50)
    mil.fit(docs, labels)
    assert sorted(seen[0][0]) == [1, 1, 4, 45] and sorted(seen[1][0]) == [1, 1, 30, 400]


def test_edge_rows_and_no_labels(spark, edge, edge_rows, empty):
    labels = spark.createDataFrame([(8, 1), (9, 0), (9, None), (11, 0), (None, 1), (8, 0), (8, 1)], "doc_id long, quality long")
    p = mil.fit(edge, labels)
    out = mil.score(edge, p)
    assert out.count() == len(edge_rows)
    by = {}
    for r in out.collect():
        by.setdefault(r.text, set()).add(round(r.quality_score, 9))
    assert all(len(v) == 1 for v in by.values())
    assert by[None] == by[""]
    none = mil.fit(empty, labels.where("false"))
    assert {r.quality_score for r in mil.score(edge, none).collect()} == {0.5}
    assert mil.score(empty, p).collect() == []
