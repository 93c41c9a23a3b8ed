import hashlib
import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from strata.llm import decontaminate as dc
from strata.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(text, items, span=10):
    """(n_words, places hit, items) by trying every window at every place."""
    ws, hit, who = words_of(text), set(), set()
    for item, body in items:
        iw = words_of(body)
        n = min(span, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1):
            if tuple(ws[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                who.add("null" if item is None else str(item))
    return len(ws), len(hit), sorted(who)


def check(spark, rows, items):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(3)
    out = dc.hits(docs, spark.createDataFrame(items, ITEMS), keep=["doc_id"])
    got = {r.doc_id: (r.n_words, r.n, list(r.hit_items)) for r in out.withColumn("n", dc.covered(F.col("hit_spans"))).collect()}
    assert got == {i: plain(t, items) for i, t in enumerate(rows)}
    return got


def test_shared_spans_of_every_length(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)]  # few words: many chance matches and equal hashes in a window
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    bodies = [make(n) for n in (1, 2, 3, 5, 9, 10, 11, 14, 30, 60)] + [["same"] * 25]
    items = [(i, " ".join(b)) for i, b in enumerate(bodies)] + [(3, " ".join(make(20))), (None, " ".join(make(12))), (99, None), (98, " ,.")]
    rows = []
    for _ in range(60):
        body = bodies[rng.randrange(3, len(bodies))]
        a = rng.randrange(len(body))
        b = rng.randrange(a, len(body) + 1)
        rows.append(" ".join(["x"] * rng.randrange(4) + body[a:b] + make(rng.randrange(20))))
    got = check(spark, rows + [" ".join(["same"] * 40), " ".join(["same"] * 9), "", None, "...", "w0"], items)
    assert any(n[1] for n in got.values()) and any(n[1] == 0 for n in got.values())


def test_long_items_only(spark):
    rng = random.Random(6)
    bodies = [[f"v{rng.randrange(400)}" for _ in range(40)] for _ in range(8)]
    rows = []
    for n in (9, 10, 11, 25, 40):  # nine words are no window, ten are
        for body in bodies:
            rows.append("Start, of " + "; ".join(body[:n]).upper() + "! END")
    got = check(spark, rows, [(i, " ".join(b)) for i, b in enumerate(bodies)])
    assert [got[i][1] for i in range(len(rows))] == [0] * 8 + [10] * 8 + [11] * 8 + [25] * 8 + [40] * 8


def test_pieces_give_the_whole_text(spark, monkeypatch):
    monkeypatch.setattr(dc, "PIECE_BYTES", 64)
    monkeypatch.setattr(dc.pieces, "__defaults__", (64,))
    rng = random.Random(7)
    body = [f"t{rng.randrange(50)}" * rng.randrange(1, 4) for _ in range(300)] + ["long" * 100, "é" * 90] + [f"t{i}" for i in range(30)]
    text = "  ,".join(body).encode()
    words, at = [], 0
    for part, first in dc.pieces(np.frombuffer(text, np.uint8), 9, 64):
        assert first <= at
        ws = words_of(part.tobytes().decode())
        words[first:] = ws
        at = len(words)
    assert words == words_of(text.decode())
    items = [(0, " ".join(body[20:45])), (1, " ".join(body[295:320])), (2, "t1 t2 t3"), (3, " ".join(body[:9]) + "," * 500 + body[9])]
    check(spark, [text.decode(), "," * 300 + text.decode() + "." * 300, "one two"], items)


def test_edge_rows(spark, edge, edge_rows, empty):
    items = [(i, r[1]) for i, r in enumerate(edge_rows[:14])]
    table = spark.createDataFrame(items, ITEMS)
    out = dc.hits(edge, table)
    assert out.columns == [c for c in edge.columns if c != "n_words"] + ["n_words", "hit_spans", "hit_items"]
    want = {r[1]: plain(r[1], items) for r in edge_rows if not r[1] or len(r[1]) < 5000}
    rows = out.withColumn("n", dc.covered(F.col("hit_spans"))).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        if r.text in want:
            assert (r.n_words, r.n, list(r.hit_items)) == want[r.text]
        else:
            assert r.n == 60_000 and "13" in r.hit_items  # all words but the last of the second text
    assert dc.hits(empty, table).count() == 0
    assert all(r.hit_items == [] for r in dc.hits(edge, table.where("false")).collect())


def test_query_against_plain_and_sql(spark, document_rows):
    sf = "/root/testdata/sf0.001"
    got = queries.op13_decontamination(spark, sf).toPandas().sort_values("doc_id")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for r, d in zip(got.itertuples(), document_rows):
        n, hit, who = plain(d.text, items)
        assert (r.doc_id, r.n_words, r.n_hit, r.n_items) == (d.doc_id, n, hit, len(who))
        assert r.items_sha256 == hashlib.sha256(",".join(who).encode()).hexdigest() and r.contaminated == (hit > 0)
    assert got.contaminated.any() and not got.contaminated.all()
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    sql = con.execute(queries.ORACLE["op13_decontamination"]).df().sort_values("doc_id")[list(got.columns)]
    assert got.values.tolist() == sql.values.tolist()
