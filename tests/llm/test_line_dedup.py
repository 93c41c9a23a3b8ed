import random
import re

import duckdb

from strata.llm import line_dedup, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, least):
    """All repeated runs by comparing every stretch of lines; later copies go."""
    lines = {}
    for key, text in docs:
        parts = (text or "").split("\n")
        full = [p for p, x in enumerate(parts) if WORD.search(x)]
        lines[key] = [(parts[p], p, nxt) for p, nxt in zip(full, full[1:] + [len(parts)])]
    seen, gone = set(), {k: set() for k in lines}
    for key in sorted(lines):
        own = lines[key]
        for i in range(len(own)):
            words = 0
            for j in range(i, len(own)):
                words += len(WORD.findall(own[j][0]))
                if words >= least:
                    run = tuple(x[0] for x in own[i:j + 1])
                    if run in seen:
                        gone[key] |= set(range(i, j + 1))
                    seen.add(run)
    out = {}
    for key, text in docs:
        drop = {q for i in gone[key] for q in range(lines[key][i][1], lines[key][i][2])}
        kept = None if text is None else "\n".join(x for q, x in enumerate(text.split("\n")) if q not in drop)
        out[key] = (kept, len(gone[key]))
    return out


def test_random_texts_against_all_stretches(spark):
    rng = random.Random(8)
    lines = ["a", "b b", "c c c", "d d d d", "", " ", "e e", "f"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(25)))) for i in range(60)]
    docs += [(100, docs[3][1]), (101, docs[3][1] + "\nzz"), (102, "a\n" * 30), (103, None), (104, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for least in (1, 4, 9):
        got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(frame, least).collect()}
        assert got == brute(docs, least)


def test_query_against_sql(spark):
    got = queries.op7_line_dedup(spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(queries.ORACLE["op7_line_dedup"]).df().sort_values("doc_id")
    got = got.select(*want.columns).toPandas().sort_values("doc_id")
    assert got.values.tolist() == want.values.tolist()
    assert got.n_removed.sum() > 0


def test_long_passage_is_kept_once(spark):
    passage = "\n".join(" ".join(f"p{i}w{j}" for j in range(20)) for i in range(4))
    docs = [(i, f"own {i} start\n\n{passage}\n\nown {i} end") for i in range(5)] + [(9, "short line\nshort line")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0] == docs[0][1] and got[9] == docs[5][1]
    assert all(got[i] == f"own {i} start\n\nown {i} end" for i in range(1, 5))


def test_edge_rows(edge, edge_rows):
    out = line_dedup.dedup_lines(edge, 5)
    assert out.columns == edge.columns + ["n_removed"] and out.count() == len(edge_rows)
    docs = sorted({((r[0] is None, r[0] or 0), r[1]) for r in edge_rows if r[1] is not None})
    want = brute(docs, 5)
    for r in out.collect():
        if r.text is not None or r.n_removed:
            assert (r.text, r.n_removed) == want[(r.doc_id is None, r.doc_id or 0)]
    assert out.where("text IS NULL").count() == sum(r[1] is None for r in edge_rows)


def test_no_rows(empty):
    assert line_dedup.dedup_lines(empty).collect() == []
