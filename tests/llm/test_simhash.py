import hashlib
import math
import random

import numpy as np
import pyarrow as pa

from strata.llm import queries, simhash, texts


def test_query_against_brute_force(spark, document_rows):
    got = {r.doc_id: r for r in queries.op4_simhash_fingerprints(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(document_rows)
    fps = {r.doc_id: int(got[r.doc_id].fingerprint, 16) for r in document_rows}
    for r, after in zip(document_rows, document_rows[1:] + document_rows[:1]):
        text, g = r.text or "", got[r.doc_id]
        k = len(text) // 4
        edited = text[:len(text) - k] + (after.text or "")[:k]
        assert (g.n_chars, g.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert int(g.edited_fingerprint, 16) == int(one(edited))
        assert g.near_next == like(fps[r.doc_id], fps[after.doc_id])
        assert g.near_edited == like(fps[r.doc_id], int(g.edited_fingerprint, 16))
        want = sum((fps[r.doc_id] ^ f).bit_count() <= 3 for f in fps.values()) - 1
        assert g.n_near == (want if r.doc_id % 100 == 0 else None)
    near = [g.near_edited - g.near_next for g in got.values() if g.n_chars > 300]
    assert sum(x > 0.2 for x in near) > 0.95 * len(near)


def like(x, y):
    return max(0.0, math.cos(math.pi * (x ^ y).bit_count() / 64))


def one(text):
    return simhash.fingerprints_of(*texts.buffers(pa.array([text])))[0]


def test_fingerprint_votes():
    """Signs of the weighted votes, in plain Python."""
    words = "a rose is a rose is a rose and a daisy".split()
    buf, offs = texts.buffers(pa.array(["x", " ".join(words).upper(), ""]))
    low = texts.buffers(pa.array([" ".join(words)]))
    starts, ends, _ = texts.words(*low)
    h = texts.span_hash(texts.byte_hash(low[0]), starts, ends)
    pairs = [int(t) for t in texts.mixed(h[:-1] * np.uint64(3) + h[1:])]
    bits = 0
    for b in range(64):
        vote = sum((1 + math.log(pairs.count(p))) * (1 if p >> b & 1 else -1) for p in set(pairs))
        bits |= (vote > 1e-3) << b
    got = simhash.fingerprints_of(buf, offs)
    assert int(got[1]) == bits and int(got[2]) == 0 and int(got[0]) != 0


def test_texts_do_not_depend_on_neighbours():
    rng = random.Random(1)
    rows = [" ".join(rng.choice(["aa", "b", "Cc", "ddd"]) for _ in range(rng.randrange(80))) for _ in range(200)] + ["w " * 50_000]
    whole = simhash.fingerprints_of(*texts.buffers(pa.array(rows)))
    assert [int(x) for x in whole] == [int(one(t)) for t in rows]


def test_search_finds_all_within_radius(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2 ** 64 - 1) for b in base for _ in range(40)}
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(f, 1 + f % 3) for f in signed], "fp long, n long")
    asked = spark.createDataFrame([(f,) for f in signed[::3]] + [(12345,)], "fp long")
    for radius in (0, 2, 3):
        got = {r.fp: r.n_near for r in simhash.near_counts(asked, table, radius).collect()}
        want = {s: sum(1 + t % 3 for t, g in zip(signed, fps) if (f ^ g).bit_count() <= radius)
                for s, f in list(zip(signed, fps))[::3]}
        assert got == want


def test_edge_rows(edge, edge_rows):
    got = simhash.edit_stability(edge).collect()
    assert len(got) == len(edge_rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.n_chars, r.fp))
    for row in edge_rows:
        assert (len(row[1] or ""), int(one(row[1] or "").view(np.int64))) in by[row[0]]
    plain = simhash.fingerprint(edge)
    assert dict(plain.dtypes)["fp"] == "bigint" and plain.count() == len(edge_rows)


def test_one_row_and_none(edge, empty):
    (r,) = simhash.edit_stability(edge.where("doc_id = 5")).collect()
    text = "three words here"
    assert r.edited_sha256 == hashlib.sha256((text[:12] + text[:4]).encode()).hexdigest()
    assert simhash.edit_stability(empty).collect() == []
