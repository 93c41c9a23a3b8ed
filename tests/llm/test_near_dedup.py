import random
import re

import numpy as np
import xxhash

from strata.llm import near_dedup, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)][:len(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, fps, radius):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        if x is not None:
            least[r] = min(x, least.get(r, x))
    return [least.get(find(i)) for i in range(len(fps))]


def key(x):
    return tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in x)


def test_query_against_brute_force(spark, document_rows):
    got = queries.op10_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()
    ids, fps = [r.doc_id for r in document_rows], [fingerprint(r.text) for r in document_rows]
    want = [(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, groups(ids, fps, 2))]
    assert sorted(map(tuple, got)) == sorted(want)


def test_edge_rows(edge, edge_rows):
    got = near_dedup.near_duplicates(edge).collect()
    ids, fps = [r[0] for r in edge_rows], [fingerprint(r[1]) for r in edge_rows]
    want = [(i, (f ^ 1 << 63) - (1 << 63), c) for i, f, c in zip(ids, fps, groups(ids, fps, 2))]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_no_rows(empty):
    assert near_dedup.near_duplicates(empty).collect() == []


def test_links_of_random_and_clustered_bits(spark):
    """Chains, a dense cluster and random bits, over several levels of small nodes."""
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(400)}
    center = rng.getrandbits(64)
    fps |= {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    x = rng.getrandbits(64)
    for _ in range(60):
        x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        fps.add(x)
    fps = sorted(fps | {0, 1, (1 << 64) - 1})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = dict(map(tuple, near_dedup.components(near_dedup.links(frame, 2, leaf=8, fan=4)).collect()))
    got = [roots.get(f, f) for f in signed]
    want = groups(signed, fps, 2)
    assert got == want


def test_gray_rank_orders_reflected_code(spark):
    codes = [i ^ (i >> 1) for i in range(64)]
    rows = spark.createDataFrame([(c,) for c in codes], "fp long")
    assert [r.fp for r in rows.orderBy(near_dedup.gray_rank(rows.fp)).collect()] == codes
