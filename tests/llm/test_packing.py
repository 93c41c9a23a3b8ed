import random
import zlib

import numpy as np
import pytest

from strata.llm import packing, queries

COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, docs, tokenizer, width=1024):
    """Exact round trip of every document's ids, and the sequences' sizes."""
    want = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in docs]
    pieces, by = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == {i for i, _ in want}
    for i, ids in want:
        assert any(r["doc_tokens"] == len(ids) for r in pieces[i])
    for i, mine in pieces.items():
        copies = [ids for j, ids in want if j == i]
        left = sorted((r["start"], r["length"], r["ids_crc32"]) for r in mine)
        if len(copies) == 1:
            at = 0
            for s, n, crc in left:
                assert s == at and n > 0 and crc == zlib.crc32(np.array(copies[0][s:s + n], "<u4").tobytes())
                at += n
            assert at == len(copies[0])
        else:
            assert sum(n for _, n, _ in left) == sum(map(len, copies))
    padded = 0
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= width
        padded += 0 if at & (at - 1) == 0 else width - at
    return padded / max(1, sum(len(x) for _, x in want))


def test_query_round_trip(spark, document_rows, tokenizer):
    got = queries.op9_packing(spark, "/root/testdata/sf0.001")
    assert got.columns == COLUMNS
    padded = check(got.collect(), [(r.doc_id, r.text) for r in document_rows], tokenizer)
    assert padded < 0.03


def test_cuts_against_all_pairs():
    rng = random.Random(4)
    for _ in range(40):
        width, at, places, penalty = 32, 0, [0], [0]
        for _ in range(rng.randrange(1, 60)):
            at += rng.randrange(1, rng.choice([4, 12, 33]))
            places.append(at)
            penalty.append(rng.choice([0, 4, 64]))
        places, penalty = np.array(places), np.array(penalty)
        pad = lambda n: 0 if n & (n - 1) == 0 else width - n
        f = [0]
        for j in range(1, len(places)):
            f.append(min(f[i] + pad(int(places[j] - places[i])) for i in range(j) if places[j] - places[i] <= width)
                     + int(penalty[j]) + packing.SEQUENCE)
        cuts = packing.cuts_of(places, penalty, width).tolist()
        cost = dict(zip(places.tolist(), penalty.tolist()))
        assert cuts[0] == 0 and cuts[-1] == places[-1] and max(np.diff(cuts)) <= width
        assert sum(pad(b - a) + cost[b] + packing.SEQUENCE for a, b in zip(cuts, cuts[1:])) == f[-1]


def test_edge_rows(edge, edge_rows, tokenizer):
    got = packing.pack(edge, *queries.tokenizer_files(), ids=True)
    check(got.collect(), [(r[0], r[1]) for r in edge_rows], tokenizer)
    for r in got.collect():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_special_token_in_text_and_long_sentence(spark, tokenizer):
    rows = [(1, "before <|endoftext|> after."), (2, "word " * 5000), (3, "")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id int, text string"), *queries.tokenizer_files())
    check(got.collect(), rows, tokenizer)


@pytest.mark.parametrize("n", [600, 700, 1500, 90])
def test_documents_without_sentence_ends_are_cut_freely(spark, tokenizer, n):
    rows = [(i, " word" * (n + i % 7)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    got = packing.pack(docs, *queries.tokenizer_files()).collect()
    assert check(got, rows, tokenizer) < 0.05


def test_sentence_stops_of_other_scripts(spark, tokenizer):
    for sentence in ("这是一个没有空格的句子。", "यह एक छोटा वाक्य है। ", "هل هذه جملة؟ ", "これは文です！"):
        text = sentence * 400
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        one = len(tokenizer.encode(sentence * 2, add_special_tokens=False).ids) - len(tokenizer.encode(sentence, add_special_tokens=False).ids)
        rows = [(1, text)]
        got = packing.pack(spark.createDataFrame(rows, "doc_id int, text string"), *queries.tokenizer_files()).collect()
        check(got, rows, tokenizer)
        stop = sentence.strip()[-1]
        ended = [tokenizer.decode(ids[:r.start + r.length]).rstrip().endswith(stop) for r in got]
        assert one < 60 and len(ended) > 3 and np.mean(ended) >= 0.7, (sentence, ended)


def test_no_rows(empty):
    assert packing.pack(empty, *queries.tokenizer_files()).collect() == []
