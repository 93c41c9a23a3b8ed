import re

from strata.llm import repetition

WORD = re.compile("[^\x20\x09-\x0d]+")


def covered(words, n, later=False):
    grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    hit = set()
    past = set()
    for i, g in enumerate(grams):
        if seen[g] > 1 and (g in past or not later):
            hit |= set(range(i, i + n))
        past.add(g)
    return hit


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = [x for i, x in enumerate(lines) if x in set(lines[:i])] if len(lines) < 3000 else []
    size = [len(w) for w in words]
    n_symbols, n_repeat = sum(c in "#*$%&|<>" for c in text), len(covered(words, 3))
    dup_chars = sum(len(w) for x in dup for w in WORD.findall(x))
    cover = {n: sum(size[i] for i in covered(words, n, True)) for n in repetition.MAX_COVERAGE}
    failed = len(words) < 50 or 100 * n_repeat > 50 * len(words)
    bad = n_symbols > repetition.MAX_SYMBOLS * len(words) or len(dup) > repetition.MAX_DUP_LINES * len(lines)
    bad = bad or dup_chars > repetition.MAX_DUP_LINE_CHARS * sum(size)
    bad = bad or any(cover[n] > m * sum(size) for n, m in repetition.MAX_COVERAGE.items())
    return (len(words), sum(size), n_symbols, len(dup), n_repeat, len(lines), dup_chars, *cover.values(),
            failed, not failed and not bad)


def test_documents_against_brute_force(documents, document_rows):
    got = {r.doc_id: tuple(r)[1:] for r in repetition.repetition_quality(documents, keep=["doc_id"]).collect()}
    assert got == {r.doc_id: brute(r.text) for r in document_rows}


def test_edge_rows_and_clashing_names(edge, edge_rows):
    out = repetition.repetition_quality(edge)
    assert out.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "fp", "node"]
    names = [f.name for f in repetition.FIELDS]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or ""), tuple(r[n] for n in names)) for r in out.collect())
    assert got == sorted(((r[0] is None, r[0] or 0, r[1] or ""), brute(r[1])) for r in edge_rows)


def test_no_rows(empty):
    assert repetition.repetition_quality(empty).collect() == []
