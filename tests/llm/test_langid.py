import numpy as np
import pytest

from strata.llm import langid, queries, texts


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def plain_viterbi(score):
    value, back = score[0].astype(float), []
    for s in score[1:]:
        step = value[:, None] - langid.SWITCH * (1 - np.eye(len(value)))
        back.append(step.argmax(0))
        value = step.max(0) + s
    path = [int(value.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], value.max()


def cost(score, path):
    return sum(score[i, p] for i, p in enumerate(path)) - langid.SWITCH * sum(a != b for a, b in zip(path, path[1:]))


def test_batched_viterbi_and_shortcut_against_plain():
    rng = np.random.default_rng(3)
    size = [0, 1, 40, 7, 300, 0, 90, 1200]
    at = np.r_[0, np.cumsum(size)]
    score = rng.normal(-1.5, 1, (at[-1], 4)).clip(-langid.CLIP, 0)
    for a in range(0, at[-1], 60):  # runs in one language, short and long
        score[a:a + rng.integers(5, 60), rng.integers(4)] = 0
    score -= score.max(1, keepdims=True)
    doc = texts.owner(at)
    full = np.flatnonzero(size)
    best = np.zeros(len(size), int)
    best[full] = np.add.reduceat(score, at[full], axis=0).argmax(1)
    calm, label = langid._one_language(score, at, doc, best), best[doc]
    langid._viterbi(score, at, np.flatnonzero(~calm), label)
    assert 0 < calm.sum() < len(size)
    for i in full:
        s = score[at[i]:at[i + 1]]
        assert cost(s, label[at[i]:at[i + 1]]) == pytest.approx(plain_viterbi(s)[1])


def test_shortcut_where_a_third_language_is_best_in_total():
    score = np.array([[0, -5, -2.4]] * 4 + [[-5, 0, -2.4]] * 4)
    at, doc, best = np.array([0, 8]), np.zeros(8, int), np.array([2])
    assert score.sum(0).argmax() == 2
    label = best[doc]
    langid._viterbi(score, at, np.flatnonzero(~langid._one_language(score, at, doc, best)), label)
    assert label.tolist() == plain_viterbi(score)[0] == [0] * 4 + [1] * 4


def test_held_out_accuracy(spark):
    got = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    out = got[got.held_out]
    assert 150 < len(out) < 350 and len(got) == 1000
    assert (out.lang_pred == out.lang).mean() > 0.99
    assert got.score.between(0, 1).all()


def test_spans_of_mixed_text(spark, model):
    rows = {r.lang: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 1500").collect()}
    mixed = rows["de"][:700] + "\n" + rows["es"][:900]
    docs = spark.createDataFrame([(mixed,)], "text string")
    (got,) = langid.identify(docs, model).collect()
    assert [s.lang for s in got.lang_spans] == ["de", "es"]
    assert (got.lang_spans[0].start, got.lang_spans[-1].end) == (0, len(mixed.split()))
    assert abs(got.lang_spans[0].end - len(rows["de"][:700].split())) <= 3


def test_script_narrows_candidates(spark):
    docs = spark.createDataFrame([(i, t, la) for i, (t, la) in enumerate([("слово речь мир", "ru"), ("word speech peace", "en")] * 20)],
                                 "doc_id long, text string, lang string")
    model = langid.fit(docs)
    got = [r.lang_pred for r in langid.identify(spark.createDataFrame([("мирная речь zz",), ("unseen letters",)], "text string"), model).collect()]
    assert got == ["ru", "en"]


def test_edge_rows(edge, edge_rows, model):
    out = langid.identify(edge, model)
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert out.count() == len(edge_rows)
    for row in edge_rows:
        r = got[row[0], row[1]]
        if not any(c.isalpha() for c in row[1] or ""):
            assert (r.lang_pred, r.lang_score) == ("und", 0)
        else:
            assert r.lang_pred in model.langs and 0 < r.lang_score <= 1
            assert r.lang_spans[-1].end == len(row[1].split())


def test_no_rows_and_no_labels(empty, edge):
    model = langid.fit(empty)
    assert model.langs == [] and langid.identify(empty, model).collect() == []
    assert {r.lang_pred for r in langid.identify(edge, model).collect()} == {"und"}


def test_sureness_of_mixed_text_and_of_unlearned_script(spark, model):
    rows = {r.lang: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 1500").collect()}
    even = "\n".join(rows[la][:600] for la in ("en", "de", "fr", "es"))
    thai = "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำแน่นอน หรือวรรณยุกต์เช่นเดียวกับภาษาจีน " * 40
    greek = "Η γλώσσα είναι ένα σύστημα επικοινωνίας με λέξεις και κανόνες " * 40
    docs = spark.createDataFrame([(0, even), (1, thai), (2, greek), (3, rows["en"][:600] + "\n" + thai[:60])], "k int, text string")
    got = {r.k: r for r in langid.identify(docs, model).collect()}
    assert {s.lang for s in got[0].lang_spans} == {"en", "de", "fr", "es"} and got[0].lang_score < 0.3
    assert got[0].lang_sure > 0.9 and got[3].lang_sure > 0.8
    for k in (1, 2):
        assert got[k].lang_sure == 0 and got[k].lang_score <= 0.5 and got[k].lang_pred == model.langs[0]


def plain_buckets(word):
    """Buckets of a word's features, one n-gram after the other."""
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in word)
    padded = b"\0" + low + b"\0"
    mixed = lambda x: int(texts.mixed(np.array([x], np.uint64))[0]) >> 48 & (langid.BUCKETS - 1)
    out = [mixed(int.from_bytes(padded[i:i + n], "little") + (n << 40)) for n in (2, 3, 4) for i in range(len(padded) - n + 1)]
    own = np.frombuffer(low, np.uint8)
    return out + [mixed(int(texts.span_hash(texts.byte_hash(own), np.array([0]), np.array([len(own)]))[0]))]


def test_counts_and_word_scores_against_plain_loops(spark):
    said = {"en": ["the cat and the dog", "The end of THE day 12"], "de": ["der Hund und die Katze", "das Ende des Tages ß"], "ru": ["кот и собака", "день и ночь"]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in said.items() for t in ts)]
    model = langid.fit(spark.createDataFrame(rows + [(9, None, "en"), (8, "no language", None)], "doc_id long, text string, lang string"))
    langs = sorted(said)
    counts = np.full((langid.BUCKETS, len(langs)), 0.5)
    for lang, ts in said.items():
        for word in " ".join(ts).split():
            if any(c.isalpha() for c in word):
                for b in plain_buckets(word.encode()):
                    counts[b, langs.index(lang)] += 1
    log = np.log(counts / counts.sum(0))
    assert model.langs == langs and np.allclose(model.table, log - log.max(1, keepdims=True), atol=1e-5)
    writes = {"c": {"en", "de"}, "к": {"ru"}}
    words = "the Hund кот Tages unseen день the".split()
    buf = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = texts.words(buf, np.array([0, len(buf)]))
    got, letters, known = langid._word_scores(buf, starts, ends, model)
    assert letters.all() and known.all()
    for k, word in enumerate(words):
        found = plain_buckets(word.encode())
        score = np.array([sum(model.table[b, j] for b in found) for j in range(3)]) / len(found) ** 0.5
        score = np.maximum(score - score.max(), -langid.CLIP)
        may = writes["c" if word.isascii() else "к"]
        score = np.array([s if lang in may else -langid.CLIP for s, lang in zip(score, langs)])
        assert np.allclose(got[k], score - score.max(), atol=1e-3), word
    # one language throughout: its share of letters is 1, the lead over the next one makes the score
    (lang,), (score,), _, _ = (x.to_pylist() for x in langid.label_texts(buf[:3], np.array([0, 3]), model))
    gap = np.sort(got[0].astype(float))[-1] - np.sort(got[0].astype(float))[-2]
    assert lang == "en" and score == pytest.approx(1 / (1 + np.exp(-min(gap, 50))), abs=1e-3)
