import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from test_line_dedup import WORD, brute
from test_near_dedup import fingerprint, groups
from test_packing import check, tokenizer  # noqa: F401

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def by_name(name):
    return dict(pipeline.STAGES)[name]


def test_language_stage_rejects_what_has_no_language(spark, documents, edge):
    assert rows(by_name("language ID")(spark, documents, SF)) == rows(documents)
    kept = by_name("language ID")(spark, documents.unionByName(edge.select(*documents.columns)), SF).collect()
    assert all(any(c.isalpha() for c in r.text) for r in kept)
    assert all(r.lang for r in kept)


def test_language_stage_keeps_mixed_text_and_rejects_unlearned_script(spark, documents):
    long = {r.lang: r for r in documents.where("length(text) > 900").collect()}
    even = "\n".join(long[la].text[:600] for la in ("en", "de", "fr", "es"))
    greek = "Η γλώσσα είναι ένα σύστημα επικοινωνίας με λέξεις και κανόνες " * 40
    own = spark.createDataFrame([(10**9 + i, t, None, "s", len(t)) for i, t in enumerate((even, greek))], documents.schema)
    kept = by_name("language ID")(spark, documents.unionByName(own), SF).where(F.col("doc_id") >= 10**9).collect()
    assert [r.text for r in kept] == [even]


def test_line_stage(spark, documents, document_rows):
    got = by_name("line dedup")(spark, documents, SF)
    assert got.columns == documents.columns
    want = brute([(r.doc_id, r.text) for r in document_rows], 50)
    want = {k: t for k, (t, n) in want.items() if not n or WORD.search(t)}
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_near_copies_stage(spark, documents, document_rows):
    got = by_name("SimHash near-dedup")(spark, documents.unionByName(documents.limit(3)), SF)
    ids = [r.doc_id for r in document_rows]
    least = set(groups(ids, [fingerprint(r.text) for r in document_rows], 2))
    assert rows(got) == sorted(tuple(r) for r in document_rows if r.doc_id in least)
    assert len(least) < len(ids)


def test_near_copies_of_edge_rows(spark, edge, edge_rows):
    got = by_name("SimHash near-dedup")(spark, edge, SF)
    ids = [r[0] for r in edge_rows]
    assert got.columns == edge.columns
    assert got.count() == len(set(groups(ids, [fingerprint(r[1]) for r in edge_rows], 2)))


def test_extra_columns_stay_whatever_their_names(spark, documents):
    names = ["lang_pred", "Lang_Score", "n_removed", "mix_kept", "Mix_Topic", "others", "row", "k1", "fp", "runs", "group", "rules", "_text", "tokens"]
    docs = documents.limit(40).withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    for _, stage in pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
        kept = got.collect()
        assert kept and all(r[c] == f"{c}{r.doc_id}" for r in kept for c in names)
    assert stage is not pipeline.STAGES[-1][1] and pipeline.STAGES[-1][1](spark, docs, SF).count() >= 40


def test_run(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = pipeline.run(spark, SF).collect()
    check(got, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def test_no_rows(spark, documents):
    docs = documents.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
