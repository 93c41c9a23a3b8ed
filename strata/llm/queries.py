"""Registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.oracle import ORACLE  # noqa: F401
from strata.llm.store import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.langid import fit, identify

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = fit(docs.where(~out))
    found = identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "lang_pred",
                        F.col("lang_score").alias("score"), F.size("lang_spans").cast("long").alias("n_spans"))


#: A page is labelled by the documents whose first characters are its title, if there are so many.
TITLE = 40


def page_labels(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) and ``good``: 1 if at least half of the labelled documents that start
    with the title are of quality, else 0, null without one."""
    plain = lambda c: F.substring(F.regexp_replace(F.trim(c), r"\s+", " "), 1, TITLE)
    title = F.regexp_extract("html", "<title>([^<]*)", 1)
    for code, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        title = F.replace(title, F.lit(code), F.lit(char))
    known = docs.select("doc_id", plain(F.substring("text", 1, 4 * TITLE)).alias("start")).join(labels.where("quality IS NOT NULL"), "doc_id")
    known = known.where(F.length("start") == TITLE).groupBy("start").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    known = stored(known, "known-titles")  # a join with a table can be split at a hot title
    return pages.select("page_id", "url", plain(title).alias("start")).join(known, "start", "left").select("page_id", "url", "good")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.url_filter import filter_urls

    pages, docs, labels = (_table(spark, sf_dir, t) for t in ("pages", "documents", "labels"))
    seen = stored(page_labels(pages, docs, labels.select("doc_id", "quality")), "page-labels")
    found = filter_urls(seen, seen["good"], keep=["page_id"])
    return found.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 6).alias("purity"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.secret_scan import joined, scan

    base = ("assign", "access", "hex")
    found = scan(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    kinds = F.transform("secrets", lambda x: x["kind"])
    count = [F.size(F.array_remove(kinds, "")) - F.size(F.array_remove(kinds, k)) for k in base]
    count = [n.cast("long").alias(f"n_{k}") for n, k in zip(count, base)]
    plain = joined(F.filter("secrets", lambda x: x["number"] < len(base)))
    return found.select("doc_id", *count, F.sha2(plain, 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def op4_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_near``: of each searched document (id divisible by 100), the other documents within 3 bits."""
    from strata.llm.simhash import edit_stability, near_counts

    made = stored(edit_stability(_table(spark, sf_dir, "documents").select("doc_id", "text")), "fingerprints")
    asked = made.where("doc_id % 100 = 0").select("fp").distinct()
    near = stored(near_counts(asked, made.groupBy("fp").agg(F.count("*").alias("n")), radius=3), "near-counts")
    found = made.join(near, "fp", "left")
    code = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return found.select("doc_id", "n_chars", "edited_sha256", code("fp").alias("fingerprint"),
                        code("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next",
                        F.expr("CASE WHEN doc_id % 100 = 0 THEN n_near - 1 END").alias("n_near"))


def op5_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.repetition import repetition_quality

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition_quality(docs, keep=["doc_id"])


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.mil import fit, score

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    params = fit(docs.where(~out), _table(spark, sf_dir, "labels").where(~out).select("doc_id", "quality"))
    found = score(docs, params, keep=["doc_id"])
    return found.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), F.col("quality_score").alias("score"),
                        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"), "n_passages", "top_attention")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.line_dedup import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=50)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.mixing import mix

    found = mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), keep=["doc_id", "source", "lang"])
    return found.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"),
                        F.round("mix_prob", 6).alias("prob"), F.col("mix_kept").alias("kept"))


def tokenizer_files() -> tuple[str, str]:
    """Paths of the byte-level tokenizer and of its vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), *tokenizer_files(), width=1024)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.near_dedup import near_duplicates

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_duplicates(docs, shingle=3, radius=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.whitening import fit, identity_error, whiten

    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(vectors, k=8)
    found = stored(whiten(vectors, model, keep=["vec_id"]), "whitened")
    error = identity_error(found)
    share = F.array(*[F.lit(None if x != x else float(x)) for x in model.explained]).cast("array<double>")
    rows = found.select("vec_id", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    return rows.select("vec_id", (F.col("pos") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("pos")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.merkle import folded, leaf_digest, manifest, proof_digest

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = _table(spark, sf_dir, "documents").select(*fields)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    tampered = F.when(hit, leaf_digest(*[F.col(c) for c in fields[:-1]], F.translate("text", upper, upper.lower())))
    found = manifest(docs.withColumn("tampered", tampered), fields, keep=["doc_id", "tampered"])
    again = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    found = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), again.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.decontaminate import covered, hits

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = hits(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"), span=10, keep=["doc_id"])
    n_hit = covered(F.col("hit_spans"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_url_filter, op3_secret_scan, op4_simhash_fingerprints,
    op5_repetition_quality, op6_quality_classifier,
    op7_line_dedup, op8_mixing, op9_packing, op10_simhash_near_dedup,
    op11_whitening, op12_merkle_manifest, op13_decontamination)}
