"""The corpus pipeline over ``documents``: stages in order, each calling one operator of ``strata.llm``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import langid, line_dedup, mixing, near_dedup, packing
from strata.llm.queries import tokenizer_files
from strata.llm.store import shared_dir

#: Least sureness of the labelled spans; below it, or without a letter, a document is rejected.
MIN_LANG_SURE = 0.3


def boxed(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that an operator uses, and all others in one: their names can't clash with its own."""
    return docs.select(*used, F.struct(F.lit(1).alias("_"), *[docs[f"`{c}`"] for c in docs.columns if c not in used]).alias("others"))


def unboxed(rows: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """Rows with the columns of ``docs`` in their order."""
    return rows.select(*[(F.col(c) if c in used else F.col("others").getField(c)).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without identifiable languages go, mixed ones stay; a missing ``lang`` becomes the identified one."""
    found = langid.identify(boxed(docs, "text", "lang"), langid.fit(docs))
    found = found.where((F.col("lang_pred") != langid.UND) & (F.col("lang_sure") >= MIN_LANG_SURE))
    return unboxed(found.withColumn("lang", F.coalesce("lang", "lang_pred")), docs, "text", "lang")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; a document of which no word is left goes with them."""
    used = ("doc_id", "text", "n_chars")
    found = line_dedup.dedup_lines(boxed(docs, *used), min_words=50)
    found = found.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return unboxed(found.withColumn("n_chars", chars), docs, *used)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return near_dedup.keep_one(docs, shingle=3, radius=2)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target weights of source, language and topic."""
    used = ("doc_id", "text", "source", "lang")
    return unboxed(mixing.mix(boxed(docs, *used)).where("mix_kept"), docs, *used)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, with their token ids, in sequences of 1024."""
    return packing.pack(docs, *tokenizer_files(), width=1024, ids=True)


STAGES = [("language ID", language), ("line dedup", repeated_lines), ("SimHash near-dedup", near_copies),
          ("mixing", mixture), ("packing", packed)]

#: Language identification learns its model, and fingerprints need XXH64: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{shared_dir(spark).rstrip('/')}/strata-stage-{k}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
