"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; if it is unset, a scratch folder of a local session
    (tests), and an error on a cluster, where executors would not see such a folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-llm-"))
        named = spark.sparkContext.getCheckpointDir()
    return named


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the table read back.

    Cuts lineage: a task that is retried after an executor is lost re-reads files that every
    executor sees, and values that depend on partition numbers are fixed from here on.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/strata-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
