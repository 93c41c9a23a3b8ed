"""Tables written once in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a scratch folder; a cluster raises an error, as executors would
    not see such a folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-"))
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/strata-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: what depends on partitions is fixed there,
    and a task that is retried reads files instead of repeating the plan."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
