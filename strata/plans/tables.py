"""Lazy access to the driver tables of one scale-factor directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sources.tables import table


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)
