"""File readers.  Every reader takes an explicit schema where the layout is
known, so no inference pass runs over large inputs."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_json_documents(spark: SparkSession, path: str, schema: StructType | None = None,
                        multiline: bool = True) -> DataFrame:
    """JSON files, one document per file (``multiline``) or per line."""
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_text(spark: SparkSession, texts: DataFrame, column: str = "value",
                   schema: StructType | str | None = None) -> DataFrame:
    """Parse JSON held in a text column of a DataFrame (one document per row).

    With no schema, one is found first by an aggregate over the texts (object
    fields in alphabetical order); texts that are not JSON give null rows.
    """
    if schema is None:
        parsed = F.schema_of_variant_agg(F.try_parse_json(column))
        found = texts.agg(parsed.alias("s")).first()["s"]
        schema = found.replace("OBJECT<", "STRUCT<") if found and found != "VOID" else "STRUCT<>"
    return texts.select(F.from_json(column, schema).alias("_doc")).select("_doc.*")


def read_documents(spark: SparkSession, path: str, fmt: str = "parquet",
                   schema: StructType | None = None, **options) -> DataFrame:
    """A document collection stored as nested parquet / JSON / ORC."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_sales_csv(spark: SparkSession, path: str, schema: StructType | str,
                   date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV with a header row and typed columns; date columns parsed by format."""
    return (spark.read.option("header", True).option("dateFormat", date_format)
            .schema(schema).csv(path))


def read_ctrl_a(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Header-less text with byte 0x01 between fields; every field a string."""
    reader = spark.read.option("sep", "\x01").option("header", False).option("encoding", "UTF-8")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Fully quoted CSV, doubled quotes inside fields, blanks after separators."""
    return (spark.read.option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", True).option("header", False)
            .schema(schema).csv(path))


def read_unquoted_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Plain comma-separated rows, fields taken by position."""
    return spark.read.option("header", False).option("quote", "\u0000").schema(schema).csv(path)


def parse_quoted_csv_text(text: str) -> list[list[str]]:
    """Parse a small, bounded in-memory CSV text (codebooks shipped with code)."""
    return [row for row in csv.reader(text.splitlines(), skipinitialspace=True) if row]


def parse_unquoted_csv_text(text: str) -> list[list[str]]:
    return [line.split(",") for line in text.splitlines() if line.strip()]


def literal_rows(spark: SparkSession, rows, schema: StructType | str) -> DataFrame:
    """A small literal table with an explicit schema (no type inference)."""
    return spark.createDataFrame(list(rows), schema)
