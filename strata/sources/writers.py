"""Writers and small actions.

All writers are DataFrame writes executed by the executors; nothing is routed
through the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def _dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """``df`` in so many partitions, and so as many files a table partition at most."""
    if partitions is None:
        return df
    return df.coalesce(1) if partitions == 1 else df.repartition(partitions)


def overwrite_partitions(df: DataFrame, table_name: str, partitions: int | None = None) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite) of a datasource table.

    Columns are taken by name and cast to the table's types.  ``insertInto``
    ignores the per-write option and would need the session's conf, which other
    writes of the session read too.  So the rows go to the table's own location
    with the mode as an option of this write alone, and new partitions are then
    made known to the catalog.  A write that fails leaves the old partitions: files
    are staged and swapped when all tasks are done.
    """
    spark = df.sparkSession
    found = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table_name} AS JSON").first()[0])
    keys = found.get("partition_columns") or []
    if not keys:
        raise ValueError(f"{table_name} has no partition columns")
    target = spark.table(table_name).schema
    rows = df.select(*[df[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in target])
    overwrite_partitions_at(rows, found["location"], keys, fmt=found["provider"], partitions=partitions)
    if found.get("partition_provider", "").lower() == "catalog":
        spark.sql(f"ALTER TABLE {table_name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table_name)


def overwrite_partitions_at(df: DataFrame, path: str, partition_by: list[str],
                            fmt: str = "parquet", partitions: int | None = None) -> None:
    """Dynamic partition overwrite of a path-based dataset."""
    (_dealt(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).format(fmt).save(path))


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite",
              partitions: int | None = None) -> None:
    """CSV with a header.  Array/struct columns are rendered as text first,
    because the CSV sink rejects them.  ``single_file`` funnels the result
    through one task: use it only for small, aggregated results."""
    from pyspark.sql.types import ArrayType, MapType, StructType
    cols = [F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.col(f.name)
            for f in df.schema.fields]
    _dealt(df.select(*cols), 1 if single_file else partitions).write.mode(mode).option("header", True).csv(path)


def _plain_writer(df: DataFrame, mode: str, **options):
    return (df.write.mode(mode).option("header", False).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).options(**options))


def write_ctrl_a(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header-less text with byte 0x01 between fields (see ``read_ctrl_a``)."""
    _plain_writer(df, mode, sep="\x01", encoding="UTF-8").csv(path)


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Fully quoted CSV with doubled quotes inside fields (see ``read_quoted_csv``); nulls read back as empty text."""
    _plain_writer(df, mode, quoteAll=True, quote='"', escape='"').csv(path)


def write_unquoted_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Plain comma-separated rows (see ``read_unquoted_csv``): for fields without commas or line ends."""
    _plain_writer(df, mode, quote="\u0000").csv(path)


def append_to(df: DataFrame, path: str | None = None, table_name: str | None = None,
              fmt: str = "parquet", partitions: int | None = None) -> None:
    """Append a result to a collection (path) or a catalog table."""
    df = _dealt(df, partitions)
    if table_name is not None:
        df.write.mode("append").format(fmt).saveAsTable(table_name)
    else:
        df.write.mode("append").format(fmt).save(path)


def insert_by_name(df: DataFrame, table_name: str) -> None:
    """Insert matching columns by name; target columns missing from ``df``
    (e.g. a field that was null and left out) become null."""
    spark = df.sparkSession
    view = f"_strata_insert_{uuid.uuid4().hex}"
    df.createTempView(view)
    try:
        spark.sql(f"INSERT INTO {table_name} BY NAME SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """Row count as a one-row DataFrame (distributed partial counts)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows (column, type, nullable) - a tabular printSchema."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, type string, nullable boolean")


def peek(df: DataFrame, n: int, order_by=None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` the pick is deterministic (top-k, no full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
