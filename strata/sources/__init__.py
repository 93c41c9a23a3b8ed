"""Readers and writers."""

from strata.sources.tables import DRIVER_TABLES, table, catalog_table
from strata.sources.files import (read_json_documents, read_json_text, read_documents,
                                  read_sales_csv, read_ctrl_a, read_quoted_csv,
                                  read_unquoted_csv, literal_rows, parse_quoted_csv_text,
                                  parse_unquoted_csv_text)
from strata.sources.bson import read_bson, write_bson
from strata.sources.writers import (overwrite_partitions, overwrite_partitions_at, write_csv,
                                    write_ctrl_a, write_quoted_csv, write_unquoted_csv, append_to,
                                    insert_by_name, row_count, schema_rows, peek)

__all__ = [
    "read_bson", "write_bson", "DRIVER_TABLES", "table", "catalog_table", "read_json_documents",
    "read_json_text", "read_documents", "read_sales_csv", "read_ctrl_a", "read_quoted_csv",
    "read_unquoted_csv", "literal_rows", "parse_quoted_csv_text", "parse_unquoted_csv_text",
    "overwrite_partitions", "overwrite_partitions_at", "write_csv", "write_ctrl_a",
    "write_quoted_csv", "write_unquoted_csv", "append_to", "insert_by_name", "row_count",
    "schema_rows", "peek",
]
