from lodgepole.sources.domain import raw_table, raw_tables
from lodgepole.sources.readers import (
    jdbc_options,
    jdbc_sources,
    read_catalog_table,
    read_csv,
    read_jdbc,
    read_jdbc_partitioned,
    read_parquet_table,
    stage_csv,
)

__all__ = [
    "jdbc_options",
    "jdbc_sources",
    "raw_table",
    "raw_tables",
    "read_catalog_table",
    "read_csv",
    "read_jdbc",
    "read_jdbc_partitioned",
    "read_parquet_table",
    "stage_csv",
]
