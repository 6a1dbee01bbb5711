"""Scans: tables by path or connector, raw CSV/XML, JDBC marts, schema and file catalogues."""

from lakeshift.sources.catalog import latest_files, schema_catalog
from lakeshift.sources.jdbc import jdbc_read_options, partition_column, read_mart, route
from lakeshift.sources.paths import clean_path, raw_path, split_table_name, table_path
from lakeshift.sources.raw import read_raw
from lakeshift.sources.tables import read_catalog, read_connector, read_reference, read_table

__all__ = [
    "clean_path",
    "jdbc_read_options",
    "latest_files",
    "partition_column",
    "read_catalog",
    "raw_path",
    "read_connector",
    "read_mart",
    "read_raw",
    "read_reference",
    "read_table",
    "route",
    "schema_catalog",
    "split_table_name",
    "table_path",
]
