"""lakeshift — warehouse load, SCD2 merge and retention jobs on the PySpark DataFrame API.

Every public operator takes and returns DataFrames; nothing is collected to
the driver except bounded metadata (configuration rows, one-row size and
partition checks, a bounded list of partition keys).
"""

from lakeshift.functions.predicates import ReadSpec, read_filter, resolve_read_spec, resolve_window
from lakeshift.operators.merge_table import merge_into_table
from lakeshift.operators.scd2 import (
    MergeSpec,
    close_and_insert,
    close_and_insert_spec,
    expire,
    expire_spec,
    merge,
    update_columns,
    update_columns_spec,
    upsert,
    upsert_spec,
)

__all__ = [
    "MergeSpec",
    "ReadSpec",
    "close_and_insert",
    "close_and_insert_spec",
    "expire",
    "expire_spec",
    "merge",
    "merge_into_table",
    "read_filter",
    "resolve_read_spec",
    "resolve_window",
    "update_columns",
    "update_columns_spec",
    "upsert",
    "upsert_spec",
]
