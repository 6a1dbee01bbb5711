"""DataFrame -> DataFrame operators: merges, de-duplication, retention, cycles, lookups."""

from lakeshift.operators.cycles import read_cycle
from lakeshift.operators.dedup import dedup_by_key, distinct_values
from lakeshift.operators.lookup import active_rows, lookup
from lakeshift.operators.scd2 import (
    MergeSpec,
    close_and_insert,
    discover_partition_value,
    expire,
    historical_update_keys,
    merge,
    scd2_keys,
    update_columns,
    upsert,
)

__all__ = [
    "MergeSpec",
    "active_rows",
    "close_and_insert",
    "dedup_by_key",
    "discover_partition_value",
    "distinct_values",
    "expire",
    "historical_update_keys",
    "lookup",
    "merge",
    "read_cycle",
    "scd2_keys",
    "update_columns",
    "upsert",
]
