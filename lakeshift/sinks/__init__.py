"""Writers for tables, partitioned appends, JDBC targets and CSV extracts."""

from lakeshift.sinks.writers import (
    export_csv,
    export_csv_file,
    replace_table,
    write_clean,
    write_connector,
    write_jdbc,
    write_mart,
    write_partitioned,
    write_table,
)

__all__ = [
    "export_csv",
    "export_csv_file",
    "replace_table",
    "write_clean",
    "write_connector",
    "write_jdbc",
    "write_mart",
    "write_partitioned",
    "write_table",
]
