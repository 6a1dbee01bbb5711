"""Path rules for vault tables, the clean zone and raw files. The root is always a parameter."""

from __future__ import annotations


def split_table_name(table_name: str, schema_override: str | None = None) -> tuple[str, str]:
    """``schema.table`` -> (schema, table lowered). Undotted names use the name as schema
    and table (lowered), unless a schema override is given."""
    parts = str(table_name).split(".")
    if len(parts) > 1:
        schema, table = parts[0], parts[1].lower()
    else:
        schema, table = parts[0], parts[0].lower()
    if schema_override:
        schema = str(schema_override)
    return schema, table


def table_path(root: str, table_name: str, schema_override: str | None = None) -> str:
    """``<root>/<SCHEMA upper>/<table lower>``."""
    schema, table = split_table_name(table_name, schema_override)
    return f"{root.rstrip('/')}/{schema.upper()}/{table}"


def clean_path(base: str, source: str, schema: str, table: str, batch_date: str) -> str:
    """``<base>/<source>/<schema>/<table>/<batchDate>``."""
    return f"{base.rstrip('/')}/{source}/{schema}/{table}/{batch_date}"


def raw_path(base: str, source: str, schema: str, table: str, batch_date: str, file_format: str,
             file_name: str = "") -> str:
    """``<base>/<source>/<schema>/<table>/<table>_<batchDate>.<fmt>``, or an explicit file name."""
    folder = f"{base.rstrip('/')}/{source}/{schema}/{table}"
    if file_name:
        return f"{folder}/{file_name}"
    return f"{folder}/{table}_{batch_date}.{file_format}"
