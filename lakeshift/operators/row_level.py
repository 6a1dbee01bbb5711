"""Merges and deletes as commands, for tables whose format changes rows itself.

Plain files have no row-level writes, so the library rewrites partitions there (``merge_table``,
``clustered``). A catalog table of a format that has them is better served by its own MERGE and
DELETE: this module builds the commands from the same ``MergeSpec`` and picks the way by table.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lakeshift.operators.clustered import layout, merge_into_clustered
from lakeshift.operators.merge_table import merge_into_table, stage_source, with_partition_value
from lakeshift.operators.retention import delete_runs
from lakeshift.operators.scd2 import MergeSpec, resolve_names
from lakeshift.sinks.publish import remove_folder

#: Providers whose tables take MERGE INTO and DELETE FROM.
ROW_LEVEL = ("delta", "iceberg", "hudi")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: Any) -> str:
    """A value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, _dt.datetime):
        return f"CAST('{value.isoformat(sep=' ')}' AS TIMESTAMP)"
    if isinstance(value, _dt.date):
        return f"CAST('{value.isoformat()}' AS DATE)"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def merge_command(table: str, source: str, target_columns: list[str], spec: MergeSpec) -> str:
    """MERGE INTO for a merge of the view ``source`` into ``table`` (both names as SQL has them).
    Names are the target's and the source's (``resolve_names``), the partition value is resolved.

    Keys compare null-safely, the open predicate and the literals restrict the target side, and
    the batch condition is part of the match, so a source row that only meets closed or newer
    versions is inserted. A target row with two matches is an error, as the formats raise it."""
    t, s = (lambda c: f"t.{quoted(c)}"), (lambda c: f"s.{quoted(c)}")
    on = [f"{t(k)} IS NOT DISTINCT FROM {s(k)}" for k in dict.fromkeys(spec.keys)]
    if spec.source_filter is not None:
        on.append(f"{t(spec.source_col)} = {literal(spec.source_filter)}")
        if spec.partition_value is not None:
            on.append(f"{t(spec.partition_col)} = {literal(spec.partition_value)}")
    if spec.open_only:
        on.append(f"{t(spec.end_key)} IS NULL")
    if spec.batch_col is not None:
        on.append(f"{t(spec.batch_col)} <= {s(spec.batch_col)}")
    sets = [f"{quoted(c)} = {s(v)}" for c, v in spec.set_from_source.items()]
    sets += [f"{quoted(c)} = {literal(v)}" for c, v in spec.set_literal.items() if c not in spec.set_from_source]
    parts = [f"MERGE INTO {table} AS t USING {source} AS s", "ON " + " AND ".join(on)]
    if sets:
        parts.append("WHEN MATCHED THEN UPDATE SET " + ", ".join(sets))
    columns = target_columns if spec.insert_columns is None else list(dict.fromkeys(spec.insert_columns))
    if columns:
        parts.append(f"WHEN NOT MATCHED THEN INSERT ({', '.join(map(quoted, columns))}) VALUES ({', '.join(map(s, columns))})")
    return "\n".join(parts)


def delete_command(table: str, cutoff: int, run_col: str = "run_id") -> str:
    """DELETE FROM for the runs at or below a cut-off."""
    return f"DELETE FROM {table} WHERE {quoted(run_col)} <= {int(cutoff)}"


def provider(spark: SparkSession, table: str) -> str:
    """The format of a catalog table, in lower case."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else ""


def way_of(spark: SparkSession, table: str) -> str:
    """How rows of a catalog table are changed: "command", "clustered" or "files"."""
    if provider(spark, table) in ROW_LEVEL:
        return "command"
    try:
        layout(spark, table)
        return "clustered"
    except ValueError:
        return "files"


def merge_into(spark: SparkSession, table: str, source: DataFrame, spec: MergeSpec) -> str:
    """Merge into a catalog table by the way that suits it; returns the way. The source is read
    once, whichever it is."""
    way = way_of(spark, table)
    if way == "clustered":
        merge_into_clustered(spark, table, source, spec)
        return way
    target = spark.table(table)
    if way == "files":
        at = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        pcols = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        if not pcols:
            raise ValueError(f"{table} has no partitions: merge a frame of it and replace the table")
        merge_into_table(spark, at["Location"], source, spec, partition_cols=pcols, fmt=provider(spark, table), schema=target.schema)
        spark.sql(f"MSCK REPAIR TABLE {table}")
        spark.catalog.refreshTable(table)
        return way
    source, spec = resolve_names(target, source, spec)
    staged = stage_source(spark, source, spec)
    view = f"lakeshift_source_{uuid.uuid4().hex}"
    staged.rows.createOrReplaceTempView(view)
    try:
        spark.sql(merge_command(table, view, target.columns, with_partition_value(spec, staged)))
    finally:
        spark.catalog.dropTempView(view)
        remove_folder(spark, staged.path)
    return way


def delete_from(spark: SparkSession, table: str, cutoff: int, run_col: str = "run_id") -> str:
    """Delete the runs at or below a cut-off from a catalog table by the way that suits it."""
    if way_of(spark, table) == "command":
        spark.sql(delete_command(table, cutoff, run_col))
        return "command"
    at = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" in at:
        raise ValueError(f"{table} is stored in buckets; rewrite it with write_clustered")
    done = delete_runs(spark, at["Location"], cutoff, run_col, provider(spark, table))
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return done
