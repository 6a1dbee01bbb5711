"""Writers: generic table/connector writes, clean zone, partitioned appends, JDBC, CSV extracts,
and a safe replacement of a table that the written frame was read from."""

from __future__ import annotations

import csv
import datetime as _dt
import io
import logging
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.functions.text import as_text
from lakeshift.session import scratch_path
from lakeshift.sinks.publish import concatenate, remove_folder, same_store, swap_table
from lakeshift.sources.paths import clean_path
from lakeshift.sources.tables import load_table, partition_columns

log = logging.getLogger(__name__)

# Write modes and the partition columns of vault tables.
MODES = ("append", "overwrite")
VAULT_PARTITION_COLUMNS = ("REC_SRC_NM", "PART_COL")
JDBC_WRITE_PARTITIONS = 10
BULK_BATCH_SIZE = 100_000


def _mode(mode: str) -> str:
    if str(mode) not in MODES:
        raise ValueError(f"write mode must be one of {MODES}, got {mode!r}")
    return str(mode)


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite", fmt: str = "parquet",
                options: Mapping[str, str] | None = None) -> str:
    df.write.mode(_mode(mode)).format(fmt).options(**dict(options or {})).save(path)
    return path


def write_connector(df: DataFrame, fmt: str, options: Mapping[str, str], *, mode: str = "append") -> None:
    """Any connector (``format`` + options), e.g. a wide-column store."""
    df.write.format(fmt).options(**dict(options)).mode(_mode(mode)).save()


def write_clean(df: DataFrame, base: str, source: str, schema: str, table: str, batch_date: str, *,
                mode: str = "overwrite", fmt: str = "parquet") -> str:
    """Clean-zone write to ``<base>/<source>/<schema>/<table>/<batchDate>``."""
    return write_table(df, clean_path(base, source, schema, table, batch_date), mode=mode, fmt=fmt)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] | str = VAULT_PARTITION_COLUMNS,
                      *, mode: str = "append", fmt: str = "parquet") -> str:
    """Partitioned write. The REBALANCE hint asks AQE to group rows by the partition columns
    and to split oversized groups, so a source system holding a third of the rows is written
    by many tasks (several files per directory) and small partitions are merged."""
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    (df.hint("rebalance", *cols).write.mode(_mode(mode)).format(fmt)
     .partitionBy(*cols).save(path))
    return path


def replace_table(spark: SparkSession, df: DataFrame, path: str, *, fmt: str = "parquet",
                  partition_cols: Sequence[str] | None = None) -> str:
    """Overwrite ``path`` with ``df`` even when ``df`` reads ``path``. Returns the stage folder.

    The rows are written once, to a fresh folder under the shared checkpoint directory, and the
    complete folder is then put in the table's place (``sinks.publish.swap_table``, which also
    finishes an interrupted swap). ``partition_cols`` None keeps the table's own partitioning."""
    if partition_cols is None:
        partition_cols = partition_columns(spark, path, fmt)
    stage = scratch_path(spark, "replace")
    log.info("the new rows of %s are staged at %s", path, stage)
    if partition_cols:
        write_partitioned(df, stage, list(partition_cols), mode="overwrite", fmt=fmt)
    else:
        df.write.mode("overwrite").format(fmt).save(stage)
    if same_store(spark, stage, path):
        swap_table(spark, stage, path)
        return stage
    staged = load_table(spark, stage, fmt, schema=df.schema).select(df.columns)
    writer = staged.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_cols) if partition_cols else writer).save(path)
    remove_folder(spark, stage)
    return stage


def write_jdbc(df: DataFrame, url: str, dbtable: str, *, mode: str = "append", driver: str | None = None,
               num_partitions: int = JDBC_WRITE_PARTITIONS, batch_size: int | None = None,
               isolation_level: str | None = None, fmt: str = "jdbc",
               extra: Mapping[str, str] | None = None) -> None:
    """JDBC append/overwrite over at most ``num_partitions`` connections. Bulk connectors take
    ``fmt`` and their own options (table lock, reliability level, ...) through ``extra``."""
    opts = {"url": url, "dbtable": dbtable, "numPartitions": str(num_partitions)}
    if driver:
        opts["driver"] = driver
    if batch_size:
        opts["batchsize"] = str(batch_size)
    if isolation_level:
        opts["isolationLevel"] = isolation_level
    opts.update(dict(extra or {}))
    df.write.format(fmt).options(**opts).mode(_mode(mode)).save()


# CSV layout equal to a pandas ``to_csv`` (header, comma, UTF-8, quotes escaped by
# doubling, empty strings unquoted, blanks kept, timestamps with a space and, where it is not
# zero, a fraction of six digits).
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "dateFormat": "yyyy-MM-dd",
}


def extract_name(prefix: str, as_of: _dt.date) -> str:
    return f"{prefix}_{as_of.strftime('%Y%m%d')}.csv"


def _timestamp_text(column: Column) -> Column:
    fraction = F.date_format(column, "SSSSSS")
    return F.when(fraction == "000000", F.date_format(column, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def export_csv(df: DataFrame, folder: str, prefix: str, *, as_of: _dt.date | None = None) -> dict:
    """Dated CSV extract: a folder ``<folder>/<prefix>_<yyyymmdd>.csv`` of part files, each with
    the header, written by all tasks in parallel (no single task or driver sees all rows).
    An empty frame writes nothing and returns status "empty"."""
    when = as_of or _dt.date.today()
    name = extract_name(prefix, when)
    if df.isEmpty():
        return {"status": "empty", "file_name": name, "extractPathFolder": folder, "columnDelimiter": ","}
    stamps = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    out = df.select(*[_timestamp_text(F.col(f"`{c}`")).alias(c) if c in stamps else F.col(f"`{c}`") for c in df.columns])
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(f"{folder.rstrip('/')}/{name}")
    return {"status": "success", "file_name": name, "extractPathFolder": folder, "columnDelimiter": ","}


def _resolutions(df: DataFrame) -> tuple[int, dict[str, str]]:
    """The number of rows, and for each column of times the pattern that shows all of them: days
    alone, seconds, or a fraction of three or six digits. One pass over these columns."""
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    counts = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(stamps):
        col = F.col(f"`{c}`")
        part = F.date_format(col, "SSSSSS").cast("int")
        counts += [F.max(part % 1000 != 0).alias(f"us{i}"), F.max(part != 0).alias(f"ms{i}"),
                   F.max(F.date_format(col, "HHmmss") != "000000").alias(f"s{i}")]
    row = df.agg(*counts).first()
    day = "yyyy-MM-dd"
    return row["n"], {
        c: f"{day} HH:mm:ss.SSSSSS" if row[f"us{i}"] else f"{day} HH:mm:ss.SSS" if row[f"ms{i}"]
        else f"{day} HH:mm:ss" if row[f"s{i}"] else day
        for i, c in enumerate(stamps)}


def export_csv_file(df: DataFrame, folder: str, prefix: str, *, as_of: _dt.date | None = None,
                    order_by: Sequence[str] = ()) -> dict:
    """Dated CSV extract as one file ``<folder>/<prefix>_<yyyymmdd>.csv``, as pandas writes it:
    one header, floats and booleans as Python's ``str``, NaN and null empty, a column's times with
    the digits that all of them need. An empty frame writes nothing and returns status "empty".

    Tasks write the lines in parallel, sorted by ``order_by`` across them where it is given. Their
    files, which have no header, are then put one behind the other by copying bytes from stream to
    stream in the driver's JVM, in blocks; no task, and no memory, ever holds the rows together. The file
    gets its name when it is complete, in the place of an older one."""
    spark = df.sparkSession
    name = extract_name(prefix, as_of or _dt.date.today())
    n, patterns = _resolutions(df)
    status = {"status": "success" if n else "empty", "file_name": name, "extractPathFolder": folder, "columnDelimiter": ","}
    if not n:
        return status

    def text(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if f.name in patterns:
            shown = F.date_format(c, patterns[f.name])
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            shown = F.when(~F.isnan(c), as_text(c, f.dataType))
        elif isinstance(f.dataType, T.BooleanType):
            shown = as_text(c, f.dataType)
        else:
            return c
        return F.when(c.isNotNull(), shown).alias(f.name)

    ordered = df.orderBy(*[f"`{c}`" for c in order_by]) if order_by else df
    stage = scratch_path(spark, "extract-parts")
    ordered.select(*[text(f) for f in df.schema.fields]).write.options(**CSV_OPTIONS | {"header": "false"}).csv(stage)
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(df.columns)
    concatenate(spark, stage, f"{folder.rstrip('/')}/{name}", header.getvalue().encode())
    remove_folder(spark, stage)
    return status


# The bulk SQL Server connector and its options for partitioned mart tables.
BULK_FORMAT = "com.microsoft.sqlserver.jdbc.spark"
BULK_OPTIONS = {
    "batchsize": str(BULK_BATCH_SIZE),
    "mssqlIsolationLevel": "READ_UNCOMMITTED",
    "tableLock": "true",
    "reliabilityLevel": "BEST_EFFORT",
    "schemaCheckEnabled": "false",
}


def mart_write_plan(url: str, table_name: str, *, dm_schema: str | None = None, mode: str = "append",
                    driver: str | None = None) -> tuple[str, dict[str, str], str]:
    """(format, options, mode) for a mart table: tables routed to an unpartitioned schema use
    plain JDBC over ``JDBC_WRITE_PARTITIONS`` connections and honour the mode; the others
    append through the bulk connector."""
    from lakeshift.sources.jdbc import route

    r = route(table_name, dm_schema)
    if not r.partitioned:
        opts = {"url": url, "dbtable": r.dbtable, "numPartitions": str(JDBC_WRITE_PARTITIONS)}
        if driver:
            opts["driver"] = driver
        return "jdbc", opts, _mode(mode)
    return BULK_FORMAT, {"url": url, "dbtable": r.dbtable, **BULK_OPTIONS}, "append"


def write_mart(df: DataFrame, url: str, table_name: str, *, dm_schema: str | None = None, mode: str = "append",
               driver: str | None = None) -> None:
    fmt, opts, m = mart_write_plan(url, table_name, dm_schema=dm_schema, mode=mode, driver=driver)
    df.write.format(fmt).options(**opts).mode(m).save()
