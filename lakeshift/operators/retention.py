"""Configuration-driven retention of run-numbered tables, with an audit log.

Config rows: ``dq_err_tables_master_id, dq_table_name, no_of_exec_to_keep, actv_inactv_ind``.
A table is cleaned when it has more distinct runs than it keeps; the cut-off is id
arithmetic (``max(run_id) - keep``, not a rank) and rows with ``run_id <= cut-off`` go.
Null run ids are neither counted nor deleted.

One scan of the data per plan: rows are pre-aggregated to one row per
``(table, run_id)`` (partial aggregation before the shuffle), and one pass over that small
result gives the plan rows of all entries, however many a table has.

The housekeeping job can be stopped at any point and run again when it is given a journal: what
it is about to delete is written down first, and a later run finishes what was left open.
"""

from __future__ import annotations

import datetime as _dt
import logging
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from typing import Callable, Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.functions.clean import observe_rejected
from lakeshift.sinks.publish import drop_folders, folder_exists, partition_folders
from lakeshift.sinks.writers import replace_table
from lakeshift.sources.tables import load_table, partition_columns

log = logging.getLogger(__name__)

# Configuration and log column names and the active flag.
ID = "dq_err_tables_master_id"
TABLE = "dq_table_name"
KEEP = "no_of_exec_to_keep"
ACTIVE = "actv_inactv_ind"
ACTIVE_YES = "Y"
RUN_ID = "run_id"
LOG_SCHEMA = T.StructType([
    T.StructField(ID, T.LongType()),
    T.StructField("execution_ts", T.TimestampNTZType()),
    T.StructField(TABLE, T.StringType()),
    T.StructField("exec_avail_in_frt", T.LongType()),
    T.StructField("max_run_id_deleted_in_frt", T.LongType()),
    T.StructField("records_removed_from_frt", T.LongType()),
])
CONFIG_SCHEMA = T.StructType([
    T.StructField(ID, T.LongType()),
    T.StructField(TABLE, T.StringType()),
    T.StructField(KEEP, T.IntegerType()),
    T.StructField(ACTIVE, T.StringType()),
])


def eligible(cfg: DataFrame) -> DataFrame:
    """Active entries with a table name and a positive keep count."""
    return cfg.where(
        (F.col(ACTIVE) == F.lit(ACTIVE_YES)) & F.col(TABLE).isNotNull()
        & (F.coalesce(F.col(KEEP), F.lit(0)) > 0)
    )


def run_counts(runs: DataFrame, table_col: str = TABLE, run_col: str = RUN_ID) -> DataFrame:
    """Rows per (table, run): the only pass over the data."""
    return runs.groupBy(F.col(table_col).alias(TABLE), F.col(run_col).alias(RUN_ID)).agg(
        F.count(F.lit(1)).alias("_rows")
    )


def plan_from_counts(per_run: DataFrame, cfg: DataFrame) -> DataFrame:
    """Plan rows for tables that have runs to delete:
    ``id, table, exec_avail_in_frt, max_run_id_deleted_in_frt, records_removed_from_frt``.

    Several configuration rows of one table take effect one after the other, by id: a later one
    counts what the earlier ones left. As every keep count is above 0, a table's newest run never
    goes, so an entry's cut-off is ``newest - keep`` whatever came before it. One aggregate counts,
    for each entry, the runs and rows above its cut-off; a fold over a table's entries carries what
    the last one that acted left, and an entry acts where that is more runs than it keeps. The size
    of the plan does not depend on the number of entries, and ``per_run`` is read once."""
    entry = F.struct(F.col(ID).isNull().alias("no_id"), F.col(ID).cast("long").alias(ID), F.col(KEEP).cast("long").alias("keep"))
    entries = eligible(cfg).groupBy(TABLE).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    runs = per_run.join(entries, TABLE).withColumn("_newest", F.max(RUN_ID).over(Window.partitionBy(TABLE)))
    above = F.col(RUN_ID) > F.col("_newest") - F.col("_entry.keep")
    per_entry = (
        runs.select(TABLE, RUN_ID, "_rows", "_newest", F.posexplode("_entries").alias("_turn", "_entry"))
        .groupBy(TABLE, "_turn", "_entry").agg(
            F.max("_newest").alias("_newest"),
            F.count(RUN_ID).alias("_runs"), F.sum(F.when(F.col(RUN_ID).isNotNull(), F.col("_rows"))).alias("_rows"),
            F.count_if(above).alias("_runs_above"), F.sum(F.when(above, F.col("_rows"))).alias("_rows_above")))
    counts = F.struct("_turn", "_entry", "_runs_above", F.coalesce("_rows_above", F.lit(0)).alias("_rows_above"))
    per_table = per_entry.groupBy(TABLE).agg(
        F.array_sort(F.collect_list(counts)).alias("_entries"), F.max("_newest").alias("_newest"),
        F.max("_runs").alias("_runs"), F.coalesce(F.max("_rows"), F.lit(0)).alias("_rows"))

    done = f"array<struct<{ID}:bigint,exec_avail_in_frt:bigint,max_run_id_deleted_in_frt:bigint,records_removed_from_frt:bigint>>"
    start = F.struct(F.col("_runs").alias("runs"), F.col("_rows").alias("rows"), F.array().cast(done).alias("done"))

    def turn(left: Column, e: Column) -> Column:
        acts = left["runs"] > e["_entry"]["keep"]
        row = F.array(F.struct(
            e["_entry"][ID].alias(ID), left["runs"].alias("exec_avail_in_frt"),
            (F.col("_newest") - e["_entry"]["keep"]).cast("long").alias("max_run_id_deleted_in_frt"),
            F.greatest(left["rows"] - e["_rows_above"], F.lit(0)).cast("long").alias("records_removed_from_frt")))
        return F.struct(
            F.when(acts, F.least(left["runs"], e["_runs_above"])).otherwise(left["runs"]).alias("runs"),
            F.when(acts, F.least(left["rows"], e["_rows_above"])).otherwise(left["rows"]).alias("rows"),
            F.when(acts, F.concat(left["done"], row)).otherwise(left["done"]).alias("done"))

    folded = per_table.select(TABLE, F.explode(F.aggregate("_entries", start, turn, lambda left: left["done"])).alias("_row"))
    return folded.select(
        f"_row.{ID}", TABLE, "_row.exec_avail_in_frt", "_row.max_run_id_deleted_in_frt", "_row.records_removed_from_frt")


def plan(runs: DataFrame, cfg: DataFrame, table_col: str = TABLE, run_col: str = RUN_ID) -> DataFrame:
    """Plan over one frame that holds many tables' rows (``table_col`` names the table)."""
    return plan_from_counts(run_counts(runs, table_col, run_col), cfg)


def plan_tables(
    spark: SparkSession,
    cfg: DataFrame,
    load: Callable[[str], DataFrame],
    run_col: str = RUN_ID,
    rejected: dict[str, Observation] | None = None,
) -> tuple[DataFrame, list[dict]]:
    """Plan over separate tables: ``load(name)`` returns a table's DataFrame.

    The loop runs over configuration rows only (bounded, collected); each table contributes
    its per-run counts to one union, so the whole plan is one job. Run ids are read as numbers.
    A table that fails to load, or whose run ids are of a type that is no number, is reported in
    the returned error list and skipped; the others go on. A run id in text that is no number
    fails the plan; with ``rejected`` it is read as null (neither counted nor deleted), and
    ``rejected[name].get["rejected"]`` has the number of such rows of a table once the plan ran.
    """
    per_run_parts: list[DataFrame] = []
    errors: list[dict] = []
    for row in eligible(cfg).select(TABLE).distinct().collect():
        name = row[TABLE]
        try:
            found, run = load(name), F.col(run_col)
            if rejected is not None:
                found = observe_rejected(found, {run_col: "long"}, rejected.setdefault(name, Observation()))
            number = run.cast("long") if rejected is None else run.try_cast("long")
            per_run_parts.append(run_counts(found.select(F.lit(name).alias(TABLE), number.alias(RUN_ID))))
        except Exception as exc:  # per-table isolation
            log.warning("retention: table %s skipped: %s", name, exc)
            errors.append({"table": name, "error": str(exc)})
    if not per_run_parts:
        empty = spark.createDataFrame([], T.StructType([
            T.StructField(TABLE, T.StringType()), T.StructField(RUN_ID, T.LongType()),
            T.StructField("_rows", T.LongType())]))
        per_run_parts = [empty]
    per_run = per_run_parts[0]
    for part in per_run_parts[1:]:
        per_run = per_run.unionByName(part)
    return plan_from_counts(per_run, cfg), errors


def _surviving(runs: DataFrame, retention_plan: DataFrame, table_col: str, run_col: str) -> DataFrame:
    """Rows without those at or below the highest cut-off planned for their table."""
    side = retention_plan.groupBy(F.col(TABLE).alias("_t")).agg(F.max("max_run_id_deleted_in_frt").alias("_cut"))
    joined = runs.join(side, F.col(table_col) == F.col("_t"), "left")
    doomed = F.coalesce(F.col(run_col) <= F.col("_cut"), F.lit(False))
    return joined.where(~doomed).drop("_t", "_cut")


def apply(runs: DataFrame, retention_plan: DataFrame, table_col: str = TABLE, run_col: str = RUN_ID) -> DataFrame:
    """Rows that survive: ``NOT coalesce(run_id <= cut-off, false)`` for planned tables, every row
    of other tables. The plan side has one row per table; Spark broadcasts it when it is small."""
    return _surviving(runs, retention_plan, table_col, run_col)


def apply_table(df: DataFrame, cutoff: int, run_col: str = RUN_ID) -> DataFrame:
    """Surviving rows of one table for a known cut-off: ``run_id > cut-off OR run_id IS NULL``,
    written so that it is pushed to the scan (and prunes run partitions)."""
    run = F.col(run_col)
    return df.where((run > F.lit(cutoff)) | run.isNull())


def audit_log(retention_plan: DataFrame, executed_at: _dt.datetime) -> DataFrame:
    """Log rows for the planned deletions; the timestamp is passed in for repeatable output."""
    return retention_plan.select(
        F.col(ID).cast("long").alias(ID),
        # from text, so neither the Python process's nor the session's time zone shifts it
        F.lit(executed_at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz").alias("execution_ts"),
        TABLE, "exec_avail_in_frt", "max_run_id_deleted_in_frt", "records_removed_from_frt",
    )


JOURNAL_SCHEMA = T.StructType([T.StructField("job_id", T.StringType()), T.StructField("state", T.StringType()), *LOG_SCHEMA.fields])


class Journal:
    """What a housekeeping job is about to delete, and what it is done with: a small table with one
    row per planned deletion and state (``intent``, then ``done`` or ``failed``), keyed by job id,
    table and cut-off. Rows are only ever appended."""

    def __init__(self, spark: SparkSession, path: str, job_id: str | None = None) -> None:
        self.spark, self.path, self.job_id = spark, path, job_id or uuid4().hex

    def write(self, state: str, rows: list[Row]) -> None:
        """Log rows under a state. Rows of an earlier job keep its id."""
        named = [(getattr(r, "job_id", self.job_id), state, *[r[f.name] for f in LOG_SCHEMA.fields]) for r in rows]
        self.spark.createDataFrame(named, JOURNAL_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def open(self) -> list[Row]:
        """Intents that no later row closed, of any job; as many as configuration rows that delete."""
        if not folder_exists(self.spark, self.path):
            return []
        rows = self.spark.read.schema(JOURNAL_SCHEMA).parquet(self.path)
        key = ["job_id", TABLE, "max_run_id_deleted_in_frt"]
        closed = rows.where(F.col("state") != "intent").select(*key).distinct()
        return rows.where(F.col("state") == "intent").join(closed, key, "left_anti").collect()


def _cutoffs(rows: list[Row]) -> dict[str, int]:
    """The highest cut-off planned for each table."""
    found: dict[str, int] = {}
    for row in rows:
        cut = row["max_run_id_deleted_in_frt"]
        found[row[TABLE]] = max(cut, found.get(row[TABLE], cut))
    return found


def _not_logged(spark: SparkSession, rows: list[Row], log_rows: DataFrame | None) -> list[Row]:
    """Rows that the log does not have yet; only rows with their time stamps are read from it."""
    if log_rows is None or not rows:
        return rows
    key = [ID, "execution_ts", TABLE, "max_run_id_deleted_in_frt"]
    wanted = spark.createDataFrame([tuple(r[c] for c in key) for r in rows], T.StructType([LOG_SCHEMA[c] for c in key]))
    there = {tuple(r) for r in log_rows.select(*key).join(F.broadcast(wanted), key, "left_semi").distinct().collect()}
    return [r for r in rows if tuple(r[c] for c in key) not in there]


def finish_open(
    spark: SparkSession,
    journal: Journal,
    load: Callable[[str], DataFrame],
    write: Callable[[str, DataFrame], None],
    append_log: Callable[[DataFrame], None],
    read_log: Callable[[], DataFrame | None],
) -> list[dict]:
    """Finish the deletions that stopped jobs left open: a table that still has runs at or below
    its cut-off is rewritten, log rows that are missing are appended, and the intents are closed.
    A table that cannot be read or written stays open and is returned as an error."""
    rows, errors = journal.open(), []
    for name, cut in _cutoffs(rows).items():
        mine = [r for r in rows if r[TABLE] == name]
        try:
            if not load(name).where(F.col(RUN_ID) <= F.lit(cut)).isEmpty():
                write(name, apply_table(load(name), cut))
        except Exception as exc:
            log.warning("retention: open deletion of %s failed: %s", name, exc)
            errors.append({"table": name, "error": str(exc)})
            continue
        missing = _not_logged(spark, mine, read_log())
        if missing:
            append_log(spark.createDataFrame([tuple(r[f.name] for f in LOG_SCHEMA.fields) for r in missing], LOG_SCHEMA))
        journal.write("done", mine)
    return errors


def run_retention(
    spark: SparkSession,
    cfg: DataFrame,
    load: Callable[[str], DataFrame],
    write: Callable[[str, DataFrame], None],
    append_log: Callable[[DataFrame], None],
    executed_at: _dt.datetime | None = None,
    max_parallel_tables: int = 1,
    journal: Journal | None = None,
    read_log: Callable[[], DataFrame | None] | None = None,
) -> list[dict]:
    """The housekeeping job: plan every table in one job, then per table write the surviving
    rows (``write(name, df)`` must stage before replacing a path it reads) and append the log.
    Failures are isolated per table and returned: when the joint plan fails, tables are planned
    one by one, and only those that fail on their own are reported. ``max_parallel_tables`` > 1
    rewrites that many tables at once (concurrent Spark jobs from a small thread pool); a table
    is only ever rewritten once, whatever number of configuration rows it has.

    With a ``journal`` the job can be stopped anywhere and run again: it first finishes what was
    left open, writes its own intents before anything is deleted, and logs and closes every table
    as soon as it is done. ``read_log`` returns the log as it is now (None: not there yet), so
    that a row that was appended just before a stop is not appended twice."""
    if journal is not None and read_log is None:
        raise ValueError("a journal needs read_log")
    errors = [] if journal is None else finish_open(spark, journal, load, write, append_log, read_log)
    unfinished = {e["table"] for e in errors}
    if unfinished:
        cfg = cfg.where(~F.col(TABLE).isin(*unfinished))
    retention_plan, failed = plan_tables(spark, cfg, load)
    errors += failed
    try:
        rows = retention_plan.collect()  # one row per configuration row that deletes
    except Exception as exc:
        log.warning("retention: the joint plan failed, planning table by table: %s", exc)
        rows, known = [], {e["table"] for e in errors}
        for entry in eligible(cfg).select(TABLE).distinct().collect():
            name = entry[TABLE]
            if name in known:
                continue
            try:
                one, failed = plan_tables(spark, cfg.where(F.col(TABLE) == name), load)
                errors += failed
                rows += one.collect()
            except Exception as reason:
                log.warning("retention: table %s skipped: %s", name, reason)
                errors.append({"table": name, "error": str(reason)})
    cutoffs = _cutoffs(rows)
    when = executed_at or _dt.datetime.now()
    schema = retention_plan.schema
    logged: dict[str, list[Row]] = {}
    if journal is not None and rows:
        for row in audit_log(spark.createDataFrame(rows, schema), when).collect():
            logged.setdefault(row[TABLE], []).append(row)
        journal.write("intent", [r for mine in logged.values() for r in mine])
    one_at_a_time = Lock()

    def clean(name: str) -> dict | None:
        try:
            write(name, apply_table(load(name), cutoffs[name]))
        except Exception as exc:
            log.warning("retention: table %s failed: %s", name, exc)
            if journal is not None:
                with one_at_a_time:
                    journal.write("failed", logged[name])
            return {"table": name, "error": str(exc)}
        if journal is not None:
            with one_at_a_time:
                append_log(spark.createDataFrame(logged[name], LOG_SCHEMA))
                journal.write("done", logged[name])
        return None

    workers = max(1, min(int(max_parallel_tables), len(cutoffs) or 1))
    if workers == 1:
        outcomes = [clean(name) for name in cutoffs]
    else:
        with ThreadPoolExecutor(max_workers=workers) as pool:
            outcomes = list(pool.map(clean, cutoffs))
    failures = [failure for failure in outcomes if failure is not None]
    broken = {failure["table"] for failure in failures}
    done = [row for row in rows if row[TABLE] not in broken]
    errors += failures
    if done and journal is None:
        append_log(audit_log(spark.createDataFrame(done, schema), when))
    return errors


def delete_runs(spark: SparkSession, path: str, cutoff: int, run_col: str = RUN_ID, fmt: str = "parquet") -> str:
    """Delete the runs at or below a cut-off from a stored table. Where the run is a partition
    column, the runs' folders are deleted and nothing is rewritten ("dropped"); otherwise the
    surviving rows replace the table, which keeps its partitioning ("rewritten")."""
    cols = partition_columns(spark, path, fmt)
    if run_col in cols:
        def is_old(folder: str) -> bool:
            value = dict(part.split("=", 1) for part in folder.split("/"))[run_col]
            return value.lstrip("-").isdigit() and int(value) <= cutoff

        drop_folders(spark, path, [f for f in partition_folders(spark, path, len(cols)) if is_old(f)])
        return "dropped"
    replace_table(spark, apply_table(load_table(spark, path, fmt), cutoff, run_col), path, fmt=fmt)
    return "rewritten"


def config_frame(spark: SparkSession, rows: list[Mapping]) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(f.name) for f in CONFIG_SCHEMA.fields) for r in rows], CONFIG_SCHEMA)
