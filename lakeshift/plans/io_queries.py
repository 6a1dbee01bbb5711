"""Registered round trips through the sources and sinks: each writes a whole test table to a
fresh folder under the shared checkpoint directory and reads it back."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.operators import retention
from lakeshift.operators.cycles import read_stored_cycle
from lakeshift.operators.clustered import merge_into_clustered, write_clustered
from lakeshift.operators.merge_table import merge_into_table
from lakeshift.operators.dedup import dedup_by_key
from lakeshift.operators.scd2 import (
    close_and_insert_spec,
    expire_spec,
    historical_update_keys,
    scd2_keys,
    update_columns_spec,
    upsert_spec,
)
from lakeshift.plans.frames import frame, oracle, table
from lakeshift.plans.queries import (
    END_VALUE,
    EXPIRE_INSERT,
    M1_KEYS,
    M3_KEYS,
    OPEN_F,
    ORACLE,
    RETENTION_TS,
    SAT_COLS,
    TABLE_KEYS,
    UPSERT_INSERT,
    dedup_sql,
    merge_oracle,
    register,
)
from lakeshift.session import scratch_path
from lakeshift.sinks.publish import folder_exists
from lakeshift.sinks.writers import (
    CSV_OPTIONS,
    export_csv,
    export_csv_file,
    extract_name,
    replace_table,
    write_clean,
    write_partitioned,
)
from lakeshift.sources.catalog import latest_files
from lakeshift.sources.paths import clean_path, raw_path
from lakeshift.sources.raw import read_raw
from lakeshift.sources.tables import load_table, read_catalog

# Headers with characters parquet rejects, and the names they become.
MESSY_CUSTOMER = {
    "c_custkey": "c custkey",
    "c_name": "c;name",
    "c_nationkey": "c=nation(key)",
    "c_acctbal": "c {acct} bal",
    "c_mktsegment": "c,mkt\tsegment",
}
CLEAN_CUSTOMER = {
    "c_custkey": "c_custkey",
    "c_name": "c_name",
    "c_nationkey": "c_nation_key_",
    "c_acctbal": "c_acct_bal",
    "c_mktsegment": "c_mkt_segment",
}
BATCH = "20240131"


def _renamed_schema(df: DataFrame, names: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(names[f.name], f.dataType, True) for f in df.schema.fields])


@register("raw_csv_sanitized", "SELECT " + ", ".join(
    f"{src} AS {dst}" for src, dst in CLEAN_CUSTOMER.items()) + " FROM customer")
def q_raw_csv_sanitized(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    messy = customer.toDF(*[MESSY_CUSTOMER[c] for c in customer.columns])
    base = scratch_path(spark, "raw")
    path = raw_path(base, "crm", "sales", "customer", BATCH, "csv")
    messy.write.option("header", "true").option("delimiter", "|").csv(path)
    return read_raw(spark, path, "csv", header=True, delimiter="|",
                    schema=_renamed_schema(customer, MESSY_CUSTOMER))


@register("raw_xml", "SELECT * FROM orders")
def q_raw_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = raw_path(scratch_path(spark, "raw"), "erp", "sales", "orders", BATCH, "xml")
    orders.write.format("xml").option("rowTag", "order").option("rootTag", "orders").save(path)
    return read_raw(spark, path, "xml", row_tag="order", schema=orders.schema).select(orders.columns)


@register("clean_write_roundtrip", oracle(["sat"], "SELECT * FROM sat"))
def q_clean_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sat = frame(spark, sf_dir, "sat")
    base = scratch_path(spark, "clean")
    write_clean(sat, base, "erp", "vault", "sat_order", BATCH)
    return spark.read.parquet(clean_path(base, "erp", "vault", "sat_order", BATCH))


def _partitioned_sat(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    sat = frame(spark, sf_dir, "sat")
    path = scratch_path(spark, "vault") + "/VAULT/sat_order"
    write_partitioned(sat, path)
    return sat, path


@register("partitioned_append_roundtrip", oracle(["sat"], "SELECT * FROM sat"))
def q_partitioned_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sat, path = _partitioned_sat(spark, sf_dir)
    return spark.read.schema(sat.schema).parquet(path).select(SAT_COLS)


NEW_FILES = ("1", "3")


@register("latest_file_per_dir", oracle(["sat"], (
    "SELECT DISTINCT 'REC_SRC_NM=' || REC_SRC_NM || '/PART_COL=' || PART_COL AS directory, "
    "'REC_SRC_NM=' || REC_SRC_NM AS table_name, PART_COL IN ('1', '3') AS is_new FROM sat")))
def q_latest_file_per_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest data file in every partition folder of a satellite whose first files were given an
    old modification time before two partition values were appended to. ``table_name`` is the
    source-system folder; ``is_new`` says that the file found is one of the appended ones."""
    sat, path = _partitioned_sat(spark, sf_dir)
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for row in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").collect():
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(row["path"]), 1_000_000_000_000, -1)  # a few files, in 2001
    write_partitioned(sat.where(F.col("PART_COL").isin(*NEW_FILES)), path)
    depth = len(path.rstrip("/").split("/"))
    found = latest_files(spark, path, pattern=".parquet", name_segment=depth + 1)
    return found.select(
        F.regexp_extract("directory", "(REC_SRC_NM=.*)$", 1).alias("directory"), "table_name",
        (F.year("modificationTime") > 2001).alias("is_new"))


EVENTS_SQL = ("SELECT event_id, ts, user_id, '  ' || event_type || ' ' AS event_type, value, props FROM {events}")


@register("csv_extract_roundtrip", EVENTS_SQL.format(events="events"))
def q_csv_extract_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events (every time has a fraction) with one text padded by blanks on both sides."""
    events = spark.sql(EVENTS_SQL.format(events=f"parquet.`{sf_dir}/events.parquet`"))
    view = f"lakeshift_extract_{uuid.uuid4().hex}"
    events.createOrReplaceTempView(view)  # the extract reads a catalog view by name
    folder = scratch_path(spark, "extract")
    day = _dt.date(2024, 1, 31)
    status = export_csv(read_catalog(spark, view), folder, "events_extract", as_of=day)
    spark.catalog.dropTempView(view)
    if status["status"] != "success":
        raise RuntimeError(f"extract failed: {status}")
    return spark.read.schema(events.schema).options(**CSV_OPTIONS).csv(f"{folder}/{extract_name('events_extract', day)}")


@register("csv_one_file_roundtrip", EVENTS_SQL.format(events="events"))
def q_csv_one_file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one dated CSV file, written in parts that are put together, and read back."""
    events = spark.sql(EVENTS_SQL.format(events=f"parquet.`{sf_dir}/events.parquet`"))
    folder, day = scratch_path(spark, "extract"), _dt.date(2024, 1, 31)
    status = export_csv_file(events, folder, "events_extract", as_of=day, order_by=["event_id"])
    if status["status"] != "success":
        raise RuntimeError(f"extract failed: {status}")
    return spark.read.schema(events.schema).options(**CSV_OPTIONS).csv(f"{folder}/{extract_name('events_extract', day)}")


@register("merge_upsert_into_table", ORACLE["merge_upsert"])
def q_merge_upsert_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert applied to a partitioned satellite on disk: only affected partitions are
    read and rewritten; the table is read back whole."""
    sat, path = _partitioned_sat(spark, sf_dir)
    upd = frame(spark, sf_dir, "upd")
    spec = upsert_spec(upd.columns, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", UPSERT_INSERT,
                       source_filter="F")
    merge_into_table(spark, path, upd, spec, schema=sat.schema)
    return spark.read.schema(sat.schema).parquet(path).select(SAT_COLS)


@register("merge_expire_part_into_table", ORACLE["merge_expire_part_literal"])
def q_merge_expire_part_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expire with a discovered partition literal on a table on disk: the merge reads and
    rewrites the single partition (F, 2) plus nothing else."""
    sat, path = _partitioned_sat(spark, sf_dir)
    src = frame(spark, sf_dir, "upd").where(F.col("PART_COL") == "2")
    spec = expire_spec(["ORD_ID"], "LD_END_DT", EXPIRE_INSERT, source_filter="F")
    merge_into_table(spark, path, src, spec, schema=sat.schema)
    return spark.read.schema(sat.schema).parquet(path).select(SAT_COLS)


def _odd_merge(spark: SparkSession, sf_dir: str, make_spec) -> DataFrame:
    """A merge into a stored satellite with null, empty and zero-padded partition values. The
    reader is not told a schema."""
    path = scratch_path(spark, "vault") + "/VAULT/sat_odd"
    write_partitioned(frame(spark, sf_dir, "odd_sat"), path)
    upd = frame(spark, sf_dir, "odd_upd")
    source, spec = make_spec(upd)
    merge_into_table(spark, path, source, spec)
    return load_table(spark, path).select(SAT_COLS)


def _odd_oracle(source_sql: str, keys: list[str], **options) -> str:
    """Merges of the odd frames as stored: the empty text is null."""
    parts = [f"{n}_stored AS (SELECT * REPLACE (nullif(PART_COL, '') AS PART_COL) FROM {n})" for n in ("odd_sat", "odd_upd")]
    sql = merge_oracle(source_sql, keys, frames=("odd_sat", "odd_upd"), target="odd_sat_stored", **options)
    return sql.replace("\nsrc AS (", "\n" + ",\n".join(parts) + ",\nsrc AS (", 1)


@register("merge_close_open_into_odd_table", _odd_oracle(
    "SELECT * FROM odd_upd_stored", M1_KEYS, pred=OPEN_F,
    set_lit={"LD_END_DT": f"CAST('{END_VALUE}' AS TIMESTAMP)"}, insert=SAT_COLS))
def q_merge_close_open_into_odd_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _odd_merge(spark, sf_dir, lambda upd: (upd, close_and_insert_spec(
        scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", END_VALUE, source_filter="F")))


@register("merge_upsert_into_odd_table", _odd_oracle(
    "SELECT * FROM odd_upd_stored", M1_KEYS, pred=OPEN_F, set_src={"LD_END_DT": "LD_END_DT"},
    insert=[c for c in UPSERT_INSERT if c != "rankColumn"]))
def q_merge_upsert_into_odd_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _odd_merge(spark, sf_dir, lambda upd: (upd, upsert_spec(
        upd.columns, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", UPSERT_INSERT, source_filter="F")))


@register("merge_historical_update_into_odd_table", _odd_oracle(
    dedup_sql("odd_upd_stored", M3_KEYS, SAT_COLS), M3_KEYS, pred="REC_SRC_NM = 'F'",
    set_src={"VAL": "VAL", "LD_END_DT": "LD_END_DT"}, insert=None))
def q_merge_historical_update_into_odd_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(upd):
        keys = historical_update_keys(TABLE_KEYS, upd.columns)
        return dedup_by_key(upd, keys), update_columns_spec(keys, ["VAL", "LD_END_DT", "REC_SRC_NM"], source_filter="F")
    return _odd_merge(spark, sf_dir, make)


@register("merge_expire_into_odd_table", _odd_oracle(
    "SELECT * FROM odd_upd_stored", ["ORD_ID"], pred=OPEN_F, residual="t.BTCH_DT <= s.BTCH_DT",
    set_src={"LD_END_DT": "LD_END_DT", "SRC_EXPRN_DT": "SRC_EFF_DT"}, insert=EXPIRE_INSERT))
def q_merge_expire_into_odd_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _odd_merge(spark, sf_dir, lambda upd: (upd, expire_spec(
        ["ORD_ID"], "LD_END_DT", EXPIRE_INSERT, cols_to_update=["LD_END_DT", "SRC_EXPRN_DT"], source_filter="F")))


CLUSTERS = 16


def _clustered_merge(spark: SparkSession, sf_dir: str, spec) -> DataFrame:
    """A merge into the whole satellite, stored in buckets of its order id; read back whole."""
    sat, upd = frame(spark, sf_dir, "sat"), frame(spark, sf_dir, "upd")
    name, path = f"lakeshift_{uuid.uuid4().hex}", scratch_path(spark, "vault") + "/VAULT/sat_clustered"
    write_clustered(sat, name, path, ["ORD_ID"], CLUSTERS)
    merge_into_clustered(spark, name, upd, spec(upd))
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return spark.read.schema(sat.schema).parquet(path).select(SAT_COLS)


@register("merge_upsert_into_clustered", ORACLE["merge_upsert"])
def q_merge_upsert_into_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered_merge(spark, sf_dir, lambda upd: upsert_spec(
        upd.columns, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", UPSERT_INSERT, source_filter="F"))


@register("merge_expire_into_clustered", ORACLE["merge_expire"])
def q_merge_expire_into_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered_merge(spark, sf_dir, lambda upd: expire_spec(
        ["ORD_ID"], "LD_END_DT", EXPIRE_INSERT, source_filter="F"))


RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("value", T.DoubleType()), T.StructField("dq_table_name", T.StringType()),
])


class _Stopped(Exception):
    """The end of a job's process, as the restart query stages it."""


def _retention_job(spark: SparkSession, sf_dir: str, *, restart: bool = False) -> tuple[str, str]:
    """Store every error table of ``runs`` as its own parquet table, then run the housekeeping
    job: plan all tables in one pass, rewrite each table without its old runs (staged), append
    the audit log. With ``restart`` the job keeps a journal, is stopped after the first table's
    runs are deleted and before that is logged, and runs again."""
    root = scratch_path(spark, "dq")
    frame(spark, sf_dir, "runs").write.partitionBy("dq_table_name").parquet(f"{root}/tables")
    log_path = f"{root}/clean_log"

    def table_path(name: str) -> str:
        return f"{root}/tables/dq_table_name={name}"

    def load(name: str) -> DataFrame:
        return spark.read.parquet(table_path(name))

    def write(name: str, df: DataFrame) -> None:
        replace_table(spark, df, table_path(name))

    def append_log(log: DataFrame) -> None:
        log.write.mode("append").parquet(log_path)

    def stop(log: DataFrame) -> None:
        raise _Stopped

    def read_log() -> DataFrame | None:
        return spark.read.schema(retention.LOG_SCHEMA).parquet(log_path) if folder_exists(spark, log_path) else None

    cfg, options = frame(spark, sf_dir, "cfg"), {"executed_at": RETENTION_TS}
    if restart:
        options |= {"journal": retention.Journal(spark, f"{root}/journal"), "read_log": read_log}
        try:
            retention.run_retention(spark, cfg, load, write, stop, **options)
        except _Stopped:
            pass
    errors = retention.run_retention(spark, cfg, load, write, append_log, **options)
    if errors:
        raise RuntimeError(f"retention job failed for {errors}")
    return f"{root}/tables", log_path


@register("retention_tables_job", ORACLE["retention_apply"])
def q_retention_tables_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = _retention_job(spark, sf_dir)
    return spark.read.schema(RUNS_SCHEMA).parquet(tables).select("dq_table_name", "run_id", "event_id", "value")


@register("retention_tables_job_log", ORACLE["retention_log"])
def q_retention_tables_job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, log_path = _retention_job(spark, sf_dir)
    return spark.read.schema(retention.LOG_SCHEMA).parquet(log_path)


@register("retention_restarted_job_log", ORACLE["retention_log"])
def q_retention_restarted_job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit log of a job that was stopped between a deletion and its log row, and run again."""
    _, log_path = _retention_job(spark, sf_dir, restart=True)
    return spark.read.schema(retention.LOG_SCHEMA).parquet(log_path)


def _stored_cycle(spark: SparkSession, sf_dir: str, by: list[str]) -> DataFrame:
    """The newest two months of the whole cycle table, stored with and without partition folders."""
    cycle = frame(spark, sf_dir, "cycle")
    path = scratch_path(spark, "cycle")
    (write_partitioned(cycle, path, by) if by else cycle.write.parquet(path))
    found = read_stored_cycle(spark, path, year_col="CYC_YEAR", month_col="CYC_MONTH", schema=cycle.schema)
    return found.select(cycle.columns)


@register("cycle_latest_from_folders", ORACLE["cycle_latest_two_months"])
def q_cycle_latest_from_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_cycle(spark, sf_dir, ["CYC_YEAR", "CYC_MONTH"])


@register("cycle_latest_from_footers", ORACLE["cycle_latest_two_months"])
def q_cycle_latest_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_cycle(spark, sf_dir, [])
