"""Registered queries (Spark) and their oracle SQL (DuckDB), one pair per operator.

Every query reads the shared test tables, or frames Spark derives from them, in full.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.functions.predicates import apply_read_type, resolve_read_spec
from lakeshift.operators import cycles, retention
from lakeshift.operators.dedup import dedup_by_key, distinct_values
from lakeshift.operators.lookup import lookup
from lakeshift.operators.scd2 import (
    close_and_insert,
    expire,
    historical_update_keys,
    scd2_keys,
    update_columns,
    upsert,
)
from lakeshift.plans.frames import frame, oracle, table, with_clause
from lakeshift.session import scratch_path
from lakeshift.sinks.writers import write_connector, write_partitioned, write_table
from lakeshift.sources.tables import read_connector, read_reference, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def sql_with(frames: list[str], extra_ctes: str, body: str) -> str:
    """DuckDB SQL: the named frames and ``extra_ctes`` as one WITH clause, then ``body``."""
    parts = [with_clause(frames, "duckdb")[len("WITH "):]] if frames else []
    if extra_ctes.strip():
        parts.append(extra_ctes.strip())
    head = ("WITH " + ",\n".join(parts) + "\n") if parts else ""
    return head + body


def register(name: str, sql: str | None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


SAT_COLS = ["ORD_ID", "REF_ID", "REC_SRC_NM", "PART_COL", "LD_DT", "BTCH_DT", "SRC_EFF_DT",
            "SRC_EXPRN_DT", "LD_END_DT", "VAL"]

# --------------------------------------------------------------------------------------
# Read types on the satellite
# --------------------------------------------------------------------------------------

AS_OF = _dt.date(2001, 6, 30)
READ_CASES: dict[str, tuple[dict, dict, list[str], str | None]] = {
    # name: (obj options, extra (kind/export), source list, oracle WHERE or None for all rows)
    "rt_full": ({"read-type": "full", "source-filter": "F"}, {}, [], None),
    "rt_rec_source_filtered": ({"read-type": "rec-source-filtered", "source-filter": "F"}, {}, [],
                               "REC_SRC_NM = 'F'"),
    "rt_historical": ({"read-type": "historical", "source-filter": "O"}, {}, [], "REC_SRC_NM = 'O'"),
    "rt_historical_flag": ({"read-type": "active-filtered", "historicalFlag": "true", "source-filter": "P"}, {}, [],
                           "REC_SRC_NM = 'P'"),
    "rt_rec_source_filtered_active": ({"read-type": "rec-source-filtered-active", "source-filter": "F"}, {}, [],
                                      "REC_SRC_NM = 'F' AND LD_END_DT IS NULL"),
    "rt_rec_source_filtered_list": ({"read-type": "rec-source-filtered-list"}, {}, ["F", "P"],
                                    "REC_SRC_NM IN ('F', 'P')"),
    "rt_rec_source_filtered_list_active": ({"read-type": "rec-source-filtered-list-active"}, {}, ["O", "P"],
                                           "REC_SRC_NM IN ('O', 'P') AND LD_END_DT IS NULL"),
    "rt_active_filtered": ({"read-type": "active-filtered"}, {}, [], "LD_END_DT IS NULL"),
    "rt_active_filtered_with_loaddate": (
        {"read-type": "active-filtered-with-loaddate", "start_dt": "1996-01-01", "end_dt": "1996-12-31"}, {}, [],
        "LD_END_DT IS NULL AND CAST(LD_DT AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"),
    "rt_loaddate_filtered": (
        {"read-type": "loaddate-filtered", "start_dt": "1998-03-01", "end_dt": "1998-06-30"}, {}, [],
        "CAST(LD_DT AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-06-30'"),
    "rt_loaddate_no_window": ({"read-type": "loaddate-filtered", "start_dt": "NA", "end_dt": ""}, {}, [], None),
    "rt_rec_source_filtered_with_loaddate": (
        {"read-type": "rec-source-filtered-with-loaddate", "source-filter": "P", "start_dt": "1997-01-01",
         "end_dt": "1997-03-31"}, {}, [],
        "REC_SRC_NM = 'P' AND CAST(LD_DT AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'"),
    "rt_rec_source_filtered_list_active_with_loaddate": (
        {"read-type": "rec-source-filtered-list-active-with-loaddate", "start_dt": "1999-01-01",
         "end_dt": "2000-12-31"}, {}, ["F", "O"],
        "REC_SRC_NM IN ('F', 'O') AND LD_END_DT IS NULL AND CAST(LD_DT AS DATE) BETWEEN DATE '1999-01-01' AND DATE '2000-12-31'"),
    "rt_rec_source_filtered_active_with_loaddate": (
        {"read-type": "rec-source-filtered-active-with-loaddate", "source-filter": "O", "start_dt": "2001-01-01",
         "end_dt": "2001-12-31"}, {}, [],
        "REC_SRC_NM = 'O' AND LD_END_DT IS NULL AND CAST(LD_DT AS DATE) BETWEEN DATE '2001-01-01' AND DATE '2001-12-31'"),
    "rt_export_override": (
        {"read-type": "active-filtered-with-loaddate", "source-filter": "P", "start_dt": "1996-01-01",
         "end_dt": "1996-12-31"}, {"export": True}, [], "REC_SRC_NM = 'P'"),
    "rt_no_source_falls_back_to_full": ({"read-type": "rec-source-filtered"}, {}, [], None),
    "rt_active_without_source_uses_na": ({"read-type": "rec-source-filtered-active"}, {}, [],
                                         "REC_SRC_NM = 'NA' AND LD_END_DT IS NULL"),
    "rt_num_of_days": ({"read-type": "loaddate-filtered", "num_of_days": "90", "start_dt": "1995-01-01",
                        "end_dt": "1995-12-31"}, {}, [],
                       "CAST(LD_DT AS DATE) BETWEEN DATE '2001-04-01' AND DATE '2001-06-30'"),
    "rt_rec_source_list_empty": ({"read-type": "rec-source-filtered-list"}, {}, [], "FALSE"),
    "rt_wide_loaddate_reads_all": ({"read-type": "loaddate-filtered", "start_dt": "1998-03-01",
                                    "end_dt": "1998-06-30"}, {"kind": "wide"}, [], None),
    "rt_wide_rec_source_filtered_list_active": ({"read-type": "rec-source-filtered-list-active"}, {"kind": "wide"},
                                                ["F"], "REC_SRC_NM IN ('F') AND LD_END_DT IS NULL"),
}


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The path of a frame written as a table, once per application and data set (the satellite
    partitioned as in the vault)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = f"{scratch_path(spark, 'stored')}/VAULT/{name}"
        if name == "sat":
            write_partitioned(frame(spark, sf_dir, name), path)
        else:
            write_table(frame(spark, sf_dir, name), path)
        _STORED[key] = path
    return _STORED[key]


def _read_query(obj: dict, extra: dict, source_list: list[str]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        kind = extra.get("kind", "table")
        spec = resolve_read_spec(obj, None, kind=kind, source_list=source_list,
                                 as_of=AS_OF, export=extra.get("export", False))
        path = stored(spark, sf_dir, "sat")
        return read_connector(spark, "parquet", {"path": path}, spec) if kind == "wide" else read_table(spark, path, spec)
    return run


for _name, (_obj, _extra, _lst, _where) in READ_CASES.items():
    register(_name, oracle(["sat"], "SELECT * FROM sat" + (f" WHERE {_where}" if _where else "")))(
        _read_query(_obj, _extra, _lst))

# Mart read types (JDBC marts use RECORD_SOURCE_NAME / RECORD_END_DATE and three types).
MART_BODY = ("SELECT ORD_ID AS FACT_SAT_ID, REC_SRC_NM AS RECORD_SOURCE_NAME, LD_END_DT AS RECORD_END_DATE, "
             "VAL AS AMOUNT FROM sat")
MART_CASES = {
    "mart_filter_full": ({"read-type": "full"}, None),
    "mart_filter_rec_source": ({"read-type": "rec-source-filtered", "source-filter": "O"},
                               "RECORD_SOURCE_NAME = 'O'"),
    "mart_filter_rec_source_active": ({"read-type": "rec-source-filtered-active", "source-filter": "F"},
                                      "RECORD_SOURCE_NAME = 'F' AND RECORD_END_DATE IS NULL"),
    "mart_filter_active": ({"read-type": "active-filtered"}, "RECORD_END_DATE IS NULL"),
    "mart_filter_historical_reads_all": ({"read-type": "historical", "source-filter": "F"}, None),
}


def _mart_query(obj: dict) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sat = frame(spark, sf_dir, "sat")
        mart = sat.select(F.col("ORD_ID").alias("FACT_SAT_ID"), F.col("REC_SRC_NM").alias("RECORD_SOURCE_NAME"),
                          F.col("LD_END_DT").alias("RECORD_END_DATE"), F.col("VAL").alias("AMOUNT"))
        return apply_read_type(mart, resolve_read_spec(obj, None, kind="mart"))
    return run


for _name, (_obj, _where) in MART_CASES.items():
    register(_name, oracle(["sat"], f"SELECT * FROM ({MART_BODY}) m" + (f" WHERE {_where}" if _where else "")))(
        _mart_query(_obj))

# --------------------------------------------------------------------------------------
# Merges: target ``sat``, source ``upd`` (source system F)
# --------------------------------------------------------------------------------------

END_VALUE = "2024-01-01 00:00:00"
UPSERT_INSERT = ["ORD_ID", "REF_ID", "REC_SRC_NM", "PART_COL", "LD_DT", "BTCH_DT", "LD_END_DT", "VAL",
                 "rankColumn"]
EXPIRE_INSERT = ["ORD_ID", "REF_ID", "REC_SRC_NM", "PART_COL", "LD_DT", "BTCH_DT", "SRC_EFF_DT", "LD_END_DT",
                 "VAL"]
TABLE_KEYS = {"target-table-keys": ["ORD_ID"]}


def dedup_sql(src: str, keys: list[str], cols: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in cols if c not in keys)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order}) AS __rn FROM {src}) d WHERE __rn = 1")


def merge_oracle(source_sql: str, keys: list[str], *, pred: str | None, residual: str | None = None,
                 set_src: dict[str, str] | None = None, set_lit: dict[str, str] | None = None,
                 insert: list[str] | None = None, frames: tuple[str, ...] = ("sat", "upd"),
                 target: str = "sat") -> str:
    """MERGE semantics in plain SQL: untouched rows, then a full outer join of the touched slice
    and the source on null-safe keys."""
    set_src, set_lit = set_src or {}, set_lit or {}
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    if residual:
        on += f" AND {residual}"
    inside = f"COALESCE({pred}, FALSE)" if pred else "TRUE"
    tsel = ", ".join(f"t.{c} AS t_{c}" for c in SAT_COLS)
    ssel = ", ".join(f"s.{c} AS s_{c}" for c in SAT_COLS)
    join = "FULL OUTER JOIN" if insert else "LEFT JOIN"
    upd_cols = []
    for c in SAT_COLS:
        if c in set_src:
            upd_cols.append(f"CASE WHEN s_hit = 1 THEN s_{set_src[c]} ELSE t_{c} END AS {c}")
        elif c in set_lit:
            upd_cols.append(f"CASE WHEN s_hit = 1 THEN {set_lit[c]} ELSE t_{c} END AS {c}")
        else:
            upd_cols.append(f"t_{c} AS {c}")
    ctes = f"""src AS ({source_sql}),
touched AS (SELECT * FROM {target} WHERE {inside}),
rest AS (SELECT * FROM {target} WHERE NOT {inside}),
j AS (SELECT {tsel}, {ssel}, t.__hit AS t_hit, s.__hit AS s_hit
      FROM (SELECT *, 1 AS __hit FROM touched) t {join} (SELECT *, 1 AS __hit FROM src) s ON {on})"""
    body = f"""SELECT {', '.join(SAT_COLS)} FROM rest
UNION ALL
SELECT {', '.join(upd_cols)} FROM j WHERE t_hit = 1"""
    if insert:
        ins = ", ".join((f"s_{c} AS {c}" if c in insert else f"NULL AS {c}") for c in SAT_COLS)
        body += f"\nUNION ALL\nSELECT {ins} FROM j WHERE t_hit IS NULL"
    return sql_with(list(frames), ctes, body)


def _sat_upd(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return frame(spark, sf_dir, "sat"), frame(spark, sf_dir, "upd")


M1_KEYS = ["ORD_ID", "REF_ID", "LD_DT", "BTCH_DT"]
OPEN_F = "REC_SRC_NM = 'F' AND LD_END_DT IS NULL"


@register("merge_close_open", merge_oracle(
    "SELECT * FROM upd", M1_KEYS, pred=OPEN_F,
    set_lit={"LD_END_DT": f"CAST('{END_VALUE}' AS TIMESTAMP)"}, insert=SAT_COLS))
def q_merge_close_open(spark, sf_dir):
    """The batch spells two columns in another case than the satellite."""
    sat, upd = _sat_upd(spark, sf_dir)
    upd = upd.withColumnsRenamed({"VAL": "val", "PART_COL": "Part_Col"})
    return close_and_insert(sat, upd, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", END_VALUE,
                            source_filter="F")


@register("merge_upsert", merge_oracle(
    "SELECT * FROM upd", M1_KEYS, pred=OPEN_F, set_src={"LD_END_DT": "LD_END_DT"},
    insert=[c for c in UPSERT_INSERT if c != "rankColumn"]))
def q_merge_upsert(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return upsert(sat, upd, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", UPSERT_INSERT, source_filter="F")


@register("merge_upsert_shuffle", ORACLE["merge_upsert"])
def q_merge_upsert_shuffle(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return upsert(sat, upd, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", UPSERT_INSERT, source_filter="F",
                  strategy="shuffle")


@register("merge_upsert_scd2_columns", merge_oracle(
    "SELECT * FROM upd", M1_KEYS, pred=OPEN_F, set_src={"LD_END_DT": "LD_END_DT", "VAL": "VAL"},
    insert=[c for c in UPSERT_INSERT if c != "rankColumn"]))
def q_merge_upsert_scd2_columns(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return upsert(sat, upd, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", UPSERT_INSERT,
                  scd2_columns=["VAL"], source_filter="F")


@register("merge_upsert_historical_sat", merge_oracle(
    "SELECT * FROM upd", M1_KEYS + ["SRC_EFF_DT"], pred="REC_SRC_NM = 'F'", set_src={"LD_END_DT": "LD_END_DT"},
    insert=[c for c in UPSERT_INSERT if c != "rankColumn"]))
def q_merge_upsert_historical_sat(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return upsert(sat, upd, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", UPSERT_INSERT,
                  historical_sat=True, source_filter="F")


@register("merge_upsert_part_literal", merge_oracle(
    "SELECT * FROM upd WHERE PART_COL = '1'", M1_KEYS, pred=OPEN_F + " AND PART_COL = '1'",
    set_src={"LD_END_DT": "LD_END_DT"}, insert=[c for c in UPSERT_INSERT if c != "rankColumn"]))
def q_merge_upsert_part_literal(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    src = upd.where(F.col("PART_COL") == "1")
    return upsert(sat, src, scd2_keys(TABLE_KEYS, src.columns), "LD_END_DT", UPSERT_INSERT, source_filter="F")


M3_KEYS = ["ORD_ID", "LD_DT", "REF_ID", "SRC_EFF_DT"]


@register("merge_historical_update", merge_oracle(
    dedup_sql("upd", M3_KEYS, SAT_COLS), M3_KEYS, pred="REC_SRC_NM = 'F'",
    set_src={"VAL": "VAL", "LD_END_DT": "LD_END_DT"}, insert=None))
def q_merge_historical_update(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    keys = historical_update_keys(TABLE_KEYS, upd.columns)
    return update_columns(sat, upd, keys, ["VAL", "LD_END_DT", "REC_SRC_NM"], dedup_source=True,
                          source_filter="F")


@register("merge_expire", merge_oracle(
    "SELECT * FROM upd", ["ORD_ID"], pred=OPEN_F, residual="t.BTCH_DT <= s.BTCH_DT",
    set_src={"LD_END_DT": "LD_END_DT"}, insert=EXPIRE_INSERT))
def q_merge_expire(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return expire(sat, upd, ["ORD_ID"], "LD_END_DT", EXPIRE_INSERT, source_filter="F")


@register("merge_expire_two_cols", merge_oracle(
    "SELECT * FROM upd", ["ORD_ID"], pred=OPEN_F, residual="t.BTCH_DT <= s.BTCH_DT",
    set_src={"LD_END_DT": "LD_END_DT", "SRC_EXPRN_DT": "SRC_EFF_DT"}, insert=EXPIRE_INSERT))
def q_merge_expire_two_cols(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return expire(sat, upd, ["ORD_ID"], "LD_END_DT", EXPIRE_INSERT,
                  cols_to_update=["LD_END_DT", "SRC_EXPRN_DT"], source_filter="F")


@register("merge_expire_ref_key", merge_oracle(
    dedup_sql("upd", ["REF_ID"], SAT_COLS), ["REF_ID"], pred=OPEN_F, residual="t.BTCH_DT <= s.BTCH_DT",
    set_src={"LD_END_DT": "LD_END_DT"}, insert=EXPIRE_INSERT))
def q_merge_expire_ref_key(spark, sf_dir):
    """One source row closes every open version of its REF_ID that is not newer."""
    sat, upd = _sat_upd(spark, sf_dir)
    return expire(sat, dedup_by_key(upd, ["REF_ID"]), ["REF_ID"], "LD_END_DT", EXPIRE_INSERT, source_filter="F")


@register("merge_expire_ref_key_shuffle", ORACLE["merge_expire_ref_key"])
def q_merge_expire_ref_key_shuffle(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return expire(sat, dedup_by_key(upd, ["REF_ID"]), ["REF_ID"], "LD_END_DT", EXPIRE_INSERT, source_filter="F",
                  strategy="shuffle")


@register("merge_expire_part_literal", merge_oracle(
    "SELECT * FROM upd WHERE PART_COL = '2'", ["ORD_ID"], pred=OPEN_F + " AND PART_COL = '2'",
    residual="t.BTCH_DT <= s.BTCH_DT", set_src={"LD_END_DT": "LD_END_DT"}, insert=EXPIRE_INSERT))
def q_merge_expire_part_literal(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return expire(sat, upd.where(F.col("PART_COL") == "2"), ["ORD_ID"], "LD_END_DT", EXPIRE_INSERT,
                  source_filter="F")


@register("merge_close_open_shuffle", ORACLE["merge_close_open"])
def q_merge_close_open_shuffle(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return close_and_insert(sat, upd, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", END_VALUE,
                            source_filter="F", strategy="shuffle")


@register("merge_historical_update_shuffle", ORACLE["merge_historical_update"])
def q_merge_historical_update_shuffle(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    keys = historical_update_keys(TABLE_KEYS, upd.columns)
    return update_columns(sat, upd, keys, ["VAL", "LD_END_DT", "REC_SRC_NM"], dedup_source=True,
                          source_filter="F", strategy="shuffle")


@register("merge_expire_two_cols_shuffle", ORACLE["merge_expire_two_cols"])
def q_merge_expire_two_cols_shuffle(spark, sf_dir):
    sat, upd = _sat_upd(spark, sf_dir)
    return expire(sat, upd, ["ORD_ID"], "LD_END_DT", EXPIRE_INSERT,
                  cols_to_update=["LD_END_DT", "SRC_EXPRN_DT"], source_filter="F", strategy="shuffle")


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedup_by_key", dedup_sql("lineitem", ["l_orderkey", "l_linenumber"], LINEITEM_COLS))
def q_dedup_by_key(spark, sf_dir):
    return dedup_by_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("dedup_events_by_type", dedup_sql("events", ["event_type"], EVENT_COLS))
def q_dedup_events_by_type(spark, sf_dir):
    """Five keys, each holding about a fifth of the rows: the hot-group case of the de-duplication."""
    return dedup_by_key(table(spark, sf_dir, "events"), ["event_type"])


@register("distinct_part_col", oracle(["sat"], "SELECT DISTINCT PART_COL FROM sat"))
def q_distinct_part_col(spark, sf_dir):
    return distinct_values(frame(spark, sf_dir, "sat"), "PART_COL")


# --------------------------------------------------------------------------------------
# Retention over ``runs`` with configuration ``cfg``
# --------------------------------------------------------------------------------------

RETENTION_TS = _dt.datetime(2024, 2, 1, 0, 0, 0)
ELIGIBLE_SQL = ("SELECT * FROM cfg WHERE actv_inactv_ind = 'Y' AND dq_table_name IS NOT NULL "
                "AND COALESCE(no_of_exec_to_keep, 0) > 0")


def _turn_sql(turn: int, before: str) -> str:
    """The plan rows of the ``turn``-th configuration row per table, over the runs left before it."""
    return f"""stats{turn} AS (SELECT dq_table_name, COUNT(DISTINCT run_id) AS n_runs, MAX(run_id) AS max_run FROM {before} GROUP BY dq_table_name),
plan{turn} AS (
  SELECT e.dq_err_tables_master_id, e.dq_table_name, CAST(s.n_runs AS BIGINT) AS exec_avail_in_frt,
         CAST(s.max_run - e.no_of_exec_to_keep AS BIGINT) AS max_run_id_deleted_in_frt,
         CAST((SELECT COUNT(*) FROM {before} r WHERE r.dq_table_name = e.dq_table_name
               AND r.run_id <= s.max_run - e.no_of_exec_to_keep) AS BIGINT) AS records_removed_from_frt
  FROM (SELECT * FROM elig WHERE turn = {turn}) e JOIN stats{turn} s ON s.dq_table_name = e.dq_table_name
  WHERE s.n_runs - e.no_of_exec_to_keep > 0),
left{turn} AS (SELECT r.* FROM {before} r LEFT JOIN plan{turn} p ON r.dq_table_name = p.dq_table_name
  WHERE NOT COALESCE(r.run_id <= p.max_run_id_deleted_in_frt, FALSE))"""


PLAN_SQL = ",\n".join([
    f"elig AS (SELECT *, row_number() OVER (PARTITION BY dq_table_name ORDER BY dq_err_tables_master_id) AS turn FROM ({ELIGIBLE_SQL}) q)",
    _turn_sql(1, "runs"), _turn_sql(2, "left1"), _turn_sql(3, "left2"),
    "plan AS (SELECT * FROM plan1 UNION ALL SELECT * FROM plan2 UNION ALL SELECT * FROM plan3)"])


def _retention_sql(body: str) -> str:
    return sql_with(["runs", "cfg"], PLAN_SQL, body)


@register("retention_eligible", oracle(["cfg"], ELIGIBLE_SQL))
def q_retention_eligible(spark, sf_dir):
    return retention.eligible(frame(spark, sf_dir, "cfg"))


@register("retention_plan", _retention_sql("SELECT * FROM plan"))
def q_retention_plan(spark, sf_dir):
    return retention.plan(frame(spark, sf_dir, "runs"), frame(spark, sf_dir, "cfg"))


@register("retention_apply", _retention_sql("SELECT * FROM left3"))
def q_retention_apply(spark, sf_dir):
    runs, cfg = frame(spark, sf_dir, "runs"), frame(spark, sf_dir, "cfg")
    return retention.apply(runs, retention.plan(runs, cfg))


@register("retention_log", _retention_sql(
    "SELECT dq_err_tables_master_id, TIMESTAMP '2024-02-01 00:00:00' AS execution_ts, dq_table_name, "
    "exec_avail_in_frt, max_run_id_deleted_in_frt, records_removed_from_frt FROM plan"))
def q_retention_log(spark, sf_dir):
    runs, cfg = frame(spark, sf_dir, "runs"), frame(spark, sf_dir, "cfg")
    return retention.audit_log(retention.plan(runs, cfg), RETENTION_TS)


# --------------------------------------------------------------------------------------
# Accounting cycles
# --------------------------------------------------------------------------------------

LATEST_CTES = """mx AS (SELECT MAX(CYC_YEAR) AS y FROM {f}),
mm AS (SELECT MAX(CYC_MONTH) AS m FROM {f}, mx WHERE CYC_YEAR = mx.y)"""
LATEST_SQL = """SELECT c.* FROM {f} c, mx, mm
WHERE c.CYC_YEAR = mx.y AND (c.CYC_MONTH = mm.m OR (mm.m <> 1 AND c.CYC_MONTH = mm.m - 1))"""


def _cycle(spark, sf_dir, name="cycle", **kw):
    return cycles.read_cycle(frame(spark, sf_dir, name), year_col="CYC_YEAR", month_col="CYC_MONTH", **kw)


@register("cycle_historical", oracle(["cycle"], "SELECT * FROM cycle"))
def q_cycle_historical(spark, sf_dir):
    return _cycle(spark, sf_dir, kind="historical")


@register("cycle_year", oracle(["cycle"], "SELECT * FROM cycle WHERE CYC_YEAR = 98"))
def q_cycle_year(spark, sf_dir):
    return _cycle(spark, sf_dir, kind="full", batch_date="19980630")


@register("cycle_latest_two_months",
          sql_with(["cycle"], LATEST_CTES.format(f="cycle"), LATEST_SQL.format(f="cycle")))
def q_cycle_latest_two_months(spark, sf_dir):
    return _cycle(spark, sf_dir, kind="daily")


@register("cycle_january",
          sql_with(["cycle_jan"], LATEST_CTES.format(f="cycle_jan"), LATEST_SQL.format(f="cycle_jan")))
def q_cycle_january(spark, sf_dir):
    return _cycle(spark, sf_dir, "cycle_jan", kind="daily")


# --------------------------------------------------------------------------------------
# Reference lookups
# --------------------------------------------------------------------------------------

@register("ref_all", oracle(["ref"], "SELECT * FROM ref"))
def q_ref_all(spark, sf_dir):
    return read_reference(spark, stored(spark, sf_dir, "ref"))


@register("ref_active", oracle(["ref"], "SELECT * FROM ref WHERE IS_ACTV_FLG = '1'"))
def q_ref_active(spark, sf_dir):
    return read_reference(spark, stored(spark, sf_dir, "ref"), is_active=1)


@register("connector_roundtrip", oracle(["sat"], "SELECT * FROM sat"))
def q_connector_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "connector")
    write_connector(frame(spark, sf_dir, "sat"), "parquet", {"path": path})
    return read_connector(spark, "parquet", {"path": path})


@register("ref_lookup_list", oracle(["ref"], (
    "SELECT COALESCE(CAST(VAL AS VARCHAR), 'None') AS VAL FROM ref "
    "WHERE lower(SEG) = 'building' AND lower(NATION) = '7'")))
def q_ref_lookup_list(spark, sf_dir):
    return lookup(read_reference(spark, stored(spark, sf_dir, "ref")), {"SEG": "Building", "NATION": 7}, "VAL")


@register("ref_lookup_list_padded", oracle(["ref"], (
    "SELECT CASE WHEN length(v) >= 3 THEN v ELSE lpad(v, 3, '0') END AS VAL FROM ("
    "SELECT regexp_replace(COALESCE(CAST(VAL AS VARCHAR), 'None'), '^\\s+|\\s+$', '', 'g') AS v FROM ref "
    "WHERE lower(SEG) = 'machinery') x")))
def q_ref_lookup_list_padded(spark, sf_dir):
    return lookup(read_reference(spark, stored(spark, sf_dir, "ref")), {"SEG": "MACHINERY"}, "VAL", pad_length=3, pad_char="0")
