"""Property tests: generated options and rows against independent models."""

from __future__ import annotations

import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from lakeshift.functions.predicates import apply_read_type, resolve_read_spec
from lakeshift.operators import retention
from lakeshift.operators.scd2 import close_and_insert, update_columns

SCHEMA = T.StructType([
    T.StructField("REC_SRC_NM", T.StringType()), T.StructField("LD_DT", T.TimestampNTZType()),
    T.StructField("LD_END_DT", T.TimestampNTZType()), T.StructField("id", T.IntegerType()),
])
DAYS = [dt.datetime(2024, 1, d, h) for d in (1, 2, 3, 4) for h in (0, 23)]
TYPES = ["full", "historical", "rec-source-filtered", "rec-source-filtered-active", "rec-source-filtered-list",
         "rec-source-filtered-list-active", "active-filtered", "active-filtered-with-loaddate", "loaddate-filtered",
         "rec-source-filtered-with-loaddate", "rec-source-filtered-list-active-with-loaddate",
         "rec-source-filtered-active-with-loaddate", "something-else"]

row = st.tuples(st.sampled_from(["A", "B", "NA", None]), st.sampled_from(DAYS), st.sampled_from([None, DAYS[0]]))


def model(opts: dict, source_list: list, export: bool, kind: str, r: tuple) -> bool:
    """The decision table, written out directly from its description."""
    src_val, ld, end = r
    rt = opts.get("read-type", "full")
    if kind != "mart" and opts.get("historicalFlag") == "true":
        rt = "historical"
    source = opts.get("source-filter")
    source = None if source in (None, "NA") else source
    win = None
    if opts.get("start_dt") not in (None, "", "NA") and opts.get("end_dt") not in (None, "", "NA"):
        win = (dt.date.fromisoformat(opts["start_dt"]), dt.date.fromisoformat(opts["end_dt"]))
    src = src_val == (source if source is not None else "NA")
    act = end is None
    lst = src_val in source_list if src_val is not None else False
    inwin = True if win is None else win[0] <= ld.date() <= win[1]
    if source is not None and (rt in ("rec-source-filtered", "historical") or export):
        return src
    table = {
        "rec-source-filtered-active": src and act,
        "rec-source-filtered-list": lst,
        "rec-source-filtered-list-active": lst and act,
        "active-filtered": act,
    }
    if kind == "table":
        table.update({
            "active-filtered-with-loaddate": act and inwin,
            "loaddate-filtered": inwin,
            "rec-source-filtered-with-loaddate": src and inwin,
            "rec-source-filtered-list-active-with-loaddate": lst and act and inwin,
            "rec-source-filtered-active-with-loaddate": src and act and inwin,
        })
    return table.get(rt, True)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(row, min_size=1, max_size=8),
    read_type=st.sampled_from(TYPES),
    source=st.sampled_from([None, "A", "B", "NA"]),
    window=st.sampled_from([None, ("2024-01-02", "2024-01-03"), ("2024-01-01", "NA")]),
    source_list=st.sampled_from([[], ["A"], ["A", "B"]]),
    export=st.booleans(),
    historical=st.booleans(),
    kind=st.sampled_from(["table", "wide"]),
)
def test_read_filter_matches_model(spark, rows, read_type, source, window, source_list, export, historical, kind):
    opts = {"read-type": read_type}
    if source is not None:
        opts["source-filter"] = source
    if window:
        opts["start_dt"], opts["end_dt"] = window
    if historical:
        opts["historicalFlag"] = "true"
    data = [(*r, i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    spec = resolve_read_spec(opts, None, kind=kind, source_list=source_list, export=export)
    got = sorted(r.id for r in apply_read_type(df, spec).collect())
    want = [i for i, r in enumerate(rows) if model(opts, source_list, export, kind, r)]
    assert got == want


MSCHEMA = "K long, R long, REC_SRC_NM string, LD_DT timestamp_ntz, LD_END_DT timestamp_ntz, VAL double"
MCOLS = ["K", "R", "REC_SRC_NM", "LD_DT", "LD_END_DT", "VAL"]
mrow = st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, 7]), st.sampled_from(["F", "O"]),
                 st.sampled_from(DAYS[:3]), st.sampled_from([None, DAYS[5]]),
                 st.integers(0, 9).map(float))


def duck_merge(target, source, on, matched, insert):
    con = duckdb.connect()
    ddl = "K BIGINT, R BIGINT, REC_SRC_NM VARCHAR, LD_DT TIMESTAMP, LD_END_DT TIMESTAMP, VAL DOUBLE"
    con.execute(f"CREATE TABLE t ({ddl})")
    con.execute(f"CREATE TABLE s ({ddl})")
    if target:
        con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?)", target)
    if source:
        con.executemany("INSERT INTO s VALUES (?, ?, ?, ?, ?, ?)", source)
    sql = f"MERGE INTO t USING s ON ({on}) WHEN MATCHED THEN UPDATE SET {matched}"
    if insert:
        sql += f" WHEN NOT MATCHED THEN INSERT ({', '.join(MCOLS)}) VALUES ({', '.join('s.' + c for c in MCOLS)})"
    con.execute(sql)
    return sorted(map(repr, con.execute(f"SELECT {', '.join(MCOLS)} FROM t").fetchall()))


def ours(df):
    return sorted(map(repr, (tuple(r) for r in df.select(MCOLS).collect())))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(mrow, max_size=8), source=st.lists(mrow, max_size=4), shape=st.sampled_from(["M1", "M3"]))
def test_merges_match_duckdb(spark, target, source, shape):
    t = spark.createDataFrame(target, MSCHEMA)
    s = spark.createDataFrame(source, MSCHEMA)
    keys = ["K", "R", "LD_DT"]
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    if shape == "M1":
        on = "t.REC_SRC_NM = 'F' AND " + on + " AND t.LD_END_DT IS NULL"
        run = lambda: close_and_insert(t, s, keys, "LD_END_DT", "2030-01-01 00:00:00", source_filter="F",
                                       discover_partition=False)
        args = ("LD_END_DT = TIMESTAMP '2030-01-01 00:00:00'", True)
    else:
        run = lambda: update_columns(t, s, keys, ["VAL", "REC_SRC_NM"])
        args = ("VAL = s.VAL", False)
    try:
        want = duck_merge(target, source, on, *args)
    except duckdb.Error:
        try:
            run().collect()
        except Exception as exc:
            assert "more than one source row" in str(exc)
            return
        raise AssertionError("DuckDB rejected a double match that the merge accepted")
    assert ours(run()) == want



def retention_model(runs, cfg):
    """The housekeeping rules in plain Python: entries take effect one after the other, by id."""
    plan, runs = {}, list(runs)
    for cid, name, keep, active in cfg:
        if active != "Y" or name is None or (keep or 0) <= 0:
            continue
        ids = [r for t, r in runs if t == name and r is not None]
        if len(set(ids)) - keep <= 0:
            continue
        cut = max(ids) - keep
        plan[(cid, name)] = (len(set(ids)), cut, sum(1 for r in ids if r <= cut))
        runs = [(t, r) for t, r in runs if t != name or r is None or r > cut]
    return plan


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    runs=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(1, 12))),
                  max_size=30),
    cfg=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-1, 6)),
                           st.sampled_from(["Y", "N"])), max_size=4),
)
def test_retention_matches_model(spark, runs, cfg):
    cfg_rows = [(i + 1, name, keep, active) for i, (name, keep, active) in enumerate(cfg)]
    runs_df = spark.createDataFrame(runs, "dq_table_name string, run_id bigint")
    cfg_df = retention.config_frame(spark, [
        dict(zip(["dq_err_tables_master_id", "dq_table_name", "no_of_exec_to_keep", "actv_inactv_ind"], r))
        for r in cfg_rows])
    plan = retention.plan(runs_df, cfg_df)
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in plan.collect()}
    want = retention_model(runs, cfg_rows)
    assert got == want
    cuts = {}
    for (_, name), (_, cut, _) in want.items():
        cuts[name] = max(cut, cuts.get(name, cut))
    kept = sorted((t, -1 if r is None else r)
                  for t, r in (tuple(x) for x in retention.apply(runs_df, plan).collect()))
    want_kept = sorted((t, -1 if r is None else r) for t, r in runs
                       if not (t in cuts and r is not None and r <= cuts[t]))
    assert kept == want_kept
