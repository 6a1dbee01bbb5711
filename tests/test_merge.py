"""Merges against DuckDB's own MERGE INTO on hand-made and seeded random rows.

DuckDB's MERGE is an independent implementation: same ON condition (null-safe keys,
target literals, open predicate, batch residual), same SET and INSERT clauses.
"""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import types as T

from lakeshift.operators.dedup import dedup_by_key
from lakeshift.operators.scd2 import (
    MergeSpec,
    close_and_insert,
    expire,
    historical_update_keys,
    merge,
    scd2_keys,
    update_columns,
    upsert,
)
from compare import digest

COLS = ["K", "REF_ID", "REC_SRC_NM", "PART_COL", "LD_DT", "BTCH_DT", "SRC_EFF_DT", "SRC_EXPRN_DT", "LD_END_DT",
        "VAL"]
SCHEMA = T.StructType([
    T.StructField("K", T.LongType()), T.StructField("REF_ID", T.LongType()),
    T.StructField("REC_SRC_NM", T.StringType()), T.StructField("PART_COL", T.StringType()),
    T.StructField("LD_DT", T.TimestampNTZType()), T.StructField("BTCH_DT", T.TimestampNTZType()),
    T.StructField("SRC_EFF_DT", T.TimestampNTZType()), T.StructField("SRC_EXPRN_DT", T.TimestampNTZType()),
    T.StructField("LD_END_DT", T.TimestampNTZType()), T.StructField("VAL", T.DoubleType()),
])
DDL = ("K BIGINT, REF_ID BIGINT, REC_SRC_NM VARCHAR, PART_COL VARCHAR, LD_DT TIMESTAMP, BTCH_DT TIMESTAMP, "
       "SRC_EFF_DT TIMESTAMP, SRC_EXPRN_DT TIMESTAMP, LD_END_DT TIMESTAMP, VAL DOUBLE")
D = [dt.datetime(2024, 1, d) for d in range(1, 29)]

TARGET = [
    # K, REF, SRC, PART, LD, BTCH, EFF, EXPRN, END, VAL
    (1, 10, "F", "0", D[0], D[0], D[0], None, None, 1.0),       # open, matched
    (2, 20, "F", "1", D[1], D[1], D[1], None, D[5], 2.0),       # closed only: source row inserts
    (None, 30, "F", "0", D[2], D[2], D[2], None, None, 3.0),    # null key, matched by null key
    (4, 40, "O", "0", D[3], D[3], D[3], None, None, 4.0),       # other source system: untouched
    (5, 50, "F", "1", D[4], D[9], D[4], None, None, 5.0),       # newer batch than the source (expire)
    (6, 60, "F", "0", D[5], D[5], D[5], None, None, 6.0),       # not in source
    (7, 70, "F", "0", D[6], D[6], D[6], None, None, 7.0),       # several open versions of REF 70
    (8, 70, "F", "0", D[7], D[7], D[7], None, None, 8.0),
]
SOURCE = [
    (1, 10, "F", "0", D[0], D[0], D[0], None, D[20], 11.0),
    (2, 20, "F", "1", D[1], D[1], D[1], None, D[21], 12.0),
    (None, 30, "F", "0", D[2], D[2], D[2], None, D[22], 13.0),
    (4, 40, "F", "0", D[3], D[3], D[3], None, D[23], 14.0),
    (5, 50, "F", "1", D[4], D[4], D[4], None, D[24], 15.0),
    (9, 90, "F", "1", D[8], None, D[8], None, D[25], 19.0),     # new key, null batch
    (None, 99, "F", "0", D[9], D[9], D[9], None, None, 20.0),   # null key, no match
]


def frames(spark, target, source):
    return spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)


def duck_merge(target, source, on: str, matched: str | None, insert: list[str] | None,
               source_sql: str = "s") -> tuple:
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t ({DDL})")
    con.execute(f"CREATE TABLE s ({DDL})")
    ph = ", ".join("?" * len(COLS))
    if target:
        con.executemany(f"INSERT INTO t VALUES ({ph})", target)
    if source:
        con.executemany(f"INSERT INTO s VALUES ({ph})", source)
    sql = f"MERGE INTO t USING ({'SELECT * FROM s' if source_sql == 's' else source_sql}) AS s ON ({on})"
    if matched:
        sql += f" WHEN MATCHED THEN UPDATE SET {matched}"
    if insert:
        sql += f" WHEN NOT MATCHED THEN INSERT ({', '.join(insert)}) VALUES ({', '.join('s.' + c for c in insert)})"
    con.execute(sql)
    cur = con.execute(f"SELECT {', '.join(COLS)} FROM t")
    return digest(COLS, cur.fetchall())


def ours(df):
    return digest(df.columns, [tuple(r) for r in df.select(COLS).collect()])


def on_clause(keys, literals="", open_pred=True, residual=""):
    parts = [f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys]
    if literals:
        parts.insert(0, literals)
    if open_pred:
        parts.append("t.LD_END_DT IS NULL")
    if residual:
        parts.append(residual)
    return " AND ".join(parts)


STRATEGIES = ["broadcast", "shuffle"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_close_and_insert(spark, strategy):
    t, s = frames(spark, TARGET, SOURCE)
    keys = scd2_keys({"target-table-keys": ["K"]}, s.columns)
    assert keys == ["K", "REF_ID", "LD_DT", "BTCH_DT"]
    got = close_and_insert(t, s, keys, "LD_END_DT", "2030-01-01 00:00:00", source_filter="F", strategy=strategy)
    want = duck_merge(TARGET, SOURCE, on_clause(keys, "t.REC_SRC_NM = 'F'"),
                      "LD_END_DT = TIMESTAMP '2030-01-01 00:00:00'", COLS)
    assert ours(got) == want


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_upsert_partial_insert_and_scd2_column(spark, strategy):
    t, s = frames(spark, TARGET, SOURCE)
    keys = scd2_keys({"target-table-keys": ["K"]}, s.columns)
    insert = ["K", "REF_ID", "REC_SRC_NM", "PART_COL", "LD_DT", "BTCH_DT", "LD_END_DT", "rankColumn"]
    got = upsert(t, s, keys, "LD_END_DT", insert, scd2_columns=["VAL"], source_filter="F", strategy=strategy)
    want = duck_merge(TARGET, SOURCE, on_clause(keys, "t.REC_SRC_NM = 'F'"),
                      "LD_END_DT = s.LD_END_DT, VAL = s.VAL", [c for c in insert if c != "rankColumn"])
    assert ours(got) == want
    assert insert[-1] == "rankColumn"  # the caller's list is not changed


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_upsert_historical_sat_matches_closed_rows(spark, strategy):
    t, s = frames(spark, TARGET, SOURCE)
    keys = scd2_keys({"target-table-keys": ["K"]}, s.columns)
    got = upsert(t, s, keys, "LD_END_DT", COLS, historical_sat=True, source_filter="F", strategy=strategy)
    want = duck_merge(TARGET, SOURCE, on_clause(keys + ["SRC_EFF_DT"], "t.REC_SRC_NM = 'F'", open_pred=False),
                      "LD_END_DT = s.LD_END_DT", COLS)
    assert ours(got) == want


def test_upsert_partition_literal_discovered(spark):
    src = [r for r in SOURCE if r[3] == "1"]
    t, s = frames(spark, TARGET, src)
    keys = scd2_keys({"target-table-keys": ["K"]}, s.columns)
    got = upsert(t, s, keys, "LD_END_DT", COLS, source_filter="F")
    want = duck_merge(TARGET, src, on_clause(keys, "t.REC_SRC_NM = 'F' AND t.PART_COL = '1'"),
                      "LD_END_DT = s.LD_END_DT", COLS)
    assert ours(got) == want


def test_null_partition_value_adds_no_literal(spark):
    src = [r[:3] + (None,) + r[4:] for r in SOURCE[:2]]
    t, s = frames(spark, TARGET, src)
    keys = scd2_keys({"target-table-keys": ["K"]}, s.columns)
    got = upsert(t, s, keys, "LD_END_DT", COLS, source_filter="F")
    want = duck_merge(TARGET, src, on_clause(keys, "t.REC_SRC_NM = 'F'"), "LD_END_DT = s.LD_END_DT", COLS)
    assert ours(got) == want


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_historical_update_no_insert(spark, strategy):
    t, s = frames(spark, TARGET, SOURCE + [SOURCE[0][:9] + (99.0,)])  # duplicate key, de-duplicated
    keys = historical_update_keys({"target-table-keys": ["K"]}, s.columns)
    assert keys == ["K", "LD_DT", "REF_ID", "SRC_EFF_DT"]
    got = update_columns(t, s, keys, ["VAL", "REC_SRC_NM", "PART_COL"], dedup_source=True, strategy=strategy)
    dedup = ("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY K, LD_DT, REF_ID, SRC_EFF_DT "
             "ORDER BY REC_SRC_NM NULLS FIRST, PART_COL NULLS FIRST, BTCH_DT NULLS FIRST, SRC_EXPRN_DT NULLS FIRST, "
             "LD_END_DT NULLS FIRST, VAL NULLS FIRST) AS rn FROM s) WHERE rn = 1")
    want = duck_merge(TARGET, SOURCE + [SOURCE[0][:9] + (99.0,)], on_clause(keys, open_pred=False), "VAL = s.VAL",
                      None, source_sql=dedup)
    assert ours(got) == want
    assert got.count() == len(TARGET)


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("two", [False, True])
def test_expire(spark, strategy, two):
    # Keyed on K alone the two null-key source rows would both match the null-key target row.
    source = SOURCE[:6]
    t, s = frames(spark, TARGET, source)
    cols = ["LD_END_DT", "SRC_EXPRN_DT"] if two else None
    got = expire(t, s, ["K"], "LD_END_DT", COLS, cols_to_update=cols, source_filter="F", strategy=strategy)
    sets = "LD_END_DT = s.LD_END_DT" + (", SRC_EXPRN_DT = s.SRC_EFF_DT" if two else "")
    want = duck_merge(TARGET, source, on_clause(["K"], "t.REC_SRC_NM = 'F'", residual="t.BTCH_DT <= s.BTCH_DT"),
                      sets, COLS)
    assert ours(got) == want


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_expire_one_source_row_closes_many(spark, strategy):
    src = [(None, 70, "F", "0", D[10], D[10], D[10], None, D[26], 1.0)]
    t, s = frames(spark, TARGET, src)
    got = expire(t, s, ["REF_ID"], "LD_END_DT", COLS, source_filter="F", strategy=strategy)
    want = duck_merge(TARGET, src, on_clause(["REF_ID"], "t.REC_SRC_NM = 'F'", residual="t.BTCH_DT <= s.BTCH_DT"),
                      "LD_END_DT = s.LD_END_DT", COLS)
    assert ours(got) == want
    assert sum(1 for r in got.collect() if r.LD_END_DT == D[26]) == 2


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_double_match_raises(spark, strategy):
    t, s = frames(spark, TARGET, SOURCE + [SOURCE[0][:9] + (99.0,)])
    keys = scd2_keys({"target-table-keys": ["K"]}, s.columns)
    with pytest.raises(Exception, match="more than one source row"):
        upsert(t, s, keys, "LD_END_DT", COLS, source_filter="F", strategy=strategy).collect()


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_expire_double_match_raises_only_when_both_qualify(spark, strategy):
    newer = [(1, 10, "F", "0", D[0], D[15], D[0], None, D[27], 21.0)]
    # target row 1 has BTCH_DT D[0]: both source rows (D[0], D[15]) qualify -> error
    t, s = frames(spark, TARGET, SOURCE[:6] + newer)
    with pytest.raises(Exception, match="more than one source row"):
        expire(t, s, ["K"], "LD_END_DT", COLS, source_filter="F", strategy=strategy).collect()
    # target row 5 has BTCH_DT D[9]: only the D[15] row qualifies -> fine
    five = [(5, 50, "F", "1", D[4], D[15], D[4], None, D[27], 25.0)]
    t, s = frames(spark, TARGET, SOURCE[:6] + five)
    got = expire(t, s, ["K"], "LD_END_DT", COLS, source_filter="F", strategy=strategy)
    want = duck_merge(TARGET, SOURCE[:6] + five,
                      on_clause(["K"], "t.REC_SRC_NM = 'F'", residual="t.BTCH_DT <= s.BTCH_DT"),
                      "LD_END_DT = s.LD_END_DT", COLS)
    assert ours(got) == want


def test_empty_source_and_empty_target(spark):
    t, s = frames(spark, TARGET, [])
    keys = ["K", "REF_ID", "LD_DT", "BTCH_DT"]
    assert ours(upsert(t, s, keys, "LD_END_DT", COLS, source_filter="F")) == digest(COLS, TARGET)
    t, s = frames(spark, [], SOURCE)
    got = upsert(t, s, keys, "LD_END_DT", COLS, source_filter="F")
    assert ours(got) == digest(COLS, SOURCE)


def test_row_count_invariants(spark):
    t, s = frames(spark, TARGET, SOURCE)
    keys = scd2_keys({"target-table-keys": ["K"]}, s.columns)
    got = upsert(t, s, keys, "LD_END_DT", COLS, source_filter="F")
    rows = got.collect()
    # rows outside the slice are unchanged
    assert [r for r in rows if r.REC_SRC_NM == "O" and r.K == 4][0].LD_END_DT is None
    # target + unmatched source
    assert len(rows) == len(TARGET) + 5


def _random_case(seed: int):
    rnd = random.Random(seed)
    def row(src):
        k = rnd.choice([None, 1, 2, 3, 4, 5, 6])
        return (k, rnd.choice([None, 10, 11]), src, rnd.choice(["0", "1"]), D[rnd.randrange(3)],
                rnd.choice([None, D[rnd.randrange(5)]]), D[0], None,
                rnd.choice([None, None, D[20]]), float(rnd.randrange(100)))
    target = [row(rnd.choice(["F", "F", "O"])) for _ in range(rnd.randrange(0, 14))]
    source = [row("F")[:8] + (D[21 + rnd.randrange(5)], float(rnd.randrange(100))) for _ in range(rnd.randrange(0, 6))]
    return target, source


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("shape", ["upsert", "expire"])
def test_random_against_duckdb_merge(spark, seed, shape):
    target, source = _random_case(seed)
    t, s = frames(spark, target, source)
    if shape == "upsert":
        keys = ["K", "REF_ID", "LD_DT"]
        on = on_clause(keys, "t.REC_SRC_NM = 'F'")
        run = lambda: upsert(t, s, keys, "LD_END_DT", COLS, source_filter="F", discover_partition=False)
    else:
        on = on_clause(["K"], "t.REC_SRC_NM = 'F'", residual="t.BTCH_DT <= s.BTCH_DT")
        run = lambda: expire(t, s, ["K"], "LD_END_DT", COLS, source_filter="F", discover_partition=False)
    try:
        want = duck_merge(target, source, on, "LD_END_DT = s.LD_END_DT", COLS)
    except duckdb.Error as exc:
        assert "more than one source row" in str(exc) or "more than once" in str(exc)
        with pytest.raises(Exception, match="more than one source row"):
            run().collect()
        return
    assert ours(run()) == want


def test_generic_merge_spec_literal_and_source_columns(spark):
    t, s = frames(spark, TARGET, SOURCE[:6])
    spec = MergeSpec(keys=("K",), open_only=True, source_filter="F",
                     set_from_source={"VAL": "VAL"}, set_literal={"PART_COL": "X"}, insert_columns=())
    got = merge(t, s, spec)
    want = duck_merge(TARGET, SOURCE[:6], on_clause(["K"], "t.REC_SRC_NM = 'F'"), "VAL = s.VAL, PART_COL = 'X'", None)
    assert ours(got) == want


def test_dedup_is_repeatable_and_keeps_smallest(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, 2, "a"), (1, 1, None), (2, 5, "x"), (2, 5, "x")],
                               "k int, a int, b string")
    got = sorted(tuple(r) for r in dedup_by_key(df, ["k"]).collect())
    assert got == [(1, None, "b"), (2, 5, "x")]
    assert dedup_by_key(df, ["k", "a", "b"]).count() == 4


def test_bad_options_rejected(spark):
    t, s = frames(spark, TARGET, SOURCE)
    with pytest.raises(ValueError):
        expire(t, s, ["K"], "LD_END_DT", COLS, cols_to_update=["a", "b", "c"])
    with pytest.raises(ValueError):
        merge(t, s, MergeSpec(keys=("nope",)))
    with pytest.raises(ValueError):
        merge(t, s, MergeSpec(keys=("K",)), strategy="magic")


def test_unknown_columns_rejected(spark):
    t, s = frames(spark, TARGET, SOURCE[:2])
    with pytest.raises(ValueError, match="not target columns"):
        merge(t, s, MergeSpec(keys=("K",), insert_columns=("K", "nope")))
    with pytest.raises(ValueError, match="target lacks"):
        merge(t, s, MergeSpec(keys=("K",), set_literal={"nope": 1}))


FLAVOURS = {
    "close": lambda t, s: close_and_insert(t, s, ["k"], "ld_end_dt", "2030-01-01 00:00:00"),
    "upsert": lambda t, s: upsert(t, s, ["k"], "ld_end_dt", ["K", "REC_SRC_NM", "PART_COL", "Ld_Dt", "BTCH_DT", "REF_ID", "LD_END_DT", "VAL"]),
    "update": lambda t, s: update_columns(t, s, ["k"], ["val"]),
    "expire": lambda t, s: expire(t, s, ["k"], "ld_end_dt", ["K", "val", "BTCH_DT"], batch_col="btch_dt"),
}


@pytest.mark.parametrize("flavour", sorted(FLAVOURS))
def test_names_compare_without_case(spark, flavour):
    t, s = frames(spark, TARGET, SOURCE[:2])
    run = FLAVOURS[flavour]
    mixed = s.toDF(*[c.lower() if i % 2 else c.title() for i, c in enumerate(s.columns)])
    same = run(t, s.select(*s.columns))
    out = run(t, mixed)
    assert out.columns == t.columns and ours(out) == ours(same)


def test_a_target_column_the_source_lacks_is_an_error(spark):
    t, s = frames(spark, TARGET, SOURCE[:2])
    with pytest.raises(ValueError, match="missing from source"):
        close_and_insert(t, s.drop("VAL"), ["K"], "LD_END_DT", "2030-01-01 00:00:00")
    with pytest.raises(ValueError, match="differ only in case"):
        close_and_insert(t, s.withColumn("extra", s["VAL"]).withColumnRenamed("extra", "Val2").select("*", s["K"].alias("a")).toDF(*s.columns, "x", "X"), ["K"], "LD_END_DT", "2030-01-01 00:00:00")


def test_map_columns_merge_and_deduplicate(spark):
    ddl = "K long, END timestamp_ntz, M map<string,int>, N array<map<string,int>>"
    t = spark.createDataFrame([(1, None, {"a": 1}, [{"z": 1}]), (2, None, None, None)], ddl)
    s = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), {"b": 2}, None), (3, None, {"c": 3}, [{}])], ddl)
    spec = MergeSpec(keys=("K",), end_key="END", set_from_source={"END": "END", "M": "M"}, insert_columns=None)
    assert sorted((r.K, r.M) for r in merge(t, s, spec).collect()) == [(1, {"b": 2}), (2, None), (3, {"c": 3})]
    twice = spark.createDataFrame([(1, None, {"b": 1}, None), (1, None, {"a": 9}, None), (1, None, {"a": 9}, [{"q": 1}])], ddl)
    (row,) = dedup_by_key(twice, ["K"]).collect()
    assert row.M == {"a": 9}


def test_close_and_insert_aggregates_by_hash_only(spark):
    t, s = frames(spark, TARGET, SOURCE[:2])
    out = close_and_insert(t, s, ["K"], "LD_END_DT", "2030-01-01 00:00:00", source_filter="F")
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
