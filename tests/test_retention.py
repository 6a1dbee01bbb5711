"""Retention: cut-off arithmetic, guards, null and gapped run ids, per-table isolation."""

from __future__ import annotations

import datetime as dt

from lakeshift.operators import retention

RUNS_DDL = "dq_table_name string, run_id bigint, v int"


def cfg(spark, rows):
    return retention.config_frame(spark, [
        dict(zip(["dq_err_tables_master_id", "dq_table_name", "no_of_exec_to_keep", "actv_inactv_ind"], r))
        for r in rows])


def test_gaps_nulls_and_guard(spark):
    runs = spark.createDataFrame(
        [("a", 1, 0), ("a", 1, 0), ("a", 5, 0), ("a", 9, 0), ("a", None, 0),   # runs 1,5,9: keep 2 -> cut 7
         ("b", 1, 0), ("b", 2, 0),                                             # 2 runs, keep 2: nothing
         ("c", 3, 0), ("c", 4, 0), ("c", 10, 0),                               # keep 1 -> cut 9
         ("d", 1, 0)],                                                         # not configured
        RUNS_DDL)
    conf = cfg(spark, [(1, "a", 2, "Y"), (2, "b", 2, "Y"), (3, "c", 1, "Y"), (4, "x", 1, "N"), (5, None, 3, "Y"),
                       (6, "d", None, "Y"), (7, "d", 0, "Y")])
    assert sorted(r.dq_table_name for r in retention.eligible(conf).collect()) == ["a", "b", "c"]
    plan = {r.dq_table_name: r for r in retention.plan(runs, conf).collect()}
    assert set(plan) == {"a", "c"}
    assert (plan["a"].exec_avail_in_frt, plan["a"].max_run_id_deleted_in_frt, plan["a"].records_removed_from_frt) == (
        3, 7, 3)
    assert (plan["c"].exec_avail_in_frt, plan["c"].max_run_id_deleted_in_frt, plan["c"].records_removed_from_frt) == (
        3, 9, 2)
    kept = sorted((r.dq_table_name, -1 if r.run_id is None else r.run_id)
                  for r in retention.apply(runs, retention.plan(runs, conf)).collect())
    assert kept == [("a", -1), ("a", 9), ("b", 1), ("b", 2), ("c", 10), ("d", 1)]


def test_log_rows(spark):
    runs = spark.createDataFrame([("a", i, 0) for i in range(1, 11)], RUNS_DDL)
    conf = cfg(spark, [(42, "a", 4, "Y")])
    ts = dt.datetime(2024, 5, 1, 12, 0)
    (row,) = retention.audit_log(retention.plan(runs, conf), ts).collect()
    assert tuple(row) == (42, ts, "a", 10, 6, 6)


def test_per_table_isolation(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.createDataFrame([(i, 1) for i in range(1, 6)], "run_id bigint, v int").write.parquet(good)
    paths = {"good": good, "missing": str(tmp_path / "nope")}
    written, logs = {}, []
    conf = cfg(spark, [(1, "good", 2, "Y"), (2, "missing", 1, "Y")])
    errors = retention.run_retention(
        spark, conf, lambda n: spark.read.parquet(paths[n]),
        lambda n, df: written.__setitem__(n, sorted(r.run_id for r in df.collect())),
        logs.append, executed_at=dt.datetime(2024, 1, 1))
    assert [e["table"] for e in errors] == ["missing"]
    assert written == {"good": [4, 5]}
    assert [tuple(r)[2:] for r in logs[0].collect()] == [("good", 5, 3, 3)]


def test_parallel_tables_give_the_same_outcome(spark, tmp_path):
    paths = {}
    for name, top in (("t1", 6), ("t2", 9), ("t3", 4)):
        paths[name] = str(tmp_path / name)
        spark.createDataFrame([(i, 1) for i in range(1, top + 1)], "run_id bigint, v int").write.parquet(paths[name])
    conf = cfg(spark, [(1, "t1", 2, "Y"), (2, "t2", 3, "Y"), (3, "t3", 1, "Y"), (4, "gone", 1, "Y")])
    paths["gone"] = str(tmp_path / "missing")
    results = []
    for workers in (1, 3):
        written, logs = {}, []
        errors = retention.run_retention(
            spark, conf, lambda n: spark.read.parquet(paths[n]),
            lambda n, df: written.__setitem__(n, sorted(r.run_id for r in df.collect())),
            logs.append, executed_at=dt.datetime(2024, 1, 1), max_parallel_tables=workers)
        results.append((written, sorted(tuple(r) for r in logs[0].collect()), [e["table"] for e in errors]))
    assert results[0] == results[1]
    assert results[0][0] == {"t1": [5, 6], "t2": [7, 8, 9], "t3": [4]}
    assert results[0][2] == ["gone"]


def test_two_rows_for_a_table_take_effect_one_after_the_other(spark):
    runs = spark.createDataFrame([("a", i, 0) for i in range(1, 11) for _ in range(2)], RUNS_DDL)
    for keeps, expected in (((3, 5), [(10, 7, 14)]), ((5, 3), [(10, 5, 10), (5, 7, 4)])):
        conf = cfg(spark, [(n + 1, "a", keep, "Y") for n, keep in enumerate(keeps)])
        plan = retention.plan(runs, conf)
        assert [tuple(r)[2:] for r in sorted(plan.collect())] == expected
        assert retention.apply(runs, plan).count() == 6


def test_two_rows_rewrite_a_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, 1) for i in range(1, 11)], "run_id bigint, v int").write.parquet(path)
    written, logs = [], []
    conf = cfg(spark, [(1, "t", 5, "Y"), (2, "t", 3, "Y")])
    errors = retention.run_retention(
        spark, conf, lambda n: spark.read.parquet(path),
        lambda n, df: written.append(sorted(r.run_id for r in df.collect())), logs.append,
        executed_at=dt.datetime(2024, 1, 1), max_parallel_tables=4)
    assert errors == [] and written == [[8, 9, 10]]
    assert sorted(tuple(r)[0] for r in logs[0].collect()) == [1, 2]


def test_broken_and_clashing_tables_do_not_stop_the_others(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("good", "corrupt", "dates", "words", "digits")}
    spark.createDataFrame([(i, 1) for i in range(1, 6)], "run_id bigint, v int").write.parquet(paths["good"])
    spark.createDataFrame([(i, 1) for i in range(1, 6)], "run_id bigint, v int").write.parquet(paths["corrupt"])
    spark.createDataFrame([(dt.date(2024, 1, 1),)], "run_id date").write.parquet(paths["dates"])
    spark.createDataFrame([("one",), ("2",)], "run_id string").write.parquet(paths["words"])
    spark.createDataFrame([(str(i),) for i in range(1, 4)], "run_id string").write.parquet(paths["digits"])
    schema = spark.read.parquet(paths["corrupt"]).schema
    for f in (tmp_path / "corrupt").glob("*.parquet"):
        f.write_bytes(b"no parquet")

    def load(name):
        return spark.read.schema(schema).parquet(paths[name]) if name == "corrupt" else spark.read.parquet(paths[name])

    written, logs = {}, []
    conf = cfg(spark, [(n, t, 2, "Y") for n, t in enumerate(paths)])
    errors = retention.run_retention(
        spark, conf, load, lambda n, df: written.__setitem__(n, sorted(int(r.run_id) for r in df.collect())), logs.append,
        executed_at=dt.datetime(2024, 1, 1))
    assert sorted(e["table"] for e in errors) == ["corrupt", "dates", "words"]
    assert written == {"good": [4, 5], "digits": [2, 3]}


def test_runs_that_are_partitions_are_dropped_without_a_rewrite(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.createDataFrame([(i, "x", 1.0) for i in range(1, 6)] + [(None, "x", 0.0)], "run_id long, s string, v double")
    df.write.partitionBy("s", "run_id").parquet(str(path))
    before = {str(f) for f in path.rglob("*.parquet")}
    assert retention.delete_runs(spark, str(path), 3) == "dropped"
    assert {str(f) for f in path.rglob("*.parquet")} == {f for f in before if not any(f"run_id={i}/" in f for i in (1, 2, 3))}
    flat = str(tmp_path / "flat")
    df.write.partitionBy("s").parquet(flat)
    assert retention.delete_runs(spark, flat, 3) == "rewritten"
    assert sorted((r.run_id or 0) for r in spark.read.parquet(flat).collect()) == [0, 4, 5]
    assert retention.partition_columns(spark, flat) == ["s"]


def _plain_plan(runs, entries):
    """Turn by turn over a table's run ids (with repeats and None): the plan rows."""
    left, rows = list(runs), []
    for entry_id, keep in entries:
        ids = {r for r in left if r is not None}
        if len(ids) - keep > 0:
            cut = max(ids) - keep
            gone = [r for r in left if r is not None and r <= cut]
            rows.append((entry_id, len(ids), cut, len(gone)))
            left = [r for r in left if r is None or r > cut]
    return rows


def test_any_number_of_entries_matches_turn_by_turn(spark):
    import random

    rng = random.Random(4)
    runs, conf, expected = [], [], []
    for n in range(40):
        name = f"t{n}"
        ids = [rng.choice([None, *rng.sample(range(-5, 40), 8)]) for _ in range(rng.randrange(1, 60))]
        entries = [(100 * n + i, rng.randrange(1, 25)) for i in range(rng.randrange(1, 9))]
        runs += [(name, r, 0) for r in ids]
        conf += [(i, name, keep, "Y") for i, keep in entries]
        expected += [(i, name, *rest) for i, *rest in _plain_plan(ids, entries)]
    rng.shuffle(conf)
    plan = retention.plan(spark.createDataFrame(runs, RUNS_DDL), cfg(spark, conf))
    assert sorted(map(tuple, plan.collect())) == sorted(expected) and len(expected) > 40


def test_one_scan_whatever_the_number_of_entries(spark, tmp_path):
    import contextlib
    import io

    path = str(tmp_path / "runs")
    spark.createDataFrame([("a", i, 0) for i in range(60)], RUNS_DDL).write.parquet(path)
    sizes = []
    for n in (1, 20):
        conf = cfg(spark, [(i, "a", 50 - 2 * i, "Y") for i in range(n)])
        plan = retention.plan(spark.read.parquet(path), conf)
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            plan.explain()
        assert out.getvalue().count("FileScan parquet") == 1
        assert plan.count() == n
        sizes.append(len(out.getvalue().splitlines()))
    assert sizes[0] == sizes[1]


class Stopped(Exception):
    pass


def _job(spark, root, conf, stop_at=None):
    """A run of the housekeeping job over tables under ``root``; ``stop_at`` names the step (log or
    done, with the number of the call) at which the process ends."""
    from lakeshift.sinks.publish import folder_exists
    from lakeshift.sinks.writers import replace_table

    calls = {"log": 0, "done": 0}
    log_path = f"{root}/log"

    def step(name):
        calls[name] += 1
        if stop_at == (name, calls[name]):
            raise Stopped(name)

    def append_log(df):
        step("log")
        df.write.mode("append").parquet(log_path)

    class Stopping(retention.Journal):
        def write(self, state, rows):
            if state == "done":
                step("done")
            super().write(state, rows)

    written = []

    def write(name, df):
        written.append(name)
        replace_table(spark, df, f"{root}/{name}")

    errors = retention.run_retention(
        spark, conf, lambda n: spark.read.parquet(f"{root}/{n}"), write, append_log, executed_at=dt.datetime(2024, 1, 1),
        journal=Stopping(spark, f"{root}/journal"),
        read_log=lambda: spark.read.schema(retention.LOG_SCHEMA).parquet(log_path) if folder_exists(spark, log_path) else None)
    return errors, written


def test_a_stopped_job_is_finished_by_the_next_one(spark, tmp_path):
    import pytest

    conf = cfg(spark, [(1, "t1", 2, "Y"), (2, "t2", 3, "Y"), (3, "t2", 1, "Y")])
    expected = [(1, "t1", 6, 4, 4), (2, "t2", 9, 6, 6), (3, "t2", 3, 8, 2)]
    for n, stop in enumerate([("log", 1), ("done", 1), ("log", 2), ("done", 2)]):
        root = str(tmp_path / f"case{n}")
        for name, top in (("t1", 6), ("t2", 9)):
            spark.createDataFrame([(i, 1) for i in range(1, top + 1)], "run_id bigint, v int").write.parquet(f"{root}/{name}")
        with pytest.raises(Stopped):
            _job(spark, root, conf, stop)
        errors, written = _job(spark, root, conf)
        assert errors == [] and len(written) <= 1  # deleted runs are not deleted again
        rows = spark.read.schema(retention.LOG_SCHEMA).parquet(f"{root}/log").collect()
        assert sorted((r[0], *tuple(r)[2:]) for r in rows) == expected
        assert [sorted(r.run_id for r in spark.read.parquet(f"{root}/{t}").collect()) for t in ("t1", "t2")] == [[5, 6], [9]]
        assert retention.Journal(spark, f"{root}/journal").open() == []
        assert _job(spark, root, conf) == ([], [])


def test_a_table_that_cannot_be_finished_stays_open(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(i, 1) for i in range(1, 6)], "run_id bigint, v int").write.parquet(f"{root}/t")
    journal = retention.Journal(spark, f"{root}/journal")
    schema = retention.LOG_SCHEMA
    when = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(1, when, "t", 5, 3, 3), (2, when, "gone", 5, 3, 3)], schema).collect()
    journal.write("intent", rows)
    errors, written = _job(spark, root, cfg(spark, [(1, "t", 2, "Y"), (2, "gone", 2, "Y")]))
    assert [e["table"] for e in errors] == ["gone"] and written == ["t"]
    assert [r.dq_table_name for r in journal.open()] == ["gone"]


def test_run_ids_that_are_no_numbers_are_counted(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1",), ("2",), ("x",), ("3",), (None,), ("2.5.1",)], "run_id string").write.parquet(path)
    rejected = {}
    plan, errors = retention.plan_tables(
        spark, cfg(spark, [(1, "t", 1, "Y")]), lambda n: spark.read.parquet(path), rejected=rejected)
    assert errors == [] and [tuple(r) for r in plan.collect()] == [(1, "t", 3, 2, 2)]
    assert rejected["t"].get["rejected"] == 2
