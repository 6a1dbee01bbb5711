"""Commands for formats with row-level writes: their text, and what DuckDB makes of it."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid

import pytest

from compare import duck
from conftest import SF_SMALL
from lakeshift.operators import row_level
from lakeshift.operators.scd2 import (
    close_and_insert_spec,
    expire_spec,
    historical_update_keys,
    merge,
    scd2_keys,
    update_columns_spec,
    upsert_spec,
)
from lakeshift.plans.frames import frame, oracle
from lakeshift.plans.queries import END_VALUE, EXPIRE_INSERT, SAT_COLS, TABLE_KEYS, UPSERT_INSERT
from lakeshift.operators.dedup import dedup_by_key
from lakeshift.sinks.writers import write_partitioned


def flavours(upd):
    keys = scd2_keys(TABLE_KEYS, upd.columns)
    insert = [c for c in UPSERT_INSERT if c in SAT_COLS]
    update = historical_update_keys(TABLE_KEYS, upd.columns)
    return {
        "close": close_and_insert_spec(keys, "LD_END_DT", END_VALUE, source_filter="F"),
        "upsert": upsert_spec(upd.columns, keys, "LD_END_DT", insert, source_filter="F"),
        "history": update_columns_spec(update, ["VAL", "LD_END_DT", "REC_SRC_NM"], source_filter="F"),
        "expire": expire_spec(["ORD_ID"], "LD_END_DT", EXPIRE_INSERT, cols_to_update=["LD_END_DT", "SRC_EXPRN_DT"], source_filter="F"),
    }


@pytest.mark.parametrize("flavour", ["close", "upsert", "history", "expire"])
def test_the_command_does_what_the_plan_does(spark, flavour):
    upd = frame(spark, SF_SMALL, "upd")
    spec = flavours(upd)[flavour]
    if flavour == "history":
        upd = dedup_by_key(upd, list(spec.keys))
    spec = dataclasses.replace(spec, discover_partition=False)
    expected = merge(frame(spark, SF_SMALL, "sat"), upd, spec).select(SAT_COLS).collect()
    con = duck(SF_SMALL)
    con.execute("CREATE TABLE sat_stored AS " + oracle(["sat"], "SELECT * FROM sat"))
    con.register("batch", upd.toPandas().astype({"ORD_ID": "Int64"}))
    con.execute("CREATE TABLE upd_stored AS SELECT * FROM batch")
    con.execute(row_level.merge_command("sat_stored", "upd_stored", SAT_COLS, spec).replace("`", '"'))
    found = con.execute(f"SELECT {', '.join(SAT_COLS)} FROM sat_stored").fetchall()
    assert sorted(map(str, map(tuple, expected))) == sorted(map(str, found))


def test_text_of_the_commands(spark):
    spec = expire_spec(["K"], "END", ["K", "a`b"], source_filter="O'Hara")
    spec = dataclasses.replace(spec, partition_value="01", set_literal={"D": dt.date(2024, 1, 2), "N": None, "X": 1.5, "B": True})
    assert row_level.merge_command("db.t", "v", ["K", "END"], spec) == (
        "MERGE INTO db.t AS t USING v AS s\n"
        "ON t.`K` IS NOT DISTINCT FROM s.`K` AND t.`REC_SRC_NM` = 'O\\'Hara' AND t.`PART_COL` = '01' AND t.`END` IS NULL"
        " AND t.`BTCH_DT` <= s.`BTCH_DT`\n"
        "WHEN MATCHED THEN UPDATE SET `END` = s.`END`, `D` = CAST('2024-01-02' AS DATE), `N` = NULL, `X` = 1.5, `B` = true\n"
        "WHEN NOT MATCHED THEN INSERT (`K`, `a``b`) VALUES (s.`K`, s.`a``b`)")
    assert row_level.delete_command("db.t", 7) == "DELETE FROM db.t WHERE `run_id` <= 7"
    assert spark.sql("SELECT " + row_level.literal("it's \\ a 'text'")).first()[0] == "it's \\ a 'text'"


def test_spark_parses_the_command(spark):
    upd = frame(spark, SF_SMALL, "upd")
    for spec in flavours(upd).values():
        command = row_level.merge_command("t", "v", SAT_COLS, spec)
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(command)
        assert "MergeIntoTable" in plan.toString()


def test_the_way_follows_the_table(spark, tmp_path, monkeypatch):
    sat, upd = frame(spark, SF_SMALL, "sat"), frame(spark, SF_SMALL, "upd")
    spec = flavours(upd)["upsert"]
    expected = sorted(map(tuple, merge(sat, upd, spec).select(SAT_COLS).collect()), key=str)
    path, name = str(tmp_path / "files"), f"files_{uuid.uuid4().hex}"
    sat.write.partitionBy("REC_SRC_NM", "PART_COL").option("path", path).saveAsTable(name)
    assert row_level.merge_into(spark, name, upd, spec) == "files"
    assert sorted(map(tuple, spark.table(name).select(SAT_COLS).collect()), key=str) == expected
    # a format with row-level writes gets the command; no such format is at hand to run it
    monkeypatch.setattr(row_level, "provider", lambda spark, table: "delta")
    with pytest.raises(Exception, match="MERGE INTO TABLE|row-level|UNSUPPORTED"):
        row_level.merge_into(spark, name, upd, spec)
    with pytest.raises(Exception, match="DELETE|delete|UNSUPPORTED"):
        row_level.delete_from(spark, name, 3, "VAL")
    spark.sql(f"DROP TABLE {name}")


def test_delete_from_files(spark, tmp_path):
    name = f"runs_{uuid.uuid4().hex}"
    df = spark.createDataFrame([(i, "x") for i in range(1, 6)] + [(None, "y")], "run_id long, s string")
    df.write.partitionBy("s").option("path", str(tmp_path / "runs")).saveAsTable(name)
    assert row_level.delete_from(spark, name, 3) == "rewritten"
    assert sorted((r.run_id or 0) for r in spark.table(name).collect()) == [0, 4, 5]
    spark.sql(f"DROP TABLE {name}")
