"""Tables stored in buckets: merges that do not move them, and one pass over the source."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeshift.operators.clustered import clustered_plan, layout, merge_into_clustered, write_clustered
from lakeshift.operators.merge_table import merge_into_table
from lakeshift.operators.scd2 import expire_spec, merge, scd2_keys, upsert_spec
from lakeshift.plans.frames import frame
from lakeshift.plans.queries import EXPIRE_INSERT, SAT_COLS, TABLE_KEYS, UPSERT_INSERT
from lakeshift.sinks.writers import write_partitioned
from test_scale import conf, plan_text

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def stored(spark, tmp_path):
    """The satellite in 8 buckets of its order id."""
    name = f"sat_{uuid.uuid4().hex}"
    write_clustered(frame(spark, SF_SMALL, "sat"), name, str(tmp_path / "sat"), ["ORD_ID"], 8)
    yield name
    spark.sql(f"DROP TABLE {name}")


def specs(upd):
    return {
        "upsert": upsert_spec(upd.columns, scd2_keys(TABLE_KEYS, upd.columns), "LD_END_DT", UPSERT_INSERT, source_filter="F"),
        "expire": expire_spec(["ORD_ID"], "LD_END_DT", EXPIRE_INSERT, source_filter="F"),
    }


def rows(df):
    return sorted(map(tuple, df.select(SAT_COLS).collect()), key=str)


def exchanges_of_target(spark, df):
    """Exchanges between the scan of the stored table and the first join above it, by the plan's
    indentation: the text above a scan line, up to a join, of lines that lead to it."""
    found = []
    lines = plan_text(df).splitlines()
    for i, line in enumerate(lines):
        if "FileScan parquet spark_catalog" not in line:
            continue
        depth = line.index("FileScan")
        for above in reversed(lines[:i]):
            bare = above.lstrip(" :+-*()0123456789")
            if not bare or above.index(bare) >= depth:
                continue
            depth = above.index(bare)
            if "Join" in bare:
                break
            if bare.startswith("Exchange"):
                found.append(bare)
    return found


@pytest.mark.parametrize("flavour", ["upsert", "expire"])
def test_the_target_is_not_shuffled(spark, stored, flavour):
    upd = frame(spark, SF_SMALL, "upd")
    spec = specs(upd)[flavour]
    with conf(spark, **NO_BROADCAST):
        known = upd.where("ORD_ID IS NOT NULL")
        plan = clustered_plan(spark, stored, known, spec, null_keys=False)
        assert "SortMergeJoin" in plan_text(plan) and "Bucketed: true" in plan_text(plan)
        assert exchanges_of_target(spark, plan) == []
        assert exchanges_of_target(spark, merge(spark.table(stored), known, spec)) != []
        assert rows(plan) == rows(merge(frame(spark, SF_SMALL, "sat"), known, spec))


@pytest.mark.parametrize("flavour", ["upsert", "expire"])
@pytest.mark.parametrize("nulls", [True, False])
def test_merge_into_buckets(spark, stored, flavour, nulls):
    upd = frame(spark, SF_SMALL, "upd")
    if not nulls:
        upd = upd.where("ORD_ID IS NOT NULL")
    spec = specs(upd)[flavour]
    with conf(spark, **NO_BROADCAST):
        merge_into_clustered(spark, stored, upd, spec)
    assert rows(spark.table(stored)) == rows(merge(frame(spark, SF_SMALL, "sat"), upd, spec))
    assert layout(spark, stored)["buckets"] == 8
    # a second merge reads the buckets that the first one wrote
    again = merge_into_clustered(spark, stored, upd.withColumn("VAL", F.col("VAL") + 5), spec)
    assert again["partitions"] > 0


def test_a_table_that_is_not_clustered_or_clustered_otherwise(spark, tmp_path):
    name = f"flat_{uuid.uuid4().hex}"
    frame(spark, SF_SMALL, "sat").limit(5).write.option("path", str(tmp_path / "flat")).saveAsTable(name)
    with pytest.raises(ValueError, match="buckets"):
        layout(spark, name)
    spark.sql(f"DROP TABLE {name}")
    write_clustered(frame(spark, SF_SMALL, "sat"), name, str(tmp_path / "val"), ["VAL"], 4, partition_cols=())
    upd = frame(spark, SF_SMALL, "upd")
    with pytest.raises(ValueError, match="no merge keys"):
        merge_into_clustered(spark, name, upd, specs(upd)["expire"])
    spark.sql(f"DROP TABLE {name}")


def test_without_partitions(spark, tmp_path):
    name = f"one_{uuid.uuid4().hex}"
    sat, upd = frame(spark, SF_SMALL, "sat"), frame(spark, SF_SMALL, "upd")
    write_clustered(sat, name, str(tmp_path / "one"), ["ORD_ID"], 4, partition_cols=())
    merge_into_clustered(spark, name, upd, specs(upd)["upsert"])
    assert rows(spark.table(name)) == rows(merge(sat, upd, specs(upd)["upsert"]))
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("clustered", [False, True])
def test_the_source_is_read_once(spark, tmp_path, stored, clustered):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    upd = frame(spark, SF_SMALL, "upd")
    n = upd.count()
    source = upd.mapInArrow(counted, upd.schema)
    spec = specs(upd)["expire"]
    if clustered:
        merge_into_clustered(spark, stored, source, spec)
    else:
        path = str(tmp_path / "table")
        write_partitioned(frame(spark, SF_SMALL, "sat"), path)
        merge_into_table(spark, path, source, spec, schema=frame(spark, SF_SMALL, "sat").schema)
    assert read.value == n
