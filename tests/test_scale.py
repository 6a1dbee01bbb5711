"""Plan-shape checks for the scale properties the operators rely on."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from lakeshift.operators.dedup import dedup_by_key
from lakeshift.operators.scd2 import MergeSpec, merge


def plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_target(spark, n=60_000):
    # a third of the rows share one key
    return (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id")).alias("K"),
        F.lit("F").alias("SRC"), F.lit(None).cast("timestamp_ntz").alias("END"),
        F.col("id").cast("double").alias("VAL")))


def test_broadcast_merge_does_not_shuffle_the_target(spark):
    t = hot_target(spark)
    s = spark.createDataFrame([(-7, "F", dt.datetime(2024, 1, 1), 0.0), (-5, "F", None, 1.0)],
                              "K long, SRC string, `END` timestamp_ntz, VAL double")
    spec = MergeSpec(keys=("K",), end_key="END", source_filter="F", source_col="SRC",
                     set_from_source={"END": "END"}, insert_columns=None)
    out = merge(t, s, spec, strategy="auto")
    plan = plan_text(out)
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    rows = out.collect()
    assert len(rows) == 60_001
    assert sum(1 for r in rows if r.END is not None) == 20_000


def test_hot_target_key_is_split_by_aqe(spark):
    t = hot_target(spark)
    s = spark.range(-7, 60_000, 7).select(F.col("id").alias("K"), F.lit("F").alias("SRC"),
                                         F.lit(None).cast("timestamp_ntz").alias("END"), F.lit(1.0).alias("VAL"))
    spec = MergeSpec(keys=("K",), end_key="END", source_filter="F", source_col="SRC",
                     set_from_source={"VAL": "VAL"}, insert_columns=())
    with conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }):
        out = merge(t, s, spec, strategy="shuffle")
        assert out.count() == 60_000
        out.collect()
        final = plan_text(out)
    join = [line for line in final.splitlines() if "SortMergeJoin(skew=true)" in line]
    assert join and "LeftOuter" in join[0]
    assert "AQEShuffleRead skewed" in final


def test_dedup_aggregates_partially_before_the_shuffle(spark):
    df = hot_target(spark)
    plan = plan_text(dedup_by_key(df, ["K"]))
    # partial aggregate below the exchange, final above it: a hot key costs one row per map task
    assert plan.count("SortAggregate") >= 2 or plan.count("HashAggregate") >= 2
    assert "Window" not in plan
    assert dedup_by_key(df, ["K"]).count() == 40_001


def test_slice_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    hot_target(spark, 1000).write.partitionBy("SRC").parquet(path)
    t = spark.read.parquet(path)
    s = spark.createDataFrame([(1, "F", None, 0.0)], "K long, SRC string, `END` timestamp_ntz, VAL double")
    spec = MergeSpec(keys=("K",), end_key="END", source_filter="F", source_col="SRC",
                     set_from_source={"VAL": "VAL"}, insert_columns=())
    plan = plan_text(merge(t, s, spec))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    # the touched slice prunes partitions and pushes the open-row test; the complement reads all
    assert any("PartitionFilters: [isnotnull(SRC" in line and "IsNull(END)" in line for line in scans)


def test_table_merge_reads_only_affected_partitions(spark, tmp_path):
    """The affected partitions prune the scan of the table at run time."""
    from lakeshift.operators.merge_table import in_partitions

    path, parts = str(tmp_path / "t"), str(tmp_path / "parts")
    spark.range(1000).select("id", (F.col("id") % 10).cast("string").alias("P")).write.partitionBy("P").parquet(path)
    spark.createDataFrame([("3",), ("7",), (None,)], "P string").write.parquet(parts)
    out = in_partitions(spark.read.schema("id long, P string").parquet(path), spark.read.parquet(parts), ["P"])
    assert "dynamicpruning" in plan_text(out).lower()
    assert sorted(r.P for r in out.select("P").distinct().collect()) == ["3", "7"]


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_null_keys_match_null_keys(spark, strategy):
    t = spark.createDataFrame([(None, "F", None, 1.0), (2, "F", None, 2.0)],
                              "K long, SRC string, `END` timestamp_ntz, VAL double")
    s = spark.createDataFrame([(None, "F", None, 9.0)], "K long, SRC string, `END` timestamp_ntz, VAL double")
    spec = MergeSpec(keys=("K",), end_key="END", set_from_source={"VAL": "VAL"}, insert_columns=None)
    got = sorted((r.K or 0, r.VAL) for r in merge(t, s, spec, strategy=strategy).collect())
    assert got == [(0, 9.0), (2, 2.0)]


def test_hot_source_key_is_split_in_the_insert_join(spark):
    # a third of the source shares one new key: all of those rows are inserts
    t = spark.range(0, 30_000).select(F.col("id").alias("K"), F.lit("F").alias("SRC"),
                                       F.lit(None).cast("timestamp_ntz").alias("END"), F.lit(0.0).alias("VAL"))
    s = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(-9)).otherwise(F.col("id") + 100_000).alias("K"),
                                    F.lit("F").alias("SRC"), F.lit(None).cast("timestamp_ntz").alias("END"),
                                    F.col("id").cast("double").alias("VAL"))
    spec = MergeSpec(keys=("K",), end_key="END", source_filter="F", source_col="SRC",
                     set_from_source={"VAL": "VAL"}, insert_columns=None)
    with conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }):
        out = merge(t, s, spec, strategy="shuffle")
        assert out.count() == 90_000
        out.collect()
        final = plan_text(out)
    joins = [line for line in final.splitlines() if "SortMergeJoin(skew=true)" in line]
    assert any("LeftAnti" in line for line in joins)


@pytest.mark.parametrize("residual", [False, True])
def test_salted_merge_gives_the_same_rows(spark, residual):
    from lakeshift.operators.scd2 import MergeSpec as Spec

    t = hot_target(spark, 3000).withColumn("B", (F.col("VAL") % 5).cast("long"))
    s = (spark.range(-9, 3000, 4).select(F.col("id").alias("K"), F.lit("F").alias("SRC"),
                                         F.lit(None).cast("timestamp_ntz").alias("END"), F.lit(1.0).alias("VAL"),
                                         F.lit(3).cast("long").alias("B")))
    spec = Spec(keys=("K",), end_key="END", source_filter="F", source_col="SRC",
                batch_col="B" if residual else None, set_from_source={"VAL": "VAL"}, insert_columns=None)
    plain = sorted(tuple(r) for r in merge(t, s, spec, strategy="shuffle").collect())
    salted_df = merge(t, s, spec, strategy="shuffle", salt_buckets=8)
    assert "__tsalt" in plan_text(salted_df)
    assert sorted(tuple(r) for r in salted_df.collect()) == plain
