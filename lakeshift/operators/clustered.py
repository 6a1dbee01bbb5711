"""Vault tables stored by key, so that a merge joins them without moving them.

A clustered table is a catalog table in buckets of its business key (and, inside each partition
folder, sorted by it). A merge whose keys include the bucket columns then joins every bucket with
the source rows of the same keys: the source is shuffled into the table's buckets, the table is
only read. What is written goes back into the same buckets, again without a shuffle.

Use as many buckets as the cluster runs tasks for the table, at least ``spark.sql.shuffle.partitions``:
with fewer, Spark may prefer to shuffle both sides for the sake of parallelism. A bucket is read by
one task, so a key that holds a large part of the table belongs into a table that is not clustered
(``merge_into_table``), where adaptive execution splits it.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators.merge_table import affected_partitions, stage_source, with_partition_value
from lakeshift.operators.scd2 import MergeSpec, as_stored, merge, resolve_names
from lakeshift.session import scratch_path
from lakeshift.sinks.publish import publish_partitions, remove_folder, same_store, swap_table
from lakeshift.sinks.writers import VAULT_PARTITION_COLUMNS


def write_clustered(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, *,
                    partition_cols: Sequence[str] = VAULT_PARTITION_COLUMNS, mode: str = "overwrite") -> str:
    """Store a frame as the clustered table ``name`` at ``path``. Rows are dealt out by the keys
    first, so that a bucket has one file per partition."""
    spread = df.repartition(buckets, *keys)
    _save(spread, name, path, keys, buckets, partition_cols, mode)
    return path


def _save(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, partition_cols: Sequence[str], mode: str) -> None:
    writer = df.write.format("parquet").mode(mode).option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
    (writer.partitionBy(*partition_cols) if partition_cols else writer).saveAsTable(name)


def layout(spark: SparkSession, name: str) -> dict:
    """Path, bucket columns, number of buckets and partition columns of a clustered table."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in rows:
        raise ValueError(f"{name} is not stored in buckets")
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isBucket]
    return {"path": rows["Location"], "keys": keys, "buckets": int(rows["Num Buckets"]), "partition_cols": partitions}


def _among(values: list, cols: Sequence[str]) -> Column:
    """Rows of these partitions, as literals that prune the scan when it is planned."""
    def one(row) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNull() if row[c] is None else F.col(c) == F.lit(row[c]) for c in cols])
    return reduce(lambda a, b: a | b, [one(r) for r in values], F.lit(False))


def clustered_plan(spark: SparkSession, name: str, source: DataFrame, spec: MergeSpec, *, null_keys: bool = True,
                   strategy: str = "auto") -> DataFrame:
    """The whole merged table as a frame."""
    return merge(spark.table(name), source, spec, strategy=strategy, clustered_by=layout(spark, name)["keys"], null_keys=null_keys)


def merge_into_clustered(spark: SparkSession, name: str, source: DataFrame, spec: MergeSpec, *,
                         strategy: str = "auto") -> dict:
    """Merge ``source`` into the clustered table ``name``; the merge keys must include its bucket
    columns. The source is read once; partitions that cannot change keep their files (their names
    reach the driver, which holds the table's list of partitions anyway). Returns the number of
    rewritten partitions and the stage folder, which is gone once the publish is complete."""
    at = layout(spark, name)
    target = spark.table(name)
    source, spec = resolve_names(target, source, spec)
    pcols, types = at["partition_cols"], {f.name: f.dataType for f in target.schema.fields}
    source = source.select(*[
        as_stored(F.col(c).cast(types[c]), types[c]).alias(c) if c in pcols else F.col(c) for c in source.columns])
    staged = stage_source(spark, source, spec, at["keys"])
    spec = with_partition_value(spec, staged)
    how = {"clustered_by": at["keys"], "null_keys": staged.null_keys}
    if pcols:
        parts = affected_partitions(target, staged.rows, spec, pcols, **how).collect()
        target = target.where(_among(parts, pcols))
    merged = merge(target, staged.rows, spec, strategy=strategy, **how).select(target.columns)
    stage, held = scratch_path(spark, "clustered"), f"lakeshift_stage_{uuid.uuid4().hex}"
    _save(merged, held, stage, at["keys"], at["buckets"], pcols, "overwrite")
    spark.sql(f"DROP TABLE {held}")  # the files stay; the folders are moved
    if not same_store(spark, stage, at["path"]):
        raise ValueError(f"set spark.checkpoint.dir to the store of {at['path']}: buckets are moved, not copied")
    if pcols:
        moved = publish_partitions(spark, stage, at["path"], pcols)
        spark.sql(f"MSCK REPAIR TABLE {name}")
    else:
        moved = 1
        swap_table(spark, stage, at["path"])
    spark.catalog.refreshTable(name)
    remove_folder(spark, staged.path)
    return {"partitions": moved, "staged": stage}
