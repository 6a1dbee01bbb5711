"""Merge a source batch into a partitioned table stored as files (parquet by default).

Only partitions that the merge can change are read whole and rewritten, once:

0. the source is read once: it is staged in the shared folder, and the pass that writes it also
   counts what the plan asks about it (its single partition value, rows with null keys). Every
   later step reads the staged rows.
1. affected partitions = partitions that hold a matching key (semi join of the table's keys with
   the source's, inside the merge slice) and partitions that source rows land in. They stay a
   DataFrame, written as a small table; there is no limit on their number.
2. the table is semi-joined with them on the partition columns (dynamic partition pruning: other
   partitions' files are not opened) and merged with ``merge``.
3. the merged partitions are written to a fresh folder under the shared checkpoint directory.
   When that is complete its folders are moved over the table's (see ``sinks.publish``); other
   partitions keep their files. ``publish_staged`` finishes a publish that was interrupted.

Folder names are text: partition columns are text unless a schema says otherwise, and an empty
text is stored, and therefore compared, as null.
"""

from __future__ import annotations

import dataclasses
import logging
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from lakeshift.operators.scd2 import MergeSpec, as_stored, clustered_join, find_column, merge, resolve_names
from lakeshift.session import scratch_path
from lakeshift.sinks.publish import publish_partitions, remove_folder, same_store
from lakeshift.sinks.writers import VAULT_PARTITION_COLUMNS
from lakeshift.sources.tables import load_table

log = logging.getLogger(__name__)


def _all_not_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def in_partitions(df: DataFrame, parts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose partition is among ``parts``. Partitions without a null join by plain
    equality, which Spark can turn into pruning of the scan; the others null-safely."""
    full = _all_not_null(cols)
    # True for every value that is not null; Spark prunes a scan by the other side of a join only
    # where that side has a comparison.
    compared = reduce(lambda a, b: a & b, [F.col(c).cast("string") >= F.lit("") for c in cols])
    plain = df.where(full).join(parts.where(compared), list(cols), "left_semi")
    named = parts.where(~full).select(*[F.col(c).alias("__p" + c) for c in cols])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("__p" + c)) for c in cols])
    return plain.unionByName(df.where(~full).join(named, same, "left_semi"))


def affected_partitions(target: DataFrame, source: DataFrame, spec: MergeSpec, cols: Sequence[str], *,
                        clustered_by: Sequence[str] = (), null_keys: bool = True) -> DataFrame:
    """Partitions with a target row that the merge can match, and those that source rows land in."""
    pred = spec.slice_predicate()
    touched = target if pred is None else target.where(pred)
    keys = list(dict.fromkeys(spec.keys))
    wanted = source.select(*[F.col(k).alias("__k" + k) for k in keys])
    held = touched.select(*dict.fromkeys([*cols, *keys]))
    if clustered_by:
        parts = clustered_join(held, wanted, keys, clustered_by, "left_semi", right_prefix="__k", null_keys=null_keys)
    else:
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("__k" + k)) for k in keys])
        parts = held.join(wanted, same, "left_semi")
    parts = parts.select(*cols)
    if spec.insert_columns is None or spec.insert_columns:
        types = {f.name: f.dataType for f in target.schema.fields}
        given = set(source.columns) if spec.insert_columns is None else set(spec.insert_columns) & set(source.columns)
        parts = parts.unionByName(source.select(*[
            (F.col(c) if c in given else F.lit(None)).cast(types[c]).alias(c) for c in cols]))
    return parts.distinct()


@dataclasses.dataclass
class StagedSource:
    """A batch written once: its rows, and what the pass over it found."""

    rows: DataFrame
    path: str
    partition_value: str | None
    null_keys: bool


def stage_source(spark: SparkSession, source: DataFrame, spec: MergeSpec, by: Sequence[str] = ()) -> StagedSource:
    """Write the batch to the shared folder by one pass over it. The pass also finds its partition
    value (when it has exactly one that is not null) and whether a column of ``by`` has a null."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in by], F.lit(False))).alias("nulls")]
    column = find_column(source, spec.partition_col)
    if column is not None:
        value = as_stored(F.col(f"`{column}`"), source.schema[column].dataType)
        counts += [F.count(value).alias("nn"), F.min(value).alias("lo"), F.max(value).alias("hi")]
    # files cannot hold a column of nulls without a type
    typed = source.select(*[
        (F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, NullType) else F.col(f"`{f.name}`")).alias(f.name)
        for f in source.schema.fields])
    path = scratch_path(spark, "merge-source")
    typed.observe(seen, *counts).write.parquet(path)
    found, single = seen.get, None
    if column is not None and found["n"] and found["nn"] == found["n"] and found["lo"] == found["hi"]:
        single = str(found["lo"])
    return StagedSource(spark.read.schema(typed.schema).parquet(path), path, single, found["nulls"] > 0)


def with_partition_value(spec: MergeSpec, staged: StagedSource) -> MergeSpec:
    """The spec with its partition literal resolved, so that every step sees the same slice."""
    value = spec.partition_value
    if value is None and spec.discover_partition and spec.source_filter is not None:
        value = staged.partition_value
    return dataclasses.replace(spec, partition_value=value, discover_partition=False)


def merge_into_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    spec: MergeSpec,
    *,
    partition_cols: Sequence[str] = VAULT_PARTITION_COLUMNS,
    fmt: str = "parquet",
    schema: StructType | None = None,
    strategy: str = "auto",
    salt_buckets: int = 0,
) -> dict:
    """Merge ``source`` into the table at ``path``; returns the number of rewritten partitions and
    the stage folder, which is gone once the publish is complete."""
    target = load_table(spark, path, fmt, schema=schema)
    tcols = target.columns
    source, spec = resolve_names(target, source, spec)
    pcols = [next((c for c in tcols if c.upper() == p.upper()), p) for p in partition_cols]
    missing = [c for c in pcols if c not in tcols]
    if missing:
        raise ValueError(f"partition columns {missing} are not columns of the table")
    types = {f.name: f.dataType for f in target.schema.fields}
    source = source.select(*[
        as_stored(F.col(c).cast(types[c]), types[c]).alias(c) if c in pcols else F.col(c) for c in source.columns])

    staged = stage_source(spark, source, spec)
    source, spec = staged.rows, with_partition_value(spec, staged)

    found = scratch_path(spark, "partitions")
    affected_partitions(target, source, spec, pcols).write.parquet(found)
    parts = spark.read.parquet(found)
    merged = merge(in_partitions(target, parts, pcols), source, spec, strategy=strategy, salt_buckets=salt_buckets)
    stage = scratch_path(spark, "merge")
    log.info("merge into %s is staged at %s", path, stage)
    merged.select(tcols).hint("rebalance", *pcols).write.format(fmt).partitionBy(*pcols).save(stage)
    moved = publish_staged(spark, stage, path, merged.schema, pcols, fmt=fmt)
    remove_folder(spark, found)
    remove_folder(spark, staged.path)
    return {"partitions": moved, "staged": stage}


def publish_staged(spark: SparkSession, stage: str, path: str, schema: StructType, partition_cols: Sequence[str],
                   *, fmt: str = "parquet") -> int:
    """Put the staged partitions in the place of the table's; call it again with the same stage
    after an interruption. Folders are moved where stage and table are in one store; between
    stores the rows are copied with dynamic partition overwrite. Returns the partitions moved."""
    pcols = list(partition_cols)
    if same_store(spark, stage, path):
        return publish_partitions(spark, stage, path, pcols)
    staged = spark.read.format(fmt).schema(schema).load(stage).select(schema.fieldNames())
    n = staged.select(*pcols).distinct().count()
    (staged.write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*pcols).save(path))
    remove_folder(spark, stage)
    return n
