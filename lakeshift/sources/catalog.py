"""Schema listing and newest-file discovery, as DataFrames."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.sources.files import TASK_SCHEMES, hadoop_path, newest_in_folders


def _escape(text: str) -> str:
    """``text`` as a literal inside a Java regular expression."""
    return "\\Q" + text + "\\E"


CATALOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("nullable", T.BooleanType()),
])


def schema_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each table: name, 1-based position, Spark type, nullability.
    Reads only schemas (parquet footers), never rows."""
    rows = [
        (name, i + 1, f.name, f.dataType.simpleString(), bool(f.nullable))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def _listed_by_driver(spark: SparkSession, root: str, glob: str | None, depth: int | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root).select("path", "modificationTime", "length")
    if depth is not None:
        below = F.regexp_replace("path", r"^.*?" + _escape(root.rstrip("/").split(":", 1)[-1]) + "/", "")
        files = files.where(F.size(F.split(below, "/")) == F.lit(depth))
    return (
        files.withColumn("directory", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
        .groupBy("directory")
        .agg(F.max(F.struct("modificationTime", "path", "length")).alias("f"))
        .select("directory", F.col("f.path").alias("path"),
                F.col("f.modificationTime").alias("modificationTime"), F.col("f.length").alias("length")))


def latest_files(spark: SparkSession, root: str, pattern: str = "", name_segment: int | None = None,
                 glob: str | None = None, depth: int | None = None) -> DataFrame:
    """Newest file (by modification time, then path) in every directory under ``root``,
    kept when its path contains ``pattern``; ``table_name`` is path segment ``name_segment``
    (1-based, counted on ``/``) when given. ``depth`` keeps only files that many levels below
    ``root`` (2 = files directly inside each sub-directory).

    Tasks list the folders, level by level, and fold each to its newest file
    (``files.newest_in_folders``), so the driver's memory does not grow with the files. Only on
    file systems that tasks cannot list by themselves, and for globs with braces, Spark's own file
    source lists (``binaryFile`` with ``content`` pruned); the driver then holds the list of all
    files, a few million at most, so call it per sub-tree there.
    """
    fs, _ = hadoop_path(spark, root)
    if fs.getScheme() in TASK_SCHEMES and "{" not in (glob or ""):
        newest = newest_in_folders(spark, root, glob=glob, depth=depth)
    else:
        newest = _listed_by_driver(spark, root, glob, depth)
    if pattern:
        newest = newest.where(F.col("path").contains(pattern))
    if name_segment is not None:
        newest = newest.withColumn("table_name", F.element_at(F.split("path", "/"), name_segment))
    return newest
