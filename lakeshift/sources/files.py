"""Folders and files of stored tables, without a list of all files in the driver."""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeshift.session import scratch_path

#: File systems that tasks can list by themselves.
TASK_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs")


def hadoop_path(spark: SparkSession, path: str):
    """The file system and the qualified path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def is_hidden(name: str) -> bool:
    """Names that Spark's readers skip."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def folder_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns by the names of the folders, along the first branch: one listing per
    level, no file is opened."""
    fs, at = hadoop_path(spark, path)
    names: list[str] = []
    while True:
        below = [s.getPath() for s in fs.listStatus(at) if s.isDirectory()]
        at = next((p for p in below if "=" in p.getName() and not is_hidden(p.getName())), None)
        if at is None:
            return names
        names.append(unquote(at.getName().split("=", 1)[0]))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a visible file at any depth."""
    fs, at = hadoop_path(spark, path)
    todo = [at]
    while todo:
        for s in fs.listStatus(todo.pop()):
            if not is_hidden(s.getPath().getName()):
                if not s.isDirectory():
                    return True
                todo.append(s.getPath())
    return False


def list_folder(uri: str) -> list[tuple[str, bool, int, int]]:
    """(name, is a folder, modification time in ms, length) of what a folder holds. Runs in tasks."""
    from pyarrow import fs as arrow_fs

    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        system, folder = arrow_fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        system, folder = arrow_fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{rest}")
    return [
        (i.base_name, i.type == arrow_fs.FileType.Directory, (i.mtime_ns or 0) // 1_000_000, i.size or 0)
        for i in system.get_file_info(arrow_fs.FileSelector(folder))]


LISTING = T.StructType([
    T.StructField("directory", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("ms", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("is_folder", T.BooleanType())])


def newest_in_folders(spark: SparkSession, root: str, *, glob: str | None = None, depth: int | None = None,
                      lister: Callable[[str], list[tuple[str, bool, int, int]]] = list_folder) -> DataFrame:
    """The newest file (by time, then path) of every folder under ``root``: directory, path,
    modificationTime, length. Folders are listed by tasks, one level of the tree at a time; a task
    keeps one file of each folder it lists. The folders of a level lie in the shared folder, and the
    driver asks only whether there are any. ``depth`` as for ``latest_files``; deeper folders are
    not listed. A single folder's files are in the memory of one task."""
    _, at = hadoop_path(spark, root)
    schema = to_arrow_schema(LISTING)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for folder in batch.column(0).to_pylist():
                newest = None
                for name, is_folder, ms, length in lister(folder):
                    path = f"{folder.rstrip('/')}/{name}"
                    if is_hidden(name):
                        continue
                    if is_folder:
                        rows.append((folder, path, None, None, True))
                    elif glob is None or fnmatch.fnmatchcase(name, glob):
                        newest = max(newest or (ms, path, length), (ms, path, length))
                if newest is not None:
                    rows.append((folder, newest[1], newest[0], newest[2], False))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    levels, level = [], 1
    folders = spark.createDataFrame([(str(at.toString()),)], "path string")
    while depth is None or level <= depth:
        path = scratch_path(spark, f"folders-{level}")
        folders.repartition("path").mapInArrow(listed, LISTING).write.parquet(path)
        found = spark.read.schema(LISTING).parquet(path)
        if depth is None or level == depth:
            levels.append(found.where("NOT is_folder").drop("is_folder"))
        folders = found.where("is_folder").select("path")
        level += 1
        if folders.isEmpty():
            break
    newest = spark.createDataFrame([], LISTING).drop("is_folder")
    for more in levels:
        newest = newest.unionByName(more)
    return newest.select("directory", "path", F.timestamp_millis("ms").alias("modificationTime"), "length")
