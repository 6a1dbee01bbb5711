"""Putting staged files in the place of stored ones, so that it can be interrupted and finished.

A writer first writes everything it changes to a stage folder. Only when that is complete are
folders moved, one after the other, by the file system's rename; no row is written twice. What has
been moved is gone from the stage, so after an interruption the same call moves the rest. The loops
below run over folders, not rows.
"""

from __future__ import annotations

import logging
from typing import Sequence

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def _paths(spark: SparkSession, *names: str):
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(n) for n in names]
    return [p.getFileSystem(conf) for p in paths], paths


def _rename(fs, old, new, advice: str) -> None:
    """A rename that must succeed; file systems report some failures by returning false."""
    if not fs.rename(old, new):
        raise OSError(f"{old} could not be moved to {new}; {advice}")


def same_store(spark: SparkSession, a: str, b: str) -> bool:
    """Whether a rename can lead from one path to the other."""
    (fs_a, fs_b), _ = _paths(spark, a, b)
    return str(fs_a.getUri()) == str(fs_b.getUri()) and fs_a.getScheme() != "viewfs"


def _folders(fs, path, depth: int) -> list:
    """Folders ``depth`` levels below a path that are named like partitions."""
    found = [path]
    for _ in range(depth):
        found = [s.getPath() for p in found for s in fs.listStatus(p)
                 if s.isDirectory() and "=" in s.getPath().getName() and not s.getPath().getName().startswith(".")]
    return found


def publish_partitions(spark: SparkSession, stage: str, table: str, partition_cols: Sequence[str]) -> int:
    """Move every partition folder of ``stage`` into ``table``, replacing the one that is there.
    Both must be in one store. Returns how many were moved; running it again finishes the rest."""
    (fs, _), (stage_path, table_path) = _paths(spark, stage, table)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    prefix = str(fs.makeQualified(stage_path).toString()).rstrip("/") + "/"
    moved = 0
    if fs.exists(stage_path):
        for folder in _folders(fs, stage_path, len(partition_cols)):
            to = Path(table_path, str(folder.toString())[len(prefix):])
            fs.mkdirs(to.getParent())
            # The old folder steps aside under a name that readers skip, so that it is there until
            # the new one is.
            aside = Path(to.getParent(), ".replaced." + to.getName())
            if fs.exists(to):
                if fs.exists(aside):
                    fs.delete(aside, True)
                _rename(fs, to, aside, "publish the stage again")
            _rename(fs, folder, to, "it is complete, publish the stage again")
            if fs.exists(aside):
                fs.delete(aside, True)
            moved += 1
        fs.delete(stage_path, True)
    spark.catalog.refreshByPath(table)
    return moved


def drop_folders(spark: SparkSession, table: str, names: Sequence[str]) -> None:
    """Delete partition folders of a table, given relative to it."""
    (fs,), (path,) = _paths(spark, table)
    for name in names:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path, name), True)
    spark.catalog.refreshByPath(table)


def partition_folders(spark: SparkSession, table: str, depth: int) -> list[str]:
    """Relative names of a table's partition folders."""
    (fs,), (path,) = _paths(spark, table)
    prefix = str(fs.makeQualified(path).toString()).rstrip("/") + "/"
    return [str(f.toString())[len(prefix):] for f in _folders(fs, path, depth)]


def swap_table(spark: SparkSession, stage: str, table: str) -> None:
    """Put the folder ``stage`` in the place of ``table``: the old one steps aside and is deleted
    when the new one is in place. Running it again finishes an interrupted swap."""
    (fs, _), (stage_path, table_path) = _paths(spark, stage, table)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    aside = Path(table.rstrip("/") + "__replaced")
    if fs.exists(stage_path):
        if fs.exists(table_path):
            if fs.exists(aside):  # a finished swap whose old folder was still there
                fs.delete(aside, True)
            _rename(fs, table_path, aside, "nothing was replaced yet, swap again")
        fs.mkdirs(table_path.getParent())
        _rename(fs, stage_path, table_path, "it is complete, swap again")
    if fs.exists(table_path) and fs.exists(aside):
        fs.delete(aside, True)
    spark.catalog.refreshByPath(table)


def remove_folder(spark: SparkSession, path: str) -> None:
    (fs,), (p,) = _paths(spark, path)
    fs.delete(p, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    (fs,), (p,) = _paths(spark, path)
    return bool(fs.exists(p))


COPY_BLOCK = 4 << 20


def concatenate(spark: SparkSession, folder: str, file: str, head: bytes = b"") -> None:
    """One file from ``head`` and the part files of a folder, in the order of their numbers. Bytes
    go from stream to stream; the file is written beside its place and then renamed into it."""
    (fs, parts_fs), (to, parts) = _paths(spark, file, folder)
    jvm = spark._jvm
    found = [s.getPath() for s in parts_fs.listStatus(parts) if s.getPath().getName().startswith("part-")]
    found.sort(key=lambda p: int(p.getName().split("-")[1]))
    beside = jvm.org.apache.hadoop.fs.Path(to.getParent(), "." + to.getName() + ".part")
    fs.mkdirs(to.getParent())
    out = fs.create(beside, True)
    try:
        out.write(head)
        for part in found:
            stream = parts_fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, COPY_BLOCK, False)
            finally:
                stream.close()
    finally:
        out.close()
    if fs.exists(to):
        fs.delete(to, True)
    _rename(fs, beside, to, "the file is complete there")
