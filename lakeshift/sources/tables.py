"""Table scans with a read type: by path (parquet, or delta/any format whose jar is present),
through a generic connector (wide-column stores), and reference tables."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeshift.functions.predicates import ReadSpec, apply_read_type
from lakeshift.operators.lookup import active_rows
from lakeshift.sources.files import folder_columns

# File formats whose partition columns Spark derives from folder names.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def partition_columns(spark: SparkSession, path: str, fmt: str = "parquet",
                      options: Mapping[str, str] | None = None, df: DataFrame | None = None) -> list[str]:
    """The columns of a stored table that come from its folder names (none for formats that keep
    their own catalog), as the table spells them. ``df`` is the table as loaded, if it is."""
    if fmt not in FILE_FORMATS:
        return []
    options = dict(options or {})
    if any(c in path for c in "*?[{") or "basePath" in options:
        return _outside_files(spark, path, fmt, options)
    named = folder_columns(spark, path)
    if not named:
        return []
    columns = (spark.read.format(fmt).options(**options).load(path) if df is None else df).columns
    last = columns[-len(named):]
    if [c.lower() for c in last] == [c.lower() for c in named]:
        return last
    return _outside_files(spark, path, fmt, options)  # a file has such a column, too


def _outside_files(spark: SparkSession, path: str, fmt: str, options: dict) -> list[str]:
    inside = set(spark.read.format(fmt).options(**options).option("recursiveFileLookup", "true").load(path).columns)
    return [c for c in spark.read.format(fmt).options(**options).load(path).columns if c not in inside]


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """``load(path)`` whose partition columns are text unless a schema gives them another type.
    Left to itself, Spark guesses their types from the folder names: '01' would read as the
    number 1 and be written back as another folder. The table's files are listed once, and a
    second time only where a type was guessed."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        return reader.schema(schema).load(path)
    df = reader.load(path)
    guessed = [c for c in partition_columns(spark, path, fmt, options, df)
               if not isinstance(df.schema[c].dataType, T.StringType)]
    if not guessed:
        return df
    as_text = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in guessed else f.dataType, True) for f in df.schema.fields])
    return spark.read.format(fmt).options(**dict(options or {})).schema(as_text).load(path)


def read_table(spark: SparkSession, path: str, spec: ReadSpec | None = None, fmt: str = "parquet",
               options: Mapping[str, str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """``load(path).where(read-type predicate)``; the predicate reaches the scan as pushed filters
    (and partition pruning when it is on partition columns)."""
    df = load_table(spark, path, fmt, options, schema)
    return df if spec is None else apply_read_type(df, spec)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by name (``select *`` of it); filters and projections applied
    later still reach its scan."""
    return spark.table(name)


def read_connector(spark: SparkSession, fmt: str, options: Mapping[str, str], spec: ReadSpec | None = None
                   ) -> DataFrame:
    """Any connector (``format`` + options), e.g. a wide-column store; read types of kind "wide".
    A file format named here reads like a stored table: its partition columns are text."""
    options = dict(options)
    if fmt in FILE_FORMATS and "path" in options:
        df = load_table(spark, options.pop("path"), fmt, options)
    else:
        df = spark.read.format(fmt).options(**options).load()
    return df if spec is None else apply_read_type(df, spec)


def read_reference(spark: SparkSession, path: str, fmt: str = "parquet", is_active: int | str | None = None
                   ) -> DataFrame:
    """Reference table, all rows or only rows whose active flag equals ``str(is_active)``."""
    df = load_table(spark, path, fmt)
    return df if is_active is None else active_rows(df, is_active)
