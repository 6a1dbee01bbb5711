"""Accounting-cycle reads: all cycles, one cycle year, or the newest month and the one before.

Years and months are compared as integers (text comparison would rank "9" above "12").
For a frame, the newest (year, month) comes from one scalar subquery, ``max(struct(year, month))``:
it is part of the same plan (no driver round trip) and is a global aggregate with
map-side partial results. For a stored table it comes from folder names and Parquet footers
(``newest_cycle``), so no row is read to find it, and the read that follows is pruned by literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.functions.clean import observe_rejected
from lakeshift.sinks.publish import partition_folders
from lakeshift.sources.files import has_files
from lakeshift.sources.tables import load_table, partition_columns

# The cycle column names of the statistics table and the year offset.
YEAR_COL = "D36Y_NFU_ACTG_YEAR"
MONTH_COL = "D36M_NFU_ACTG_MONTH"
YEAR_OFFSET = 1900
KINDS = ("historical", "full", "daily")


def cycle_year(batch_date: str) -> int:
    """Cycle year of a ``YYYY...`` batch date: calendar year minus 1900."""
    return int(str(batch_date)[:4]) - YEAR_OFFSET


def read_cycle(
    df: DataFrame,
    kind: str = "daily",
    *,
    batch_date: str | None = None,
    year_col: str = YEAR_COL,
    month_col: str = MONTH_COL,
    rejected: Observation | None = None,
) -> DataFrame:
    """Rows of the cycles asked for. A year or month that is no number is read as null, so its row
    is in no cycle; ``rejected``, when given, has the number of such rows under "rejected" after
    the frame was read (filters then stop above the count, so leave it out on large tables)."""
    year = F.col(year_col).try_cast("int")
    month = F.col(month_col).try_cast("int")
    if rejected is not None:
        df = observe_rejected(df, {year_col: "int", month_col: "int"}, rejected)
    if kind == "historical":
        return df
    if kind == "full":
        if batch_date is None:
            raise ValueError("a full cycle read needs batch_date")
        return df.where(year == F.lit(cycle_year(batch_date)))
    if kind == "daily":
        newest = df.select(F.max(F.struct(year.alias("y"), month.alias("m"))).alias("ym")).scalar()
        y, m = newest.getField("y"), newest.getField("m")
        # In January only month 1 is read, never the December before.
        return df.where((year == y) & ((month == m) | ((m != F.lit(1)) & (month == m - F.lit(1)))))
    raise ValueError(f"unknown cycle read type {kind!r}; expected one of {KINDS}")


def _newest(year: Column, month: Column, y: int, m: int) -> Column:
    """Rows of the newest cycle and the month before it; in January only that month."""
    return (year == F.lit(y)) & (month.isin(m) if m == 1 else month.isin(m, m - 1))


WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _number(text: str) -> int | None:
    """A folder's value as ``try_cast`` to int reads it."""
    text = text.strip()
    return int(text) if text.lstrip("+-").isdigit() and text.isascii() else None


def _statistics(spark: SparkSession, path: str, footers: bool = True) -> DataFrame:
    """The table as Spark's newer Parquet source reads it, which answers max() from footers. Its
    settings are those of a session of its own; the caller's session is left alone."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", str(footers).lower())
    return own.read.parquet(path)


def newest_in_files(df: DataFrame, column: str) -> DataFrame:
    """The largest number in a column, as a frame of one row. Whole numbers are aggregated by the
    scan (footers only, with at most partition filters below); text has to be read."""
    whole = isinstance(df.schema[column].dataType, WHOLE)
    return df.agg(F.max(F.col(column) if whole else F.col(column).try_cast("int")).alias("newest"))


def _largest(spark: SparkSession, path: str, column: str, where: Column | None = None) -> int | None:
    """The largest number in a column of the table's files, from footers. A file whose footer has
    no maximum (a column of nulls only, statistics switched off) has the column read instead."""
    for footers in (True, False):
        files = _statistics(spark, path, footers)
        try:
            return newest_in_files(files if where is None else files.where(where), column).first()["newest"]
        except Exception as exc:
            if not footers or "No min/max found" not in str(exc):
                raise
    return None


def newest_cycle(spark: SparkSession, path: str, *, year_col: str = YEAR_COL, month_col: str = MONTH_COL) -> tuple[int, int] | None:
    """(year, month) of the newest cycle of a stored Parquet table, None for none.

    - partition columns: from the names of folders that hold a file; nothing is opened
    - year in a folder name, month in the files: footers of that year's files
    - both in the files: the year from footers, then the month of that year; its scan skips row
      groups by their footers, so it reads the row groups that hold the newest year
    - a value that is no number, and null, is in no cycle
    """
    cols = partition_columns(spark, path)
    if year_col not in cols:
        year = _largest(spark, path, year_col)
        month = None if year is None else _largest(spark, path, month_col, F.col(year_col).try_cast("int") == year)
        return None if month is None else (year, month)
    found: dict[tuple[int, int | None], list[str]] = {}
    for folder in partition_folders(spark, path, len(cols)):
        values = dict(part.split("=", 1) for part in folder.split("/"))
        year, month = _number(values[year_col]), _number(values[month_col]) if month_col in cols else None
        if year is not None and (month is not None or month_col not in cols):
            found.setdefault((year, month), []).append(folder)
    for year, month in sorted(found, key=lambda k: (k[0], k[1] or 0), reverse=True):
        folders = [f for f in found[year, month] if has_files(spark, f"{path.rstrip('/')}/{f}")]
        if folders and month is None:
            month = _largest(spark, path, month_col, F.col(year_col).try_cast("int") == year)
        if folders and month is not None:
            return year, month
    return None


def read_stored_cycle(
    spark: SparkSession,
    path: str,
    kind: str = "daily",
    *,
    batch_date: str | None = None,
    year_col: str = YEAR_COL,
    month_col: str = MONTH_COL,
    schema: T.StructType | None = None,
) -> DataFrame:
    """``read_cycle`` of a stored Parquet table: the newest cycle is looked up without reading rows,
    and the rows are read by literals that prune folders and row groups."""
    df = load_table(spark, path, schema=schema)
    if kind != "daily":
        return read_cycle(df, kind, batch_date=batch_date, year_col=year_col, month_col=month_col)
    newest = newest_cycle(spark, path, year_col=year_col, month_col=month_col)
    if newest is None:
        return df.where(F.lit(False))
    return df.where(_newest(F.col(year_col).try_cast("int"), F.col(month_col).try_cast("int"), *newest))
