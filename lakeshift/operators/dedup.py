"""Repeatable de-duplication and distinct values, as aggregations (no windows).

``dropDuplicates(keys)`` keeps an arbitrary row, which can change when a task is
retried after an executor loss. ``dedup_by_key`` keeps the smallest row (columns
compared left to right, nulls first): a partial aggregate, so a key that holds a third
of the rows is reduced map-side before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind.fields)


def orderable(name: str, kind: T.DataType) -> Column:
    """The column itself, or for types that hold maps (which Spark cannot compare) an image that
    can be: the sorted entries, or JSON where maps are nested."""
    column = F.col(f"`{name}`")
    if isinstance(kind, T.MapType) and not _has_map(kind.valueType):
        return F.array_sort(F.map_entries(column))
    return F.to_json(F.struct(column)) if _has_map(kind) else column


def dedup_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(dict.fromkeys(keys))
    cols = df.columns
    others = [c for c in cols if c not in keys]
    if not others:
        return df.select(*keys).distinct().select(cols)
    row = F.struct(*others)
    if any(_has_map(df.schema[c].dataType) for c in others):
        smallest = F.min_by(row, F.struct(*[orderable(c, df.schema[c].dataType).alias(c) for c in others]))
    else:
        smallest = F.min(row)
    best = df.groupBy(*keys).agg(smallest.alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col("__best." + c).alias(c) for c in cols])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column, as a DataFrame (collecting is the caller's choice)."""
    return df.select(column).distinct()
