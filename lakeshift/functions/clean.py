"""Values that do not have the type they are read as: null here, and counted for the caller."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def is_rejected(column: Column, kind: str) -> Column:
    """The value is there, but is no ``kind``."""
    return column.isNotNull() & column.try_cast(kind).isNull()


def rejected_values(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """One row: for each column the number of its values that are no ``kinds[column]``."""
    return df.agg(*[F.count_if(is_rejected(F.col(c), k)).alias(c) for c, k in kinds.items()])


def observe_rejected(df: DataFrame, kinds: Mapping[str, str], seen: Observation) -> DataFrame:
    """``df`` itself; whatever reads all of it also counts the rows that have a rejected value, and
    ``seen.get["rejected"]`` has the count then. Filters are not pushed past this point."""
    bad = F.lit(False)
    for c, k in kinds.items():
        bad = bad | is_rejected(F.col(c), k)
    return df.observe(seen, F.count_if(bad).alias("rejected"))
