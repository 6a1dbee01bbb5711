"""Reference-table lookups: case-insensitive filters, one returned column as text.

The result stays a DataFrame (one string column). Use it in a semi join or an
``isin`` built from a bounded collect; nothing is pulled to the driver here.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.text import as_text, pad_left

# Fixed value: the active-flag column of reference tables.
ACTIVE_FLAG = "IS_ACTV_FLG"


def active_rows(df: DataFrame, is_active: int | str = 1) -> DataFrame:
    """Rows whose flag equals ``str(is_active)``."""
    return df.where(F.col(ACTIVE_FLAG) == F.lit(str(is_active)))


def lookup(
    df: DataFrame,
    filters: Mapping[str, object],
    return_col: str,
    *,
    pad_length: int | None = None,
    pad_char: str = "0",
) -> DataFrame:
    """Values of ``return_col`` where every ``lower(col) == lower(value)``; text like
    Python ``str()`` (null -> "None"); optionally stripped and left-padded."""
    if filters:
        df = df.where(reduce(lambda a, b: a & b, [
            F.lower(F.col(c)) == F.lit(str(v).lower()) for c, v in filters.items()
        ]))
    value = as_text(F.col(return_col), df.schema[return_col].dataType)
    if pad_length is not None:
        value = pad_left(value, int(pad_length), str(pad_char))
    return df.select(value.alias(return_col))
