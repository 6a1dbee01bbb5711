"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that separate words in the quality rules and are stripped from line keys.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A given table by path, cut to the columns named (all when none is)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def text_or_empty(column: str | Column) -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def materialised(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated here, once per row.

    A plain ``withColumn`` may be merged into the next projection, where a reference from inside
    a lambda would evaluate it again for each array element. A one-element ``inline`` is a
    boundary that projections are not merged across.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def join_splittable(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of rows with a side that was aggregated by the same keys (never null).

    Spark would join the aggregate where it lies, and there adaptive execution cannot split a key
    that holds very many rows of the left side. Compared null-safely, both sides are shuffled into
    the join, and a hot key's rows can be dealt to several tasks. The extra shuffle is of one row
    per key.
    """
    other = right.withColumnsRenamed({c: f"__other_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(other[f"__other_{c}"]) for c in on])
    return left.join(other, same).drop(*[f"__other_{c}" for c in on])


def add_text_columns(
    df: DataFrame,
    text: str,
    fields: Sequence[T.StructField],
    start: Callable[[], Callable[[list[str]], list[pa.Array]]],
    slice_chars: int = 4_000_000,
) -> DataFrame:
    """``df`` plus columns that Python computes from its text column, in Arrow batches.

    ``start`` runs once per task and returns the function that turns a list of texts (null read
    as empty) into one Arrow array per field. Batches are cut so that a call gets about
    ``slice_chars`` characters, or a single longer text. A field named like a column of ``df``
    raises ValueError. Rows are independent, so a lost task is simply run again.
    """
    clash = {f.name for f in fields} & set(df.columns)
    if clash:
        raise ValueError(f"result columns {sorted(clash)} are columns of the input")
    if text not in df.columns:
        raise ValueError(f"no column {text!r}")
    place, names = df.columns.index(text), [*df.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= slice_chars):
                    size += len(texts[hi])
                    hi += 1
                made = make(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, *made], names=names)
                lo = hi

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))
