"""Raw landing files: delimited text and XML, with column names made parquet-safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeshift.functions.text import sanitize_columns

# Fixed value: the field that holds a tag's text when the tag also has attributes.
XML_VALUE_TAG = "ValueTagElement"


def read_raw(
    spark: SparkSession,
    path: str,
    file_format: str,
    *,
    header: bool | str = True,
    delimiter: str = ",",
    infer_schema: bool | str = True,
    row_tag: str | None = None,
    schema: StructType | str | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Read a raw CSV or XML file (parquet also accepted) and sanitise the column names.

    Prefer an explicit ``schema`` in production: inference costs an extra pass over the
    files and guesses narrower types (ints for longs, timestamps for timestamp_ntz).
    ``sampling_ratio`` limits that pass to a fraction of the rows.
    """
    fmt = str(file_format).lower()
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    if fmt == "csv":
        df = (reader.format("csv").option("header", str(header).lower())
              .option("delimiter", delimiter)
              .option("inferSchema", "false" if schema is not None else str(infer_schema).lower())
              .load(path))
    elif fmt == "xml":
        if not row_tag:
            raise ValueError("an XML read needs row_tag")
        df = reader.format("xml").option("rowTag", row_tag).option("valueTag", XML_VALUE_TAG).load(path)
    elif fmt == "parquet":
        df = reader.parquet(path)
    else:
        raise ValueError(f"unsupported raw format {file_format!r} (csv, xml, parquet)")
    return sanitize_columns(df)
