"""Lookup text against Python's own ``str()``."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.functions.text import as_text

EDGES = [0.0, -0.0, 1.0, -1.5, 123.0, 0.001, 0.0001, 0.00015, 1.5e-5, 1e-5, 9999999.0, 1e7, -1e7,
         12345678.9, 123456789.125, 1e15, 9.999999999999998e15, 1e16, 1.5e16, -2.5e20, 1e22, 1e100,
         1.7976931348623157e308, 2.2250738585072014e-308, 0.1 + 0.2, math.nan, math.inf, -math.inf, None]


def texts(spark, values, data_type):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", data_type)]))
    return [r[0] for r in df.select(as_text(F.col("v"), data_type)).collect()]


def test_double_edges(spark):
    assert texts(spark, EDGES, T.DoubleType()) == [str(v) for v in EDGES]


def test_float_widened_like_python(spark):
    # A float column reaches Python as a double, so 0.1f prints all its digits.
    values = [0.1, 3.0, 1e8, None]
    got = texts(spark, values, T.FloatType())
    assert got == ["0.10000000149011612", "3.0", "100000000.0", "None"]


def test_double_matches_python_on_random_bits(spark):
    # Seeded random bit patterns cover every exponent; integers cover the 1e7..1e17 band.
    rng = np.random.default_rng(7)
    bits = rng.integers(0, 2**63, size=20000, dtype=np.int64) * rng.choice([1, -1], size=20000)
    values = [float(x) for x in bits.view(np.float64) if math.isfinite(x)]
    values += [float(x) for x in rng.integers(-10**17, 10**17, size=5000)]
    values += [float(x) * 10.0 ** int(e) for x, e in zip(rng.random(5000), rng.integers(-8, 24, size=5000))]
    got = texts(spark, values, T.DoubleType())
    bad = [(v, g) for v, g in zip(values, got) if g != str(v)]
    assert not bad, bad[:10]


def test_timestamp_text(spark):
    values = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 120000),
              dt.datetime(1999, 12, 31, 23, 59, 59, 1), None]
    assert texts(spark, values, T.TimestampNTZType()) == [str(v) for v in values]


def test_other_types_unchanged(spark):
    assert texts(spark, [1, None, -7], T.LongType()) == ["1", "None", "-7"]
    assert texts(spark, [True, False, None], T.BooleanType()) == ["True", "False", "None"]
    assert texts(spark, [dt.date(2024, 5, 6)], T.DateType()) == ["2024-05-06"]
