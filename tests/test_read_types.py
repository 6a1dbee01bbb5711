"""The read-type decision table, option precedence and the load-date window."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import types as T

from lakeshift.functions.predicates import ReadSpec, apply_read_type, read_filter, resolve_read_spec, resolve_window

ROWS = [
    # REC_SRC_NM, LD_DT, LD_END_DT, id
    ("A", dt.datetime(2024, 1, 1), None, 1),
    ("A", dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 1), 2),
    ("B", dt.datetime(2024, 1, 10, 23, 59), None, 3),
    ("B", dt.datetime(2024, 2, 1), None, 4),
    ("C", dt.datetime(2023, 12, 31), None, 5),
    (None, dt.datetime(2024, 1, 3), None, 6),
    ("NA", dt.datetime(2024, 1, 3), None, 7),
]
SCHEMA = T.StructType([
    T.StructField("REC_SRC_NM", T.StringType()), T.StructField("LD_DT", T.TimestampNTZType()),
    T.StructField("LD_END_DT", T.TimestampNTZType()), T.StructField("id", T.IntegerType()),
])


@pytest.fixture(scope="module")
def sat(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df):
    return sorted(r.id for r in df.collect())


WINDOW = {"start_dt": "2024-01-01", "end_dt": "2024-01-10"}
CASES = [
    # (options, source_list, kind, export, expected ids)
    ({"read-type": "full", "source-filter": "A"}, [], "table", False, [1, 2, 3, 4, 5, 6, 7]),
    ({"read-type": "rec-source-filtered", "source-filter": "A"}, [], "table", False, [1, 2]),
    ({"read-type": "rec-source-filtered"}, [], "table", False, [1, 2, 3, 4, 5, 6, 7]),
    ({"read-type": "historical", "source-filter": "B"}, [], "table", False, [3, 4]),
    ({"read-type": "historical"}, [], "table", False, [1, 2, 3, 4, 5, 6, 7]),
    ({"read-type": "active-filtered", "historicalFlag": "true", "source-filter": "A"}, [], "table", False, [1, 2]),
    ({"read-type": "rec-source-filtered-active", "source-filter": "A"}, [], "table", False, [1]),
    ({"read-type": "rec-source-filtered-active"}, [], "table", False, [7]),
    ({"read-type": "rec-source-filtered-list"}, ["A", "C"], "table", False, [1, 2, 5]),
    ({"read-type": "rec-source-filtered-list"}, [], "table", False, []),
    ({"read-type": "rec-source-filtered-list-active"}, ["A", "B"], "table", False, [1, 3, 4]),
    ({"read-type": "active-filtered"}, [], "table", False, [1, 3, 4, 5, 6, 7]),
    ({"read-type": "active-filtered-with-loaddate", **WINDOW}, [], "table", False, [1, 3, 6, 7]),
    ({"read-type": "active-filtered-with-loaddate"}, [], "table", False, [1, 3, 4, 5, 6, 7]),
    ({"read-type": "loaddate-filtered", **WINDOW}, [], "table", False, [1, 2, 3, 6, 7]),
    ({"read-type": "loaddate-filtered"}, [], "table", False, [1, 2, 3, 4, 5, 6, 7]),
    ({"read-type": "rec-source-filtered-with-loaddate", "source-filter": "A", **WINDOW}, [], "table", False, [1, 2]),
    ({"read-type": "rec-source-filtered-with-loaddate", "source-filter": "B"}, [], "table", False, [3, 4]),
    ({"read-type": "rec-source-filtered-list-active-with-loaddate", **WINDOW}, ["A", "B"], "table", False, [1, 3]),
    ({"read-type": "rec-source-filtered-active-with-loaddate", "source-filter": "B", **WINDOW}, [], "table", False,
     [3]),
    ({"read-type": "active-filtered-with-loaddate", "source-filter": "A", **WINDOW}, [], "table", True, [1, 2]),
    ({"read-type": "active-filtered", "source-filter": "A"}, [], "table", True, [1, 2]),
    ({"read-type": "active-filtered"}, [], "table", True, [1, 3, 4, 5, 6, 7]),
    ({"read-type": "unknown-type"}, [], "table", False, [1, 2, 3, 4, 5, 6, 7]),
    # wide-column sources know no load-date types
    ({"read-type": "loaddate-filtered", **WINDOW}, [], "wide", False, [1, 2, 3, 4, 5, 6, 7]),
    ({"read-type": "rec-source-filtered-list-active"}, ["B"], "wide", False, [3, 4]),
]


@pytest.mark.parametrize("options,source_list,kind,export,expected", CASES)
def test_decision_table(sat, options, source_list, kind, export, expected):
    spec = resolve_read_spec(options, None, kind=kind, source_list=source_list, export=export)
    assert ids(apply_read_type(sat, spec)) == expected


def test_mart_read_types(spark):
    mart = spark.createDataFrame(
        [("X", None, 1), ("X", dt.datetime(2024, 1, 1), 2), ("Y", None, 3)],
        "RECORD_SOURCE_NAME string, RECORD_END_DATE timestamp_ntz, id int")
    def run(opts):
        return ids(apply_read_type(mart, resolve_read_spec(opts, None, kind="mart")))
    assert run({"read-type": "rec-source-filtered", "source-filter": "X"}) == [1, 2]
    assert run({"read-type": "rec-source-filtered-active", "source-filter": "X"}) == [1]
    assert run({"read-type": "active-filtered"}) == [1, 3]
    assert run({"read-type": "historical", "source-filter": "X"}) == [1, 2, 3]
    with pytest.raises(ValueError):
        resolve_read_spec({"read-type": "rec-source-filtered"}, None, kind="mart")


def test_precedence():
    obj = {"read-type": "full", "source-filter": "OBJ", "source-filter-col": "C1", "load-end-key": "E1"}
    sd = {"read-type": "active-filtered", "source-filter": "SD", "source-filter-col": "C2", "load-end-key": "E2"}
    spec = resolve_read_spec(obj, sd)
    assert (spec.read_type, spec.source, spec.source_col, spec.end_key) == ("active-filtered", "OBJ", "C1", "E1")
    spec = resolve_read_spec({}, sd)
    assert (spec.read_type, spec.source, spec.source_col, spec.end_key) == ("active-filtered", "SD", "C2", "E2")
    spec = resolve_read_spec({}, 0)
    assert (spec.read_type, spec.source, spec.source_col, spec.end_key) == ("full", None, "REC_SRC_NM", "LD_END_DT")
    mart = resolve_read_spec({}, None, kind="mart")
    assert (mart.source_col, mart.end_key) == ("RECORD_SOURCE_NAME", "RECORD_END_DATE")


def test_window_resolution():
    as_of = dt.date(2024, 3, 10)
    assert resolve_window({"num_of_days": "10", "start_dt": "2020-01-01", "end_dt": "2020-02-01"}, as_of) == (
        "2024-02-29", "2024-03-10")
    assert resolve_window({"num_of_days": "NA", "start_dt": "2020-01-01", "end_dt": "2020-02-01"}, as_of) == (
        "2020-01-01", "2020-02-01")
    assert resolve_window({"num_of_days": "", "start_dt": "2020-01-01", "end_dt": "NA"}, as_of) == (None, None)
    assert resolve_window({}, as_of) == (None, None)


def test_no_predicate_means_all_rows():
    assert read_filter(ReadSpec(read_type="full")) is None


def test_load_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "sat")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    spec = resolve_read_spec({"read-type": "rec-source-filtered-with-loaddate", "source-filter": "A", **WINDOW})
    df = apply_read_type(spark.read.parquet(path), spec)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    plan = out.getvalue()
    assert "EqualTo(REC_SRC_NM,A)" in plan
    assert "GreaterThanOrEqual(LD_DT" in plan
    assert ids(df) == [1, 2]
