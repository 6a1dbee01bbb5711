"""Read-type filter algebra (source equality, open rows, source list, load-date window).

One predicate builder is shared by every source (table by path, wide-column
connector, JDBC mart). The predicate is an ordinary Column, so Catalyst pushes
it into the scan (parquet ``PushedFilters``, JDBC ``WHERE``).
"""

from __future__ import annotations

import datetime as _dt
import logging
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Read-type names, defaults and sentinels that configurations use.
FULL = "full"
HISTORICAL = "historical"
REC_SOURCE_FILTERED = "rec-source-filtered"
REC_SOURCE_FILTERED_ACTIVE = "rec-source-filtered-active"
REC_SOURCE_FILTERED_LIST = "rec-source-filtered-list"
REC_SOURCE_FILTERED_LIST_ACTIVE = "rec-source-filtered-list-active"
ACTIVE_FILTERED = "active-filtered"
ACTIVE_FILTERED_WITH_LOADDATE = "active-filtered-with-loaddate"
LOADDATE_FILTERED = "loaddate-filtered"
REC_SOURCE_FILTERED_WITH_LOADDATE = "rec-source-filtered-with-loaddate"
REC_SOURCE_FILTERED_LIST_ACTIVE_WITH_LOADDATE = "rec-source-filtered-list-active-with-loaddate"
REC_SOURCE_FILTERED_ACTIVE_WITH_LOADDATE = "rec-source-filtered-active-with-loaddate"
NO_VALUE = "NA"
DEFAULT_SOURCE_COL = "REC_SRC_NM"
DEFAULT_END_KEY = "LD_END_DT"
DEFAULT_LOAD_DATE_COL = "LD_DT"
MART_SOURCE_COL = "RECORD_SOURCE_NAME"
MART_END_KEY = "RECORD_END_DATE"

# Which read types each kind of source understands; anything else reads all rows.
TABLE_TYPES = frozenset({
    REC_SOURCE_FILTERED, HISTORICAL, REC_SOURCE_FILTERED_ACTIVE, REC_SOURCE_FILTERED_LIST,
    REC_SOURCE_FILTERED_LIST_ACTIVE, ACTIVE_FILTERED, ACTIVE_FILTERED_WITH_LOADDATE, LOADDATE_FILTERED,
    REC_SOURCE_FILTERED_WITH_LOADDATE, REC_SOURCE_FILTERED_LIST_ACTIVE_WITH_LOADDATE,
    REC_SOURCE_FILTERED_ACTIVE_WITH_LOADDATE,
})
WIDE_COLUMN_TYPES = frozenset({
    REC_SOURCE_FILTERED, HISTORICAL, REC_SOURCE_FILTERED_ACTIVE, REC_SOURCE_FILTERED_LIST,
    REC_SOURCE_FILTERED_LIST_ACTIVE, ACTIVE_FILTERED,
})
MART_TYPES = frozenset({REC_SOURCE_FILTERED, REC_SOURCE_FILTERED_ACTIVE, ACTIVE_FILTERED})


@dataclass(frozen=True)
class ReadSpec:
    """Resolved read options. ``source`` None means "no source filter given"."""

    read_type: str = FULL
    source: str | None = None
    source_col: str = DEFAULT_SOURCE_COL
    end_key: str = DEFAULT_END_KEY
    source_list: tuple[str, ...] = ()
    start_dt: str | None = None
    end_dt: str | None = None
    export: bool = False
    load_date_col: str = DEFAULT_LOAD_DATE_COL
    kind: str = "table"  # "table" | "wide" | "mart"
    extra: Mapping[str, Any] = field(default_factory=dict)

    @property
    def window(self) -> tuple[str, str] | None:
        if self.start_dt is None or self.end_dt is None:
            return None
        return self.start_dt, self.end_dt


def _given(value: Any) -> bool:
    return value is not None and str(value) != "" and str(value) != NO_VALUE


def resolve_window(options: Mapping[str, Any], as_of: _dt.date | None = None) -> tuple[str | None, str | None]:
    """``num_of_days`` (as_of - n .. as_of) wins over ``start_dt``/``end_dt``; empty or "NA" is absent."""
    if _given(options.get("num_of_days")):
        today = as_of or _dt.date.today()
        n = int(options["num_of_days"])
        return (today - _dt.timedelta(days=n)).strftime("%Y-%m-%d"), today.strftime("%Y-%m-%d")
    if _given(options.get("start_dt")) and _given(options.get("end_dt")):
        return str(options["start_dt"]), str(options["end_dt"])
    return None, None


def resolve_read_spec(
    obj: Mapping[str, Any],
    source_dict: Mapping[str, Any] | None = None,
    *,
    kind: str = "table",
    source_list: Sequence[str] | None = None,
    as_of: _dt.date | None = None,
    export: bool = False,
) -> ReadSpec:
    """Build a ReadSpec from job options.

    Precedence: the read type prefers ``source_dict`` over ``obj``; source filter, filter column
    and end key prefer ``obj`` over ``source_dict``. ``historicalFlag == "true"`` forces the
    historical type for table and wide-column sources.
    """
    sd = source_dict if isinstance(source_dict, Mapping) else {}

    def pick_obj_first(name: str, default: Any) -> Any:
        if name in obj:
            return str(obj[name])
        if name in sd:
            return str(sd[name])
        return default

    if "read-type" in sd:
        read_type = str(sd["read-type"])
    elif "read-type" in obj:
        read_type = str(obj["read-type"])
    else:
        read_type = FULL
    if kind != "mart" and str(obj.get("historicalFlag", "")) == "true":
        read_type = HISTORICAL

    mart = kind == "mart"
    source = pick_obj_first("source-filter", None)
    if source == NO_VALUE:
        source = None
    source_col = pick_obj_first("source-filter-col", MART_SOURCE_COL if mart else DEFAULT_SOURCE_COL)
    end_key = pick_obj_first("load-end-key", MART_END_KEY if mart else DEFAULT_END_KEY)
    start_dt, end_dt = resolve_window(obj, as_of) if kind == "table" else (None, None)
    if mart and source is None and read_type in (REC_SOURCE_FILTERED, REC_SOURCE_FILTERED_ACTIVE):
        raise ValueError(f"read type {read_type!r} on a mart table needs a 'source-filter'")
    return ReadSpec(
        read_type=read_type,
        source=source,
        source_col=source_col,
        end_key=end_key,
        source_list=tuple(source_list or ()),
        start_dt=start_dt,
        end_dt=end_dt,
        export=export,
        kind=kind,
    )


def source_equals(spec: ReadSpec) -> Column:
    # Without a source the literal "NA" is compared, as configured jobs expect.
    return F.col(spec.source_col) == F.lit(spec.source if spec.source is not None else NO_VALUE)


def is_open(end_key: str) -> Column:
    return F.col(end_key).isNull()


def source_in_list(spec: ReadSpec) -> Column:
    # isin over an empty list is a constant false: zero rows.
    if not spec.source_list:
        return F.lit(False)
    return F.col(spec.source_col).isin(list(spec.source_list))


def load_date_between(spec: ReadSpec) -> Column | None:
    window = spec.window
    if window is None:
        return None
    day = F.col(spec.load_date_col).cast("date")
    return (day >= F.lit(window[0]).cast("date")) & (day <= F.lit(window[1]).cast("date"))


def _and(*parts: Column | None) -> Column | None:
    present = [p for p in parts if p is not None]
    if not present:
        return None
    return reduce(lambda a, b: a & b, present)


def read_filter(spec: ReadSpec) -> Column | None:
    """The predicate for a read type, or None for "all rows". Branches are taken top-down."""
    rt = spec.read_type
    allowed = {"table": TABLE_TYPES, "wide": WIDE_COLUMN_TYPES, "mart": MART_TYPES}[spec.kind]
    if spec.kind != "mart" and spec.source is not None and (rt in (REC_SOURCE_FILTERED, HISTORICAL) or spec.export):
        return source_equals(spec)
    if rt not in allowed:
        return None
    if rt == REC_SOURCE_FILTERED:
        if spec.kind == "mart":
            return source_equals(spec)
        log.warning("read type %s without a source filter reads every row", rt)
        return None
    if rt == HISTORICAL:
        return None
    if rt == REC_SOURCE_FILTERED_ACTIVE:
        return source_equals(spec) & is_open(spec.end_key)
    if rt == REC_SOURCE_FILTERED_LIST:
        return source_in_list(spec)
    if rt == REC_SOURCE_FILTERED_LIST_ACTIVE:
        return source_in_list(spec) & is_open(spec.end_key)
    if rt == ACTIVE_FILTERED:
        return is_open(spec.end_key)
    if rt == ACTIVE_FILTERED_WITH_LOADDATE:
        return _and(is_open(spec.end_key), load_date_between(spec))
    if rt == LOADDATE_FILTERED:
        return load_date_between(spec)
    if rt == REC_SOURCE_FILTERED_WITH_LOADDATE:
        return _and(source_equals(spec), load_date_between(spec))
    if rt == REC_SOURCE_FILTERED_LIST_ACTIVE_WITH_LOADDATE:
        return _and(source_in_list(spec), is_open(spec.end_key), load_date_between(spec))
    if rt == REC_SOURCE_FILTERED_ACTIVE_WITH_LOADDATE:
        return _and(source_equals(spec), is_open(spec.end_key), load_date_between(spec))
    return None


def apply_read_type(df, spec: ReadSpec):
    """Filter a (lazily scanned) DataFrame by its read type."""
    predicate = read_filter(spec)
    return df if predicate is None else df.where(predicate)
