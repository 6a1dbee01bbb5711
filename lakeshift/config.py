"""Entry points that take the load jobs' option dictionaries (``obj``, ``sourceDict``, ``ref``)
and call the typed operators. Only option mapping happens here; all data work is in the
operators."""

from __future__ import annotations

import datetime as _dt
from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from lakeshift.functions.predicates import resolve_read_spec
from lakeshift.operators.cycles import read_cycle
from lakeshift.operators.lookup import lookup
from lakeshift.operators.dedup import dedup_by_key
from lakeshift.operators.merge_table import merge_into_table
from lakeshift.operators.scd2 import (
    MergeSpec,
    close_and_insert_spec,
    expire_spec,
    historical_update_keys,
    merge,
    scd2_keys,
    update_columns_spec,
    upsert_spec,
)
from lakeshift.sinks.writers import VAULT_PARTITION_COLUMNS, write_clean, write_partitioned
from lakeshift.sources.jdbc import read_mart
from lakeshift.sources.paths import raw_path, split_table_name, table_path
from lakeshift.sources.raw import read_raw
from lakeshift.sources.tables import read_connector, read_reference, read_table


# Use-case names and the application-config sections they select.
USE_CASES = {
    "DataMart": ("DataMart", "Datamart", "datamart"),
    "DataVault": ("DataVault", "Data-Vault", "datavault"),
}


def overlay_use_case(app_conf: Mapping[str, Any], obj: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """Application settings with the section of the job's ``use-case`` laid over the top level.
    The caller loads the file (it is driver configuration, not data)."""
    merged = dict(app_conf)
    use_case = (obj or {}).get("use-case")
    for section, names in USE_CASES.items():
        if use_case in names and isinstance(app_conf.get(section), Mapping):
            merged.update(app_conf[section])
            break
    return merged


def rec_source_list(app_conf: Mapping[str, Any], obj: Mapping[str, Any] | None = None) -> list[str]:
    return list(overlay_use_case(app_conf, obj).get("rec-source-list", []))


def _source_filter(obj: Mapping[str, Any]) -> str | None:
    return str(obj["source-filter"]) if "source-filter" in obj else None


def _historical(obj: Mapping[str, Any]) -> bool:
    return str(obj.get("historicalFlag", "")) == "true"


# ---- reads ---------------------------------------------------------------------------

def read_vault_table(spark: SparkSession, root: str, table_name: str, obj: Mapping[str, Any],
                     source_dict: Mapping[str, Any] | None = None, *, export: bool = False,
                     source_list: Sequence[str] = (), as_of: _dt.date | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """Table by path ``<root>/<SCHEMA>/<table>`` (``adv_schema`` overrides the schema) with the
    configured read type; ``source_list`` is the application's ``rec-source-list``."""
    path = table_path(root, table_name, obj.get("adv_schema"))
    spec = resolve_read_spec(obj, source_dict, kind="table", source_list=source_list, as_of=as_of, export=export)
    return read_table(spark, path, spec, fmt=fmt)


def read_wide_table(spark: SparkSession, fmt: str, options: Mapping[str, str], obj: Mapping[str, Any],
                    source_dict: Mapping[str, Any] | None = None, *, export: bool = False,
                    source_list: Sequence[str] = ()) -> DataFrame:
    spec = resolve_read_spec(obj, source_dict, kind="wide", source_list=source_list, export=export)
    return read_connector(spark, fmt, options, spec)


def read_mart_table(spark: SparkSession, table_name: str, obj: Mapping[str, Any],
                    source_dict: Mapping[str, Any] | None = None, *, driver: str | None = None) -> DataFrame:
    spec = resolve_read_spec(obj, source_dict, kind="mart")
    return read_mart(spark, str(obj["sqlserver"]["connection-string"]), table_name, spec, driver=driver,
                     dm_schema=obj.get("dm_schema"))


def read_raw_file(spark: SparkSession, obj: Mapping[str, Any], source_dict: Mapping[str, Any]) -> DataFrame:
    path = raw_path(str(obj["azure"]["raw-base-path"]), str(obj["sourceName"]), str(obj["schemaName"]),
                    str(obj["tableName"]), str(obj["batchDate"]), str(source_dict["file-format"]),
                    str(obj.get("fileName", "") or ""))
    return read_raw(spark, path, str(source_dict["file-format"]), header=source_dict.get("header", True),
                    delimiter=source_dict.get("delimiter", ","),
                    infer_schema=source_dict.get("infer-schema-flag", "true"),
                    row_tag=source_dict.get("xmlRowTag"))


def read_cycle_table(df: DataFrame, obj: Mapping[str, Any], **columns: str) -> DataFrame:
    """Cycle read; ``read-type`` defaults to daily; ``full`` uses ``batchDate``."""
    return read_cycle(df, str(obj.get("read-type", "daily")), batch_date=obj.get("batchDate"), **columns)


def read_reference_table(spark: SparkSession, root: str, table_name: str, obj: Mapping[str, Any] | None = None, *,
                         is_active: int | str | None = 1, fmt: str = "parquet") -> DataFrame:
    """Reference table ``<root>/<SCHEMA>/<table>`` (``adv_schema`` overrides the schema), active
    rows by default; ``is_active`` None reads all of them."""
    return read_reference(spark, table_path(root, table_name, (obj or {}).get("adv_schema")), fmt, is_active)


def lookup_reference(spark: SparkSession, root: str, ref: Mapping[str, Any], obj: Mapping[str, Any] | None = None, *,
                     fmt: str = "parquet") -> DataFrame:
    """The lookup of ``ref`` over its own table (``ref-table-name``), all rows of it."""
    table = read_reference_table(spark, root, str(ref["ref-table-name"]), obj, is_active=None, fmt=fmt)
    return lookup_values(table, ref)


def lookup_values(df: DataFrame, ref: Mapping[str, Any]) -> DataFrame:
    const = ref.get("return-look-up-col-const")
    return lookup(df, dict(ref.get("ref-look-up-values", {})), str(ref["return-look-up-col"]),
                  pad_length=int(const["length"]) if const else None,
                  pad_char=str(const["rpad"]) if const else "0")


# ---- writes --------------------------------------------------------------------------

def write_clean_zone(df: DataFrame, obj: Mapping[str, Any]) -> str:
    return write_clean(df, str(obj["azure"]["clean-base-path"]), str(obj["sourceName"]), str(obj["schemaName"]),
                       str(obj["tableName"]), str(obj["batchDate"]), mode=str(obj.get("mode-of-write", "overwrite")),
                       fmt=str(obj.get("target-format", "parquet")))


def write_vault_table(df: DataFrame, root: str, obj: Mapping[str, Any]) -> str:
    cols = obj.get("partition_col", list(VAULT_PARTITION_COLUMNS))
    path = table_path(root, str(obj["target-table"]), obj.get("adv_schema"))
    return write_partitioned(df, path, cols, mode="append")


# ---- merges --------------------------------------------------------------------------
# Each merge has one mapping from its options to a source and a specification, used both for
# merging DataFrames (``*_batch``) and for merging into a stored table (``*_into_table``).

def _close_and_insert(source: DataFrame, obj: Mapping[str, Any], load_end_key: str, load_end_value: Any):
    return source, close_and_insert_spec(scd2_keys(obj["scd2"], source.columns), load_end_key, load_end_value,
                                         source_filter=_source_filter(obj))


def _upsert(source: DataFrame, obj: Mapping[str, Any], load_end_key: str, insert_columns: Sequence[str]):
    _, table = split_table_name(str(obj["target-table"]))
    scd2 = obj["scd2"]
    extra = [scd2["scd2-column"][k]["colName"] for k in sorted(scd2.get("scd2-column", {}))]
    return source, upsert_spec(source.columns, scd2_keys(scd2, source.columns), load_end_key, insert_columns,
                               scd2_columns=extra, historical_sat=_historical(obj) and table.startswith("sat"),
                               source_filter=_source_filter(obj))


def _update_historical(source: DataFrame, obj: Mapping[str, Any], columns: Sequence[str],
                       update_key_cols: Sequence[str] = (), *, batch_key_sources: Sequence[str] = ()):
    source_name = str(obj.get("sourceName", "")).lower()
    add_batch = _historical(obj) and source_name in {s.lower() for s in batch_key_sources}
    keys = historical_update_keys(obj.get("scd2"), source.columns, update_key_cols, add_batch_key=add_batch)
    if _historical(obj):
        source = dedup_by_key(source, keys)
    return source, update_columns_spec(keys, columns, source_filter=_source_filter(obj))


def _expire(source: DataFrame, obj: Mapping[str, Any], load_end_key: str, insert_columns: Sequence[str]):
    update_keys = obj["update-keys"]
    return source, expire_spec(list(update_keys["key-list"]), load_end_key, insert_columns,
                               cols_to_update=update_keys.get("cols-to-update"), source_filter=_source_filter(obj))


def close_and_insert_batch(target: DataFrame, source: DataFrame, obj: Mapping[str, Any], load_end_key: str,
                           load_end_value: Any, **kw) -> DataFrame:
    return merge(target, *_close_and_insert(source, obj, load_end_key, load_end_value), **kw)


def upsert_batch(target: DataFrame, source: DataFrame, obj: Mapping[str, Any], load_end_key: str,
                 insert_columns: Sequence[str], **kw) -> DataFrame:
    """Historical ``sat…`` targets (``historicalFlag == "true"``) match closed rows too and add
    REF_ID and SRC_EFF_DT to the keys; ``scd2-column`` entries (in key order) are updated."""
    return merge(target, *_upsert(source, obj, load_end_key, insert_columns), **kw)


def update_historical_batch(target: DataFrame, source: DataFrame, obj: Mapping[str, Any],
                            columns: Sequence[str], update_key_cols: Sequence[str] = (), *,
                            batch_key_sources: Sequence[str] = (), **kw) -> DataFrame:
    """``batch_key_sources``: source systems (``sourceName``) whose historical loads also key
    on BTCH_DT."""
    return merge(target, *_update_historical(source, obj, columns, update_key_cols,
                                             batch_key_sources=batch_key_sources), **kw)


def expire_batch(target: DataFrame, source: DataFrame, obj: Mapping[str, Any], load_end_key: str,
                 insert_columns: Sequence[str], **kw) -> DataFrame:
    return merge(target, *_expire(source, obj, load_end_key, insert_columns), **kw)


# ---- merges into stored tables -------------------------------------------------------

def _vault_target(root: str, obj: Mapping[str, Any]) -> tuple[str, list[str]]:
    path = table_path(root, str(obj["target-table"]), obj.get("adv_schema"))
    cols = obj.get("partition_col", list(VAULT_PARTITION_COLUMNS))
    return path, [cols] if isinstance(cols, str) else list(cols)


def _into_table(spark: SparkSession, root: str, obj: Mapping[str, Any], source: DataFrame, spec: MergeSpec, **kw) -> dict:
    path, cols = _vault_target(root, obj)
    return merge_into_table(spark, path, source, spec, partition_cols=cols, **kw)


def close_and_insert_into_table(spark: SparkSession, root: str, source: DataFrame, obj: Mapping[str, Any],
                                load_end_key: str, load_end_value: Any, **kw) -> dict:
    return _into_table(spark, root, obj, *_close_and_insert(source, obj, load_end_key, load_end_value), **kw)


def upsert_into_table(spark: SparkSession, root: str, source: DataFrame, obj: Mapping[str, Any],
                      load_end_key: str, insert_columns: Sequence[str], **kw) -> dict:
    return _into_table(spark, root, obj, *_upsert(source, obj, load_end_key, insert_columns), **kw)


def update_historical_into_table(spark: SparkSession, root: str, source: DataFrame, obj: Mapping[str, Any],
                                 columns: Sequence[str], update_key_cols: Sequence[str] = (), *,
                                 batch_key_sources: Sequence[str] = (), **kw) -> dict:
    return _into_table(spark, root, obj, *_update_historical(source, obj, columns, update_key_cols,
                                                             batch_key_sources=batch_key_sources), **kw)


def expire_into_table(spark: SparkSession, root: str, source: DataFrame, obj: Mapping[str, Any],
                      load_end_key: str, insert_columns: Sequence[str], **kw) -> dict:
    return _into_table(spark, root, obj, *_expire(source, obj, load_end_key, insert_columns), **kw)
