"""JDBC mart reads: routing, partition-column rule and range-partitioned scans.

Filters are applied with ``.where`` after ``load()``; Spark's JDBC source compiles
them into the remote ``WHERE`` (pushed filters), so only matching rows cross the
network, one connection per partition.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakeshift.functions.predicates import ReadSpec, apply_read_type

# Schemas read without partitioning, mart table prefixes, the default
# partition layout, and the tables whose partition column breaks the "<table>_id" rule.
UNPARTITIONED_SCHEMAS = ("dbo", "bau", "abc", "anlt", "rdm", "rheatvadb", "sys")
MART_PREFIXES = ("fact_", "dim_", "flf_")
DEFAULT_SCHEMA = "dbo"
READ_PARTITIONS = 20
LOWER_BOUND = 0
UPPER_BOUND = 10_000_000
PARTITION_COLUMN_EXCEPTIONS = {
    "dim_underwriting_company": "Dim_Underwriter_Company_Id",
    "dim_policy_analytic_output": "Dim_Policy_Analytic_Id",
    "fact_schedule_modifier_summary": "Fact_Schedule_Modifier_Monthly_Summary_Id",
    "ref_system_close_date": "Dim_System_Close_Date_Id",
}


@dataclass(frozen=True)
class MartRules:
    """What routing depends on; another site passes its own."""

    unpartitioned_schemas: tuple[str, ...] = UNPARTITIONED_SCHEMAS
    prefixes: tuple[str, ...] = MART_PREFIXES
    default_schema: str = DEFAULT_SCHEMA
    column_exceptions: Mapping[str, str] = field(default_factory=lambda: dict(PARTITION_COLUMN_EXCEPTIONS))


DEFAULT_RULES = MartRules()


def partition_column(table: str, rules: MartRules = DEFAULT_RULES) -> str:
    """``<table lower>_id`` unless the table is one of the named exceptions."""
    t = table.lower()
    return rules.column_exceptions.get(t, f"{t}_id")


@dataclass(frozen=True)
class MartRoute:
    dbtable: str
    schema: str
    table: str
    partitioned: bool


def route(table_name: str, dm_schema: str | None = None, rules: MartRules = DEFAULT_RULES) -> MartRoute:
    """Where a mart table is read from and whether it is read in partitions.

    Names not starting with a mart prefix are treated as in the default schema; unpartitioned
    schemas are read over one connection. Undotted names are accepted.
    """
    parts = str(table_name).split(".")
    table = parts[1].lower() if len(parts) > 1 else parts[0]
    if dm_schema:
        schema, dbtable = str(dm_schema), f"{dm_schema}.{table}"
    elif len(parts) > 1:
        schema, dbtable = parts[0], str(table_name)
    else:
        schema, dbtable = "", str(table_name)
    if not table.lower().startswith(tuple(rules.prefixes)):
        schema = rules.default_schema
    return MartRoute(dbtable=dbtable, schema=schema, table=table,
                     partitioned=schema.lower() not in rules.unpartitioned_schemas)


def jdbc_read_options(
    url: str,
    table_name: str,
    *,
    driver: str | None = None,
    dm_schema: str | None = None,
    num_partitions: int = READ_PARTITIONS,
    lower_bound: int = LOWER_BOUND,
    upper_bound: int = UPPER_BOUND,
    extra: Mapping[str, str] | None = None,
    rules: MartRules = DEFAULT_RULES,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``. Bounds set the stride only: rows outside
    them land in the first or last partition, none are dropped."""
    r = route(table_name, dm_schema, rules)
    opts = {"url": url, "dbtable": r.dbtable}
    if driver:
        opts["driver"] = driver
    if r.partitioned:
        opts.update({
            "partitionColumn": partition_column(r.table, rules),
            "numPartitions": str(num_partitions),
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
        })
    opts.update(dict(extra or {}))
    return opts


def read_mart(
    spark: SparkSession,
    url: str,
    table_name: str,
    spec: ReadSpec | None = None,
    *,
    bounds_from_data: bool = False,
    **kwargs,
) -> DataFrame:
    """Mart table over JDBC with a mart read type (``spec.kind == "mart"``).

    ``bounds_from_data`` replaces the fixed stride bounds by the partition column's min/max
    (one small remote query), so the partitions split the real id range evenly."""
    rules = kwargs.get("rules", DEFAULT_RULES)
    r = route(table_name, kwargs.get("dm_schema"), rules)
    if bounds_from_data and r.partitioned and "lower_bound" not in kwargs:
        lo, hi = bounds_from_table(spark, url, r.dbtable, partition_column(r.table, rules), kwargs.get("driver"))
        kwargs.update(lower_bound=lo, upper_bound=max(hi, lo + 1))
    df = spark.read.format("jdbc").options(**jdbc_read_options(url, table_name, **kwargs)).load()
    return df if spec is None else apply_read_type(df, spec)


def bounds_from_table(spark: SparkSession, url: str, dbtable: str, column: str,
                      driver: str | None = None) -> tuple[int, int]:
    """Stride bounds from the table itself: one remote ``min/max`` query returning one row."""
    opts = {"url": url, "query": f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {dbtable}"}
    if driver:
        opts["driver"] = driver
    row = spark.read.format("jdbc").options(**opts).load().first()
    lo, hi = (row[0], row[1]) if row else (None, None)
    return int(lo if lo is not None else LOWER_BOUND), int(hi if hi is not None else UPPER_BOUND)
