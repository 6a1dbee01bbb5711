"""Vault-shaped frames derived from the shared test tables.

The same SQL text runs in Spark and in DuckDB (the oracle). Base tables are
written as ``{orders}`` etc.: Spark reads them as ``parquet.`<dir>/orders.parquet```,
DuckDB uses its registered views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# sat: satellite, one third of the rows closed, one in fifty with a null business key, one in
# four with an expiry date. upd: source system F's batch, chosen by load date: rows loaded from
# 2000 on come again with new values (they match open versions, or only closed ones), the 1998
# loads come under new keys, and one row with a null key, which matches a stored null key.
FRAMES: dict[str, str] = {
    "sat": """
SELECT CASE WHEN o_orderkey % 50 <> 7 THEN o_orderkey END AS ORD_ID, o_custkey AS REF_ID, o_orderstatus AS REC_SRC_NM,
       CAST(o_custkey % 4 AS STRING) AS PART_COL, o_orderdate AS LD_DT, o_orderdate AS BTCH_DT,
       o_orderdate AS SRC_EFF_DT, CASE WHEN o_orderkey % 4 = 1 THEN o_orderdate + INTERVAL 10 DAY END AS SRC_EXPRN_DT,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 30 DAY END AS LD_END_DT,
       o_totalprice AS VAL
FROM {orders}""",
    "upd": """
SELECT ORD_ID, REF_ID, REC_SRC_NM, PART_COL, LD_DT, BTCH_DT, SRC_EFF_DT, SRC_EXPRN_DT,
       LD_DT + INTERVAL 400 DAY AS LD_END_DT, VAL + 1 AS VAL
FROM sat WHERE REC_SRC_NM = 'F' AND year(LD_DT) >= 2000 AND ORD_ID IS NOT NULL
UNION ALL
SELECT ORD_ID + 10000000, REF_ID, REC_SRC_NM, PART_COL, LD_DT, BTCH_DT, SRC_EFF_DT, SRC_EXPRN_DT,
       SRC_EXPRN_DT AS LD_END_DT, VAL
FROM sat WHERE REC_SRC_NM = 'F' AND year(LD_DT) = 1998 AND ORD_ID IS NOT NULL
UNION ALL
SELECT CAST(NULL AS BIGINT), max_by(REF_ID, VAL), 'F', max_by(PART_COL, VAL), max_by(LD_DT, VAL), max_by(BTCH_DT, VAL),
       max_by(SRC_EFF_DT, VAL), max_by(SRC_EXPRN_DT, VAL), max_by(LD_DT, VAL) + INTERVAL 400 DAY, max(VAL) + 1
FROM sat WHERE REC_SRC_NM = 'F' AND ORD_ID IS NULL AND LD_END_DT IS NULL""",
    "cycle": """
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) - 1900 AS INT) AS CYC_YEAR,
       CAST(month(l_shipdate) AS INT) AS CYC_MONTH, l_extendedprice, l_shipdate
FROM {lineitem}""",
    # All of lineitem with its months moved on so that the latest one is a January.
    "cycle_jan": """
SELECT l_orderkey, l_linenumber,
       CAST(floor((year(l_shipdate) * 12 + month(l_shipdate) - 1 + k) / 12.0) AS INT) - 1900 AS CYC_YEAR,
       CAST((month(l_shipdate) - 1 + k) % 12 + 1 AS INT) AS CYC_MONTH, l_extendedprice, l_shipdate
FROM {lineitem}, (SELECT CAST((13 - month(max(l_shipdate))) % 12 AS INT) AS k FROM {lineitem}) shift""",
    # The satellite with the partition values that folder names can spoil: null, the empty text
    # (stored as null) and zero-padded digits; the batch has them too.
    "odd_sat": """
SELECT ORD_ID, REF_ID, REC_SRC_NM, CASE PART_COL WHEN '1' THEN '01' WHEN '2' THEN '' WHEN '3' THEN NULL ELSE '1' END AS PART_COL,
       LD_DT, BTCH_DT, SRC_EFF_DT, SRC_EXPRN_DT, LD_END_DT, VAL
FROM sat""",
    "odd_upd": """
SELECT ORD_ID, REF_ID, REC_SRC_NM, CASE PART_COL WHEN '1' THEN '01' WHEN '2' THEN '' WHEN '3' THEN NULL ELSE '1' END AS PART_COL,
       LD_DT, BTCH_DT, SRC_EFF_DT, SRC_EXPRN_DT, LD_END_DT, VAL
FROM upd""",
    "runs": """
SELECT event_type AS dq_table_name, CAST(day(ts) AS BIGINT) AS run_id, event_id, value
FROM {events}""",
    # Retention configuration over the error tables found in the data; it holds an inactive
    # entry, a null keep count, a keep count equal to the number of runs, a null name, and a
    # second and third entry for a table (one that deletes more, one that finds nothing left).
    "cfg": """
SELECT CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
                            WHEN 'error' THEN 4 WHEN 'signup' THEN 5 ELSE 7 END AS BIGINT) AS dq_err_tables_master_id,
       event_type AS dq_table_name,
       CAST(CASE event_type WHEN 'click' THEN 7 WHEN 'view' THEN 29 WHEN 'purchase' THEN 30
                            WHEN 'error' THEN 7 END AS INT) AS no_of_exec_to_keep,
       CASE WHEN event_type = 'error' THEN 'N' ELSE 'Y' END AS actv_inactv_ind
FROM (SELECT DISTINCT event_type FROM {events}) e
UNION ALL
SELECT CAST(6 AS BIGINT), CAST(NULL AS STRING), CAST(5 AS INT), 'Y'
UNION ALL
SELECT CAST(8 AS BIGINT), 'click', CAST(3 AS INT), 'Y'
UNION ALL
SELECT CAST(9 AS BIGINT), 'click', CAST(5 AS INT), 'Y'""",
    "ref": """
SELECT CAST(c_custkey AS STRING) AS VAL, c_mktsegment AS SEG, CAST(c_nationkey AS STRING) AS NATION,
       CASE WHEN c_custkey % 5 = 0 THEN '0' ELSE '1' END AS IS_ACTV_FLG
FROM {customer}""",
}

# Frames built on other frames (the rest read only base tables).
DEPENDS_ON = {"upd": ["sat"], "odd_sat": ["sat"], "odd_upd": ["upd"]}


def _deps(name: str, seen: list[str]) -> list[str]:
    for ref in DEPENDS_ON.get(name, []):
        if ref not in seen:
            _deps(ref, seen)
    if name not in seen:
        seen.append(name)
    return seen


def with_clause(names: list[str], engine: str, sf_dir: str | None = None) -> str:
    """``WITH a AS (...), b AS (...)`` for the named frames and their dependencies."""
    order: list[str] = []
    for n in names:
        _deps(n, order)
    if engine == "spark":
        tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in BASE_TABLES}
    else:
        tables = {t: t for t in BASE_TABLES}
    ctes = [f"{n} AS ({FRAMES[n].format(**tables).strip()})" for n in order]
    return "WITH " + ",\n".join(ctes)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(f"{with_clause([name], 'spark', sf_dir)}\nSELECT * FROM {name}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def oracle(names: list[str], body: str) -> str:
    """DuckDB SQL: the frames as CTEs followed by ``body``."""
    return f"{with_clause(names, 'duckdb')}\n{body}"
