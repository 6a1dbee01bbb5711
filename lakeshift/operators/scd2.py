"""SCD2 merges (close-and-insert, upsert, historical update, expire) as DataFrame plans.

``merge(target, source, spec)`` returns the whole new target. It works on any
table format: no row-level MERGE support is needed.

Plan (T = target, S = source, K = null-safe keys, b = optional batch column for
the ``T.b <= S.b`` residual):

* slice    T by the target-side literals (source system, partition value) and the
           open-row predicate: ``touched`` can match, ``rest`` passes through untouched
           (no shuffle; literals on partition columns prune files).
* summary  S grouped by K: a match counter and the columns the merge sets, nothing else
           (for close-and-insert only the counter). Partial aggregation runs before the
           shuffle, so a hot key costs one row per map task.
* update   ``touched LEFT JOIN summary``. The target is never aggregated, and the
           summary has one row per key, so a hot target key is split by AQE's skew
           join (left side of a left outer join). Spark picks the join from its own sizes:
           a small summary is broadcast and the target is then not shuffled at all. A target
           row matched by two source rows raises an error.
* insert   ``S LEFT ANTI JOIN target-key summary``; the target keys are pre-aggregated
           (distinct, or ``min(b)`` with the residual), so the anti join sees one row
           per key on its build side.
* result   ``rest UNION ALL update UNION ALL insert`` in the target's column order.
"""

from __future__ import annotations

import dataclasses
import logging
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Column names the vault tables use.
SOURCE_COL = "REC_SRC_NM"
PARTITION_COL = "PART_COL"
LOAD_DATE = "LD_DT"
BATCH_DATE = "BTCH_DT"
REF_ID = "REF_ID"
SRC_EFF_DT = "SRC_EFF_DT"
SRC_EXPRN_DT = "SRC_EXPRN_DT"
RANK_COLUMN = "rankColumn"
NEVER_UPDATED = (SOURCE_COL, PARTITION_COL)

_S = "__s_"  # prefix of source columns inside the join


@dataclass(frozen=True)
class MergeSpec:
    """What to match and what to write.

    ``set_from_source`` maps target column -> source column for matched rows;
    ``set_literal`` maps target column -> constant. ``insert_columns`` None means
    "insert every target column found in the source"; an empty tuple means no insert.
    """

    keys: tuple[str, ...]
    end_key: str = "LD_END_DT"
    open_only: bool = True
    source_filter: str | None = None
    partition_value: str | None = None
    source_col: str = SOURCE_COL
    partition_col: str = PARTITION_COL
    batch_col: str | None = None
    set_from_source: Mapping[str, str] = field(default_factory=dict)
    set_literal: Mapping[str, Any] = field(default_factory=dict)
    insert_columns: tuple[str, ...] | None = None
    check_single_match: bool = True
    discover_partition: bool = False

    def slice_predicate(self, partition_value: str | None = None) -> Column | None:
        """Target rows that can match. A partition literal (given, or discovered from the
        source) only narrows the slice together with a source filter."""
        parts: list[Column] = []
        value = self.partition_value if partition_value is None else partition_value
        if self.source_filter is not None:
            parts.append(F.col(self.source_col) == F.lit(self.source_filter))
            if value is not None:
                parts.append(F.col(self.partition_col) == F.lit(value))
        if self.open_only:
            parts.append(F.col(self.end_key).isNull())
        return reduce(lambda a, b: a & b, parts) if parts else None


def unique(names: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(names))


def find_column(df: DataFrame, name: str) -> str | None:
    """Case-insensitive column lookup."""
    for c in df.columns:
        if c.upper() == name.upper():
            return c
    return None


def _by_upper(columns: Iterable[str], what: str) -> dict[str, str]:
    """Upper-case name -> name; two names that differ only in case are an error."""
    found: dict[str, str] = {}
    for c in columns:
        if found.setdefault(c.upper(), c) != c:
            raise ValueError(f"{what} columns {found[c.upper()]!r} and {c!r} differ only in case")
    return found


def resolve_names(target: DataFrame, source: DataFrame, spec: MergeSpec) -> tuple[DataFrame, MergeSpec]:
    """The source with the target's spelling of every shared column, and the spec spelled like
    both. Names compare without case; a name that neither side has raises ValueError."""
    tmap, smap = _by_upper(target.columns, "target"), _by_upper(source.columns, "source")
    source = source.select(*[F.col(f"`{c}`").alias(tmap.get(c.upper(), c)) for c in source.columns])

    def spelled(name: str) -> str:
        return tmap.get(name.upper()) or smap.get(name.upper()) or name

    return source, dataclasses.replace(
        spec, keys=tuple(spelled(k) for k in spec.keys), end_key=spelled(spec.end_key),
        source_col=spelled(spec.source_col), partition_col=spelled(spec.partition_col),
        batch_col=None if spec.batch_col is None else spelled(spec.batch_col),
        set_from_source={spelled(t): spelled(c) for t, c in spec.set_from_source.items()},
        set_literal={spelled(t): v for t, v in spec.set_literal.items()},
        insert_columns=None if spec.insert_columns is None else tuple(spelled(c) for c in spec.insert_columns))


# Fixed widths (bytes) of the fixed-size types, as Spark's row format stores them.
FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def row_bytes(schema: T.StructType) -> Column:
    """Payload size of a row: fixed widths, plus octet lengths of text, binary and (as JSON)
    nested values."""
    widths: list[Column] = []
    for f in schema.fields:
        dt = f.dataType
        if isinstance(dt, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
            widths.append(F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0)))
        else:
            widths.append(F.lit(FIXED_WIDTH.get(type(dt), 16)))
    return reduce(lambda a, b: a + b, widths, F.lit(16)).cast("long")


def discover_partition_value(source: DataFrame, name: str = PARTITION_COL) -> str | None:
    """The source's partition value when it has exactly one, non-null; else None. One row with
    three aggregates of one column reaches the driver; files store the empty text as null."""
    c = find_column(source, name)
    if c is None:
        return None
    value = as_stored(F.col(f"`{c}`"), source.schema[c].dataType)
    row = source.agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("nn"), F.min(value).alias("lo"),
                     F.max(value).alias("hi")).first()
    return str(row["lo"]) if row["n"] and row["nn"] == row["n"] and row["lo"] == row["hi"] else None


def as_stored(column: Column, kind: T.DataType) -> Column:
    """A partition value as folders keep it: the empty text comes back as null."""
    return F.nullif(column, F.lit("")) if isinstance(kind, T.StringType) else column


def measured_bytes(df: DataFrame) -> int:
    """Payload bytes of a frame, by one aggregate over it."""
    return int(df.agg(F.sum(row_bytes(df.schema)).alias("b")).first()["b"] or 0)


_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
          "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    """Spark size strings: "10485760", "10485760b", "10m", "64MB", "-1"."""
    raw = str(text).strip().lower()
    digits = raw.lstrip("-0123456789")
    number = raw[: len(raw) - len(digits)]
    return int(number) * _UNITS.get(digits.strip() or "b", 1)


def broadcast_limit(spark) -> int:
    """The session's broadcast threshold in bytes (<= 0 disables broadcasting)."""
    try:
        return parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))
    except ValueError:
        return 10 << 20


def _key_condition(keys: Sequence[str], left_prefix: str = "", right_prefix: str = _S) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(left_prefix + k).eqNullSafe(F.col(right_prefix + k)) for k in keys],
    )


def _same(a: Column, b: Column) -> Column:
    """Null-safe equality that is no join key to the planner, only a condition."""
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(a == b)


def clustered_join(left: DataFrame, right: DataFrame, keys: Sequence[str], by: Sequence[str], how: str, *,
                   left_prefix: str = "", right_prefix: str = _S, extra: Column | None = None,
                   null_keys: bool = True) -> DataFrame:
    """``left`` joined to ``right`` on null-safe ``keys``, of which ``by`` are those that one side is
    stored by. Rows without a null there join by plain equality of just these columns, so the stored
    side is joined where it lies. Rows with one join null-safely; ``null_keys=False`` says that the
    source has none, so the target's cannot match and are not joined at all."""
    left_has = reduce(lambda a, b: a & b, [F.col(left_prefix + k).isNotNull() for k in by])
    right_has = reduce(lambda a, b: a & b, [F.col(right_prefix + k).isNotNull() for k in by])
    on = [F.col(left_prefix + k) == F.col(right_prefix + k) for k in by]
    on += [_same(F.col(left_prefix + k), F.col(right_prefix + k)) for k in keys if k not in by]
    more = [] if extra is None else [extra]
    joined = left.where(left_has).join(right.where(right_has), reduce(lambda a, b: a & b, on + more), how)
    others = left.where(~left_has)
    if null_keys:
        cond = reduce(lambda a, b: a & b, [_key_condition(keys, left_prefix, right_prefix), *more])
        others = others.join(right.where(~right_has), cond, how)
    elif how == "left_semi":
        return joined
    elif how == "left":
        others = others.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields])
    return joined.unionByName(others)


def _salted(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """A deterministic salt per row (a hash of the whole row, never random, so a retried task
    reproduces it)."""
    return df.withColumn(name, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(buckets)))


def _replicated(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """Every row once per salt value (used on the one-row-per-key side only)."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<bigint>")))


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec, *, strategy: str = "auto",
          salt_buckets: int = 0, clustered_by: Sequence[str] = (), null_keys: bool = True) -> DataFrame:
    """Return the merged target. ``strategy``: "auto" (Spark picks each join from its sizes),
    "shuffle" (sort-merge joins whatever the thresholds) or "broadcast" (the source is measured
    by an extra pass and broadcast if it fits the session's threshold, else as "auto").

    Names are compared without case. ``insert_columns`` None inserts every target column, and
    each must be in the source. Which of several source rows of a key sets values is only
    asked when ``check_single_match`` is off; it is then any of them.

    ``salt_buckets`` > 1 (shuffle joins only) spreads every key over that many tasks without
    relying on AQE: target rows, and source rows in the insert join, get a deterministic salt,
    and the one-row-per-key sides are replicated per salt value. By default AQE's skew join
    splits hot keys at run time instead.

    ``clustered_by``: keys by which the target is stored in buckets; its rows are then joined where
    they lie (see ``clustered_join``, also for ``null_keys``). A bucket is one task, so AQE cannot
    split a hot key there."""
    if not spec.keys:
        raise ValueError("a merge needs at least one key column")
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if clustered_by and (salt_buckets > 1 or strategy == "broadcast"):
        raise ValueError("a clustered target is joined by its buckets: no salt, no broadcast strategy")
    source, spec = resolve_names(target, source, spec)
    outside = [c for c in clustered_by if c not in spec.keys]
    if outside:
        raise ValueError(f"the target is clustered by {outside}, which are no merge keys")
    tcols = target.columns
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    keys = unique(spec.keys)
    for k in keys:
        if k not in ttypes or k not in source.columns:
            raise ValueError(f"merge key {k!r} must exist in target and source")
    b = spec.batch_col
    if spec.insert_columns is None:
        insert_cols = list(tcols)
    else:
        insert_cols = unique(spec.insert_columns)
        unknown = [c for c in insert_cols if c not in ttypes]
        if unknown:
            raise ValueError(f"insert columns are not target columns: {unknown}")
    missing = [c for c in insert_cols if c not in source.columns]
    if missing:
        raise ValueError(f"insert columns missing from source: {missing}")
    unknown = [c for c in spec.set_literal if c not in ttypes]
    if unknown:
        raise ValueError(f"cannot set columns the target lacks: {unknown}")
    for tc, sc in spec.set_from_source.items():
        if tc not in ttypes or sc not in source.columns:
            raise ValueError(f"cannot set target {tc!r} from source {sc!r}")
    needed = unique([*keys, *([b] if b else []), *spec.set_from_source.values(), *insert_cols])
    s = source.select([F.col(c).alias(_S + c) for c in needed])
    set_cols = [c for c in unique(spec.set_from_source.values()) if c not in keys and c != b]

    use_broadcast = False
    if strategy == "broadcast":
        limit = broadcast_limit(source.sparkSession)
        use_broadcast = limit > 0 and measured_bytes(s) <= limit
    part_value = None
    if spec.discover_partition and spec.source_filter is not None and spec.partition_value is None:
        part_value = discover_partition_value(source, spec.partition_col)

    def build(df: DataFrame) -> DataFrame:
        """The one-row-per-key side of a join, as the strategy wants it joined."""
        if use_broadcast:
            return F.broadcast(df)  # no larger than the measured source
        return df.hint("merge") if strategy == "shuffle" else df

    pred = spec.slice_predicate(part_value)
    if pred is None:
        touched, rest = target, None
    else:
        # The bare conjuncts reach the scan (partition filters, pushed filters); a filter drops
        # null outcomes, so only the complement needs the null-safe form.
        touched, rest = target.where(pred), target.where(~F.coalesce(pred, F.lit(False)))

    # --- source summary: one row per key -------------------------------------------
    skeys = [_S + k for k in keys]
    if b is None:
        summary = s.groupBy(*skeys).agg(
            F.count(F.lit(1)).alias("__n"), *[F.any_value(_S + c).alias(_S + c) for c in set_cols])
        source_keys = summary.select(*skeys)  # one row per key (Catalyst prunes it to a distinct)
        match_cond = _key_condition(keys)
        matched = F.col("__n").isNotNull()
        too_many = F.col("__n") > 1
    else:
        # Rows whose batch value is null never satisfy T.b <= S.b. Two rows with the largest
        # batch value both match whatever one of them matches, so which one sets is not asked.
        sb = _S + b
        nn = s.where(F.col(sb).isNotNull())
        top = nn.groupBy(*skeys).agg(
            F.count(F.lit(1)).alias("__n"), F.max(sb).alias("__top"),
            *[F.max_by(_S + c, sb).alias(_S + c) for c in set_cols]).withColumnRenamed("__top", sb)
        source_keys = top.select(*skeys)  # keys with a batch value; null batches never match
        # Second largest batch value (with multiplicity), only for keys with 2+ rows.
        multi = top.where(F.col("__n") > 1).select(*[F.col(k).alias("__m" + k) for k in skeys],
                                                     F.col(sb).alias("__m1"))
        second = (
            nn.join(build(multi), reduce(lambda x, y: x & y,
                                  [F.col(k).eqNullSafe(F.col("__m" + k)) for k in skeys]))
            .groupBy(*skeys)
            .agg(F.count_if(F.col(sb) == F.col("__m1")).alias("__c1"),
                 F.max(F.when(F.col(sb) < F.col("__m1"), F.col(sb))).alias("__lt"),
                 F.max("__m1").alias("__m1"))
            .select(*[F.col(k).alias("__m" + k) for k in skeys],
                    F.when(F.col("__c1") >= 2, F.col("__m1")).otherwise(F.col("__lt")).alias("__m2"))
        )
        summary = top.join(
            build(second), reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col("__m" + k)) for k in skeys]), "left"
        ).drop(*["__m" + k for k in skeys])
        match_cond = _key_condition(keys) & (F.col(b) <= F.col(sb))
        matched = F.col("__n").isNotNull()
        too_many = F.col("__m2").isNotNull() & (F.col(b) <= F.col("__m2"))

    # --- matched target rows ---------------------------------------------------------
    # Keys compare with <=>, which Spark plans on (coalesce(k), isnull(k)); the summary,
    # grouped by k, is therefore shuffled once more into the join. That is deliberate: AQE
    # splits a skewed join partition only when both join inputs are plain shuffle stages,
    # and a hot target key must stay splittable. The re-shuffled side has one row per key.
    salt = salt_buckets > 1 and not use_broadcast
    if salt:
        touched_side = _salted(touched, "__tsalt", salt_buckets)
        right = build(_replicated(summary, "__ssalt", salt_buckets))
        joined = touched_side.join(right, match_cond & (F.col("__tsalt") == F.col("__ssalt")), "left")
    elif clustered_by:
        joined = clustered_join(touched, build(summary), keys, clustered_by, "left", null_keys=null_keys,
                                extra=None if b is None else F.col(b) <= F.col(_S + b))
    else:
        joined = touched.join(build(summary), match_cond, "left")
    if spec.check_single_match:
        joined = joined.where(
            F.when(matched & too_many,
                   F.raise_error(F.lit("merge: a target row is matched by more than one source row")))
            .otherwise(F.lit(True))
        )
    out = []
    for c in tcols:
        if c in spec.set_from_source:
            new = F.col(_S + spec.set_from_source[c]).cast(ttypes[c])
            out.append(F.when(matched, new).otherwise(F.col(c)).alias(c))
        elif c in spec.set_literal:
            new = F.lit(spec.set_literal[c]).cast(ttypes[c])
            out.append(F.when(matched, new).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    updated = joined.select(out)

    parts = [updated] if rest is None else [rest.select(tcols), updated]

    # --- unmatched source rows -------------------------------------------------------
    if insert_cols:
        tk_src = touched
        if use_broadcast:
            # Only target keys that occur in the measured source can block an insert.
            tk_src = touched.join(F.broadcast(source_keys), _key_condition(keys), "left_semi")
        if b is None:
            tk = tk_src.select(*[F.col(k).alias("__t" + k) for k in keys]).distinct()
            anti_cond = _key_condition(keys, "__t", _S)
        else:
            tk = (tk_src.where(F.col(b).isNotNull()).groupBy(*keys).agg(F.min(b).alias("__tmin"))
                  .select(*[F.col(k).alias("__t" + k) for k in keys], "__tmin"))
            anti_cond = _key_condition(keys, "__t", _S) & (F.col("__tmin") <= F.col(_S + b))
        if salt:
            inserts = _salted(s, "__isalt", salt_buckets).join(
                build(_replicated(tk, "__ksalt", salt_buckets)), anti_cond & (F.col("__isalt") == F.col("__ksalt")),
                "left_anti").drop("__isalt")
        elif clustered_by:
            inserts = clustered_join(s, build(tk), keys, clustered_by, "left_anti", left_prefix=_S, right_prefix="__t",
                                     null_keys=null_keys, extra=None if b is None else F.col("__tmin") <= F.col(_S + b))
        else:
            inserts = s.join(build(tk), anti_cond, "left_anti")
        chosen = set(insert_cols)
        inserts = inserts.select([
            (F.col(_S + c).cast(ttypes[c]) if c in chosen else F.lit(None).cast(ttypes[c])).alias(c)
            for c in tcols
        ])
        parts.append(inserts)
    return reduce(lambda x, y: x.unionByName(y), parts)


# --------------------------------------------------------------------------------------
# Key rules and the four merge flavours, with the options the load jobs pass.
# --------------------------------------------------------------------------------------

def scd2_keys(scd2: Mapping[str, Any], source_columns: Sequence[str]) -> list[str]:
    """Keys for close-and-insert and upsert: configured keys, REF_ID when the source has it
    (only with ``target-table-keys``), then LD_DT and BTCH_DT."""
    if "keys-to-identify-unique" in scd2:
        return unique([*scd2["keys-to-identify-unique"]["key-list"], LOAD_DATE, BATCH_DATE])
    base = list(scd2["target-table-keys"])
    if REF_ID in source_columns:
        return unique([*base, REF_ID, LOAD_DATE, BATCH_DATE])
    return unique([*base, LOAD_DATE, BATCH_DATE])


def historical_update_keys(
    scd2: Mapping[str, Any] | None,
    source_columns: Sequence[str],
    update_key_cols: Sequence[str] = (),
    *,
    add_batch_key: bool = False,
) -> list[str]:
    """Keys for the historical column update: given keys, or configured keys + LD_DT; then
    REF_ID and SRC_EFF_DT when the source has them; BTCH_DT when asked for."""
    if update_key_cols:
        keys = list(update_key_cols)
    elif scd2 and "keys-to-identify-unique" in scd2:
        keys = [*scd2["keys-to-identify-unique"]["key-list"], LOAD_DATE]
    else:
        keys = [*(scd2 or {})["target-table-keys"], LOAD_DATE]
    if REF_ID in source_columns:
        keys.append(REF_ID)
    if SRC_EFF_DT in source_columns:
        keys.append(SRC_EFF_DT)
    if add_batch_key and BATCH_DATE in source_columns:
        keys.append(BATCH_DATE)
    return unique(keys)


def close_and_insert_spec(keys: Sequence[str], end_key: str, end_value: Any, *,
                          source_filter: str | None = None, discover_partition: bool = True) -> MergeSpec:
    """Open target rows matched on ``keys`` get ``end_key := end_value``; unmatched source
    rows are inserted with all their columns."""
    return MergeSpec(keys=tuple(unique(keys)), end_key=end_key, open_only=True, source_filter=source_filter,
                     discover_partition=discover_partition, set_literal={end_key: end_value}, insert_columns=None)


def upsert_spec(source_columns: Sequence[str], keys: Sequence[str], end_key: str, insert_columns: Sequence[str],
                *, scd2_columns: Sequence[str] = (), historical_sat: bool = False,
                source_filter: str | None = None, discover_partition: bool = True) -> MergeSpec:
    """Matched open rows take the source's end key (and ``scd2_columns``); unmatched source
    rows insert ``insert_columns`` (``rankColumn`` is never inserted; other columns stay null).

    ``historical_sat``: keys also REF_ID and SRC_EFF_DT (when present) and closed rows match too.
    """
    key_list = list(keys)
    if historical_sat:
        key_list += [c for c in (REF_ID, SRC_EFF_DT) if c in source_columns]
    sets = {end_key: end_key}
    for c in scd2_columns:
        sets[c] = c
    return MergeSpec(
        keys=tuple(unique(key_list)), end_key=end_key, open_only=not historical_sat,
        source_filter=source_filter, discover_partition=discover_partition, set_from_source=sets,
        insert_columns=tuple(c for c in insert_columns if c != RANK_COLUMN),
    )


def update_columns_spec(keys: Sequence[str], columns: Sequence[str], *, source_filter: str | None = None,
                        discover_partition: bool = True) -> MergeSpec:
    """Historical update: matched rows (open or closed) take ``columns`` from the source,
    except the partition columns; nothing is inserted."""
    return MergeSpec(
        keys=tuple(unique(keys)), open_only=False, source_filter=source_filter,
        discover_partition=discover_partition,
        set_from_source={c: c for c in columns if c not in NEVER_UPDATED}, insert_columns=(),
    )


def expire_spec(keys: Sequence[str], end_key: str, insert_columns: Sequence[str], *,
                cols_to_update: Sequence[str] | None = None, batch_col: str = BATCH_DATE,
                source_filter: str | None = None, discover_partition: bool = True) -> MergeSpec:
    """Expire open rows whose batch is not newer than the source's: ``end_key := source``;
    with two ``cols_to_update`` also ``SRC_EXPRN_DT := source.SRC_EFF_DT``. Unmatched source
    rows insert ``insert_columns``."""
    n = len(cols_to_update) if cols_to_update else 1
    if n not in (1, 2):
        raise ValueError("expire updates one column (end key) or two (end key and SRC_EXPRN_DT)")
    sets = {end_key: end_key}
    if n == 2:
        sets[SRC_EXPRN_DT] = SRC_EFF_DT
    return MergeSpec(
        keys=tuple(unique(keys)), end_key=end_key, open_only=True, source_filter=source_filter,
        discover_partition=discover_partition, batch_col=batch_col, set_from_source=sets,
        insert_columns=tuple(insert_columns),
    )


def close_and_insert(target: DataFrame, source: DataFrame, keys: Sequence[str], end_key: str, end_value: Any, *,
                     source_filter: str | None = None, discover_partition: bool = True,
                     strategy: str = "auto", salt_buckets: int = 0) -> DataFrame:
    spec = close_and_insert_spec(keys, end_key, end_value, source_filter=source_filter,
                                 discover_partition=discover_partition)
    return merge(target, source, spec, strategy=strategy, salt_buckets=salt_buckets)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], end_key: str, insert_columns: Sequence[str],
           *, scd2_columns: Sequence[str] = (), historical_sat: bool = False, source_filter: str | None = None,
           discover_partition: bool = True, strategy: str = "auto", salt_buckets: int = 0) -> DataFrame:
    spec = upsert_spec(source.columns, keys, end_key, insert_columns, scd2_columns=scd2_columns,
                       historical_sat=historical_sat, source_filter=source_filter,
                       discover_partition=discover_partition)
    return merge(target, source, spec, strategy=strategy, salt_buckets=salt_buckets)


def update_columns(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], *,
                   dedup_source: bool = False, source_filter: str | None = None, discover_partition: bool = True,
                   strategy: str = "auto", salt_buckets: int = 0) -> DataFrame:
    """``dedup_source`` keeps one source row per key, chosen repeatably."""
    from lakeshift.operators.dedup import dedup_by_key

    if dedup_source:
        source = dedup_by_key(source, keys)
    spec = update_columns_spec(keys, columns, source_filter=source_filter, discover_partition=discover_partition)
    return merge(target, source, spec, strategy=strategy, salt_buckets=salt_buckets)


def expire(target: DataFrame, source: DataFrame, keys: Sequence[str], end_key: str, insert_columns: Sequence[str],
           *, cols_to_update: Sequence[str] | None = None, batch_col: str = BATCH_DATE,
           source_filter: str | None = None, discover_partition: bool = True, strategy: str = "auto",
           salt_buckets: int = 0) -> DataFrame:
    spec = expire_spec(keys, end_key, insert_columns, cols_to_update=cols_to_update, batch_col=batch_col,
                       source_filter=source_filter, discover_partition=discover_partition)
    return merge(target, source, spec, strategy=strategy, salt_buckets=salt_buckets)
