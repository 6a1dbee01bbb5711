"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of cells. Every shard owns ``vnodes`` points on it, and a key belongs
to the first point at or after its cell. A shard has a capacity; keys that find it full go on
clockwise to the next point, first come first served, until a shard has room. With capacities of
``rows / shards`` rounded down or up, row counts differ by at most one, and only overflowing keys
leave the shard that the plain ring gives them.

How it is spread out: the walk round the ring needs only the number of keys per point
(``shards * vnodes`` numbers, whatever the input size), so one short fold computes which interval
of each point's keys goes where. Rows are then numbered inside small blocks (cell, salt) by
parallel windows, and a block's offset plus the row's number names the interval, the shard and the
slot. A key that holds a third of all rows is spread over the salts of its cell; identical rows
are counted before the shuffle and unfolded afterwards.

Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1 << 16
VNODES = 32
SALTS = 64
#: Identical rows are unfolded in runs of this many.
RUN = 8192


def ring_points(spark, shards: int, vnodes: int = VNODES, cells: int = CELLS) -> DataFrame:
    """The ring: one row per virtual node with its cell, its shard and its place ``ord`` from 0
    clockwise. ``shards * vnodes`` rows."""
    points = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.floor(F.col("id") / shards).cast("int").alias("replica"),
    )
    cell = F.pmod(F.xxhash64(F.lit("point"), "shard", "replica"), F.lit(cells))
    points = points.select("shard", "replica", cell.alias("at"))
    order = Window.orderBy("at", "shard", "replica")
    return points.select("shard", "at", (F.row_number().over(order) - 1).alias("ord"))


def _cell_owners(spark, points: DataFrame, cells: int) -> DataFrame:
    """For each cell of the ring the ``ord`` of the first point at or after it (clockwise)."""
    merged = spark.range(cells).select(
        F.col("id").alias("cell"), F.lit(None).cast("int").alias("ord")
    ).unionByName(points.select(F.col("at").cast("long").alias("cell"), "ord"))
    first = merged.groupBy("cell").agg(F.min("ord").alias("ord"))
    back = Window.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, 0)
    owner = F.coalesce(F.last("ord", ignorenulls=True).over(back), F.lit(0))
    return first.select("cell", owner.alias("ord"))


def _routes(arcs: DataFrame, shards: int) -> DataFrame:
    """Where each interval of a point's keys goes.

    ``arcs`` has (ord, shard, n). The fold walks the ring twice: on the first lap a point takes
    its own keys up to the room of its shard, then waiting keys; on the second lap only waiting
    keys are left. All inputs have ``shards * vnodes`` rows, so single-task steps are bounded.
    Returns (ord, parts): parts are (lo, hi, shard, base), the slot of key x being base + x - lo.
    """
    ring = arcs.agg(
        F.array_sort(F.collect_list(F.struct("ord", "shard", "n"))).alias("ring"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
    )
    step = "struct({lap} AS lap, x.ord AS ord, x.shard AS shard, {own} AS own)"
    steps = ring.selectExpr(
        f"transform(sequence(0, {shards - 1}), s -> total div {shards} + if(s < total % {shards}, 1L, 0L)) AS room",
        "concat(transform(ring, x -> " + step.format(lap=0, own="x.n") + "),"
        " transform(ring, x -> " + step.format(lap=1, own="0L") + ")) AS steps",
    )
    walked = steps.selectExpr(
        """aggregate(
             steps,
             named_struct('room', room, 'waiting', 0L, 'seen',
               cast(array() AS array<struct<lap:int,ord:int,shard:int,own:bigint,taken:bigint,pulled:bigint>>)),
             (state, x) -> named_struct(
               'room', transform(state.room, (r, s) -> if(s = x.shard,
                  r - least(r, x.own) - least(r - least(r, x.own), state.waiting), r)),
               'waiting', state.waiting + x.own - least(state.room[x.shard], x.own)
                  - least(state.room[x.shard] - least(state.room[x.shard], x.own), state.waiting),
               'seen', concat(state.seen, array(named_struct(
                  'lap', x.lap, 'ord', x.ord, 'shard', x.shard, 'own', x.own,
                  'taken', least(state.room[x.shard], x.own),
                  'pulled', least(state.room[x.shard] - least(state.room[x.shard], x.own), state.waiting))))),
             state -> state.seen) AS seen"""
    )
    seen = walked.select(F.inline("seen"))
    along = Window.orderBy("lap", "ord").rowsBetween(Window.unboundedPreceding, -1)
    of_shard = Window.partitionBy("shard").orderBy("lap", "ord").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    seen = seen.select(
        "ord", "shard", "own", "taken", "pulled",
        before(F.col("own") - F.col("taken"), along).alias("pushed_before"),
        before(F.col("pulled"), along).alias("pulled_before"),
        before(F.col("taken") + F.col("pulled"), of_shard).alias("base"),
    )
    home = seen.where("taken > 0").selectExpr("ord", "0L AS lo", "taken AS hi", "shard", "base")
    pushed = seen.where("own > taken").selectExpr(
        "ord", "taken", "pushed_before AS q_lo", "pushed_before + own - taken AS q_hi")
    pulled = seen.where("pulled > 0").selectExpr(
        "shard", "base + taken AS base", "pulled_before AS t_lo", "pulled_before + pulled AS t_hi")
    # Two sorted lists of disjoint intervals with at most 2 * shards * vnodes members each.
    moved = pushed.join(F.broadcast(pulled), (F.col("q_lo") < F.col("t_hi")) & (F.col("t_lo") < F.col("q_hi"))).selectExpr(
        "ord",
        "taken + greatest(q_lo, t_lo) - q_lo AS lo",
        "taken + least(q_hi, t_hi) - q_lo AS hi",
        "shard",
        "base + greatest(q_lo, t_lo) - t_lo AS base",
    )
    parts = home.unionByName(moved).groupBy("ord")
    return parts.agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "shard", "base"))).alias("parts"))


def bounded_ring(
    df: DataFrame,
    key: str,
    shards: int,
    vnodes: int = VNODES,
    cells: int = CELLS,
    salts: int = SALTS,
    shard_column: str = "shard",
    slot_column: str = "slot",
) -> DataFrame:
    """Place every row of ``df`` on the ring: its columns plus ``shard`` and the ``slot`` in it,
    without gaps from 0. Row counts of two shards differ by at most one.

    - null key: a key like any other (one cell, spread over its salts); null in other columns: kept
    - repeated rows: each is placed; which copy gets which slot does not matter as they are equal
    - ties of the key: ordered by the other columns
    - empty table: no row; extra columns: kept, also those named like inner ones (these are nested)
    - ``shard`` or ``slot`` in ``df``: pass other names, a clash raises ValueError
    Columns must be orderable and hashable (no maps), as rows are grouped by all of them.
    """
    if {shard_column, slot_column} & set(df.columns):
        raise ValueError(f"{shard_column} and {slot_column} must not be columns of the input")
    spark = df.sparkSession
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])
    keyed = df.select(
        F.pmod(F.xxhash64(F.lit("key"), F.col(f"`{key}`")), F.lit(cells)).alias("cell"),
        F.pmod(F.xxhash64(F.lit("salt"), *[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).alias("salt"),
        row.alias("row"),
    )
    # Equal rows become one with a count, on the mapper's side first.
    keyed = keyed.groupBy("cell", "salt", "row").agg(F.count(F.lit(1)).alias("copies"))

    points = ring_points(spark, shards, vnodes, cells)
    owners = _cell_owners(spark, points, cells)
    blocks = keyed.groupBy("cell", "salt").agg(F.sum("copies").alias("n"))
    blocks = blocks.join(F.broadcast(owners), "cell")  # `cells` rows
    by_cell = Window.partitionBy("cell").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("in_cell", F.coalesce(F.sum("n").over(by_cell), F.lit(0)))
    sums = blocks.groupBy("cell", "ord").agg(F.sum("n").alias("n"))  # at most `cells` rows
    # Cells of a point in clockwise order: those past the last point belong to the first one.
    last = points.agg(F.max("at").alias("last"))
    turned = sums.crossJoin(F.broadcast(last)).withColumn("past", F.col("cell") <= F.col("last"))
    by_point = Window.partitionBy("ord").orderBy("past", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cell_start = turned.select("cell", F.coalesce(F.sum("n").over(by_point), F.lit(0)).alias("in_arc"))
    arcs = points.join(sums.groupBy("ord").agg(F.sum("n").alias("n")), "ord", "left").select(
        "ord", "shard", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    routes = _routes(arcs, shards)

    blocks = (
        blocks.join(F.broadcast(cell_start), "cell")  # at most `cells` rows
        .join(F.broadcast(routes), "ord")  # shards * vnodes rows
        .selectExpr(
            "cell", "salt", "in_arc + in_cell AS start",
            "filter(parts, p -> p.lo < in_arc + in_cell + n AND p.hi > in_arc + in_cell) AS parts",
        )
    )
    in_block = Window.partitionBy("cell", "salt").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("before", F.coalesce(F.sum("copies").over(in_block), F.lit(0)))
    placed = placed.join(blocks, ["cell", "salt"]).selectExpr(
        "row", "start + before AS p_lo", "start + before + copies AS p_hi", "parts")
    placed = placed.selectExpr(
        "row", "p_lo", "p_hi", "inline(filter(parts, p -> p.lo < p_hi AND p.hi > p_lo)) AS (lo, hi, shard, base)")
    placed = placed.selectExpr(
        "row", "shard", "base + greatest(p_lo, lo) - lo AS s_lo", "base + least(p_hi, hi) - lo AS s_hi")
    runs = placed.selectExpr("row", "shard", "s_hi", f"explode(sequence(s_lo, s_hi - 1, {RUN}L)) AS run_lo")
    out = runs.selectExpr(
        "row", "shard", f"explode(sequence(run_lo, least(run_lo + {RUN}, s_hi) - 1)) AS slot")
    return out.select(
        *[F.col("row")[c].alias(c) for c in df.columns],
        F.col("shard").alias(shard_column), F.col("slot").alias(slot_column))


def op1_bounded_ring(spark, sf_dir: str) -> DataFrame:
    """All documents on 24 shards, law ``rows``. A null text has 8 bytes and the CRC of no byte."""
    from lakeshift.llm.common import table

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = bounded_ring(digest, "doc_id", 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
