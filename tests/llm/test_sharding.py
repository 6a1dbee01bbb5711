from __future__ import annotations

import zlib
from collections import Counter, defaultdict, deque

import pytest
from pyspark.sql import functions as F

from lakeshift.llm.sharding import bounded_ring, op1_bounded_ring, ring_points
from support import docs, edge_docs, empty_docs

SF = "/root/testdata/sf0.001"


def check_law(found, n, shards):
    counts = Counter(r["shard"] for r in found)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_query_places_every_document(spark):
    found = op1_bounded_ring(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r["doc_id"] for r in found} == set(texts)
    for r in found:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "rows", None)
    check_law(found, len(texts), 24)


@pytest.mark.parametrize("shards", [1, 3, 5])
def test_edge_rows_and_columns_are_kept(spark, shards):
    df = edge_docs(spark)
    placed = bounded_ring(df, "doc_id", shards, vnodes=4, cells=64, salts=4)
    assert placed.columns == [*df.columns, "shard", "slot"]
    check_law(placed.collect(), df.count(), shards)
    assert sorted(map(str, placed.drop("shard", "slot").collect())) == sorted(map(str, df.collect()))


def test_empty_table(spark):
    assert bounded_ring(empty_docs(spark), "doc_id", 3, vnodes=2, cells=16).collect() == []


def test_clashing_result_column(spark):
    with pytest.raises(ValueError):
        bounded_ring(docs(spark, (1, "a")).withColumn("slot", F.lit(1)), "doc_id", 2)


def test_hot_key_and_many_equal_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("k"))
    check_law(bounded_ring(df, "k", 7, vnodes=8, cells=256, salts=8).collect(), 3000, 7)


def test_overflow_continues_clockwise_and_little_moves(spark):
    df = spark.range(2000).select(F.col("id").alias("k"))
    place = lambda n: {r["k"]: r["shard"] for r in bounded_ring(df, "k", n, vnodes=64).collect()}
    before, after = place(10), place(11)
    moved = sum(before[k] != after[k] for k in before)
    # A fresh deal would move ten elevenths of the keys.
    assert moved < 0.45 * len(before)


@pytest.mark.parametrize(("n", "shards", "vnodes", "cells"), [(700, 5, 4, 512), (50, 7, 3, 64)])
def test_every_key_against_a_plain_walk_round_the_ring(spark, n, shards, vnodes, cells):
    df = spark.range(n).select(F.col("id").alias("k"))
    found = {r["k"]: r["shard"] for r in bounded_ring(df, "k", shards, vnodes=vnodes, cells=cells, salts=4).collect()}
    points = sorted((r["ord"], r["at"], r["shard"]) for r in ring_points(spark, shards, vnodes, cells).collect())
    hashed = df.select("k", F.pmod(F.xxhash64(F.lit("key"), "k"), F.lit(cells)).alias("cell"), F.pmod(F.xxhash64(F.lit("salt"), "k"), F.lit(4)).alias("salt"))
    own = defaultdict(list)
    last = points[-1][1]
    for r in hashed.collect():
        home = next((o for o, at, _ in points if at >= r["cell"]), 0)
        own[home].append((r["cell"] <= last, r["cell"], r["salt"], r["k"]))
    room = [n // shards + (s < n % shards) for s in range(shards)]
    plain, waiting = {}, deque()
    for lap in range(2):
        for o, _, shard in points:
            arrivals = deque(k for *_, k in sorted(own[o])) if lap == 0 else deque()
            for queue in (arrivals, waiting):
                while queue and room[shard]:
                    plain[queue.popleft()] = shard
                    room[shard] -= 1
            waiting.extend(arrivals)
    assert found == plain and len(plain) == n
