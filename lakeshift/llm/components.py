"""Connected components of an edge table, by alternating large-star and small-star steps
(Kiveris et al., "Connected components in MapReduce and beyond", 2014).

Each round replaces edges by edges to smaller neighbours, with sums and joins on the edge table
only: neighbour lists are never gathered. Rounds are written to the shared folder, which cuts the
lineage and survives lost executors; what the driver sees is one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import join_splittable
from lakeshift.session import scratch_path


def _star(edges: DataFrame) -> DataFrame:
    """Large-star, then small-star. Edges are (a, b) with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = join_splittable(both, least, ["a"]).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where(F.col("a") != F.col("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = join_splittable(large, low, ["a"]).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
    small = small.unionByName(low.select("a", F.col("m").alias("b")))
    return small.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edge table (a, b; any integers); a component's id
    is its smallest node. Loops, repeated edges and edges with a null end are ignored; an empty
    table gives no row."""
    spark = edges.sparkSession
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    seen = None
    while True:
        path = scratch_path(spark, "components")
        now.write.parquet(path)
        now = spark.read.parquet(path)
        mark = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen, now = mark, _star(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
