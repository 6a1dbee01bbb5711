"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, exact rerank.

Vectors are compared within groups of equal label and length. A vector x, scaled to length one,
lies in the inverted list of its nearest coarse centre; what is left of it is cut into subspaces,
and each part is replaced by the nearest of 256 code words. The codes stand for a vector x' that is
known to lie ``error = |x - x'|`` from x.

Searching with a vector q takes three steps, and none of them can lose a link:

* lists: a vector within ``reach`` of q (cosine 0.98 is a distance of 0.2) that belongs to list c is
  no nearer to any other centre b, so q is at most ``reach`` beyond the plane between c and b.
  Lists that fail this for some b are not probed; all others are.
* codes: the distance from q to x' is a sum of table entries, one per subspace (asymmetric: q is not
  coded). Since ``|q - x'| <= |q - x| + error``, members beyond ``reach + error`` are left out.
* rerank: the cosine of what remains is computed in double precision and decides.

The quantiser is fitted on at most ``SAMPLE`` vectors (those with the smallest hash); how well it
fits changes the cost of the search, not its result. Every vector is indexed and every vector
searches. Equal vectors of a group are one member with a count.

A list may hold a third of all vectors and be probed by as many, so its members and its queries
are dealt into tiles of at most about ``BLOCK`` members and ``QUERIES`` queries. A tile returns one
count per query and the links that join its rows into components (a spanning forest), not its
pairs. Components are then joined by the edge table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeshift.llm.common import join_splittable, table
from lakeshift.llm.components import components
from lakeshift.session import scratch_path

THRESHOLD = 0.98
#: Vectors that the quantiser is fitted on, at most.
SAMPLE = 16_384
SUBSPACES = 8
WORDS = 256
#: Distinct vectors a list has on average, between the bounds of the number of lists.
LIST_SIZE = 512
LISTS = (8, 1024)
#: Members and queries of a tile, on average.
BLOCK = 2048
QUERIES = 16_384
#: Rounding slack of the two filters.
SLACK = 1e-9


# --- quantiser --------------------------------------------------------------------------------


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :], 0)


def centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from rows spread evenly over the sample; centres without rows stay where they are."""
    k = max(1, min(k, len(x)))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = squared(x, c).argmin(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


@dataclass
class Quantiser:
    """Coarse centres and a code book per subspace, over the first ``dim`` numbers of a vector."""

    coarse: np.ndarray
    books: list[np.ndarray]
    dim: int

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, words: int = WORDS) -> Quantiser:
        coarse = centres(sample, lists)
        left = sample - coarse[squared(sample, coarse).argmin(1)]
        parts = np.array_split(left, max(1, min(subspaces, sample.shape[1])), axis=1)
        return cls(coarse, [centres(p, words) for p in parts], sample.shape[1])

    def cut(self, x: np.ndarray) -> list[np.ndarray]:
        return np.array_split(x, len(self.books), axis=1)

    def view(self, vectors: list[np.ndarray]) -> np.ndarray:
        """Vectors of any lengths as rows of ``dim`` numbers: the first ones, or zeros behind.
        Distances between vectors of one length do not grow by this."""
        out = np.zeros((len(vectors), self.dim))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v[: self.dim]
        return out

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists, codes and errors of the rows of x."""
        lists = squared(x, self.coarse).argmin(1)
        left = x - self.coarse[lists]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        error = np.zeros(len(x))
        for j, (part, book) in enumerate(zip(self.cut(left), self.books)):
            codes[:, j] = squared(part, book).argmin(1)
            error += ((part - book[codes[:, j]]) ** 2).sum(1)
        return lists, codes, np.sqrt(error)

    def probes(self, x: np.ndarray, reach: float) -> np.ndarray:
        """Which lists (columns) can hold a vector within ``reach`` of each row of x."""
        away = squared(x, self.coarse)
        gaps = np.sqrt(squared(self.coarse, self.coarse))
        open_ = np.ones(away.shape, bool)
        for b in range(len(self.coarse)):
            beyond = away - away[:, b, None]  # twice the gap times the way past the plane to list b
            open_ &= beyond <= 2 * gaps[b][None, :] * reach + SLACK
        return open_

    def distances(self, q: np.ndarray, codes: np.ndarray, list_id: int) -> np.ndarray:
        """Asymmetric distances of rows of q to the coded members of one list."""
        out = np.zeros((len(q), len(codes)))
        for j, (part, book) in enumerate(zip(self.cut(q - self.coarse[list_id]), self.books)):
            out += squared(part, book)[:, codes[:, j]]
        return np.sqrt(out)


# --- tasks ------------------------------------------------------------------------------------

CODED = T.StructType([
    T.StructField("node", T.LongType()), T.StructField("copies", T.LongType()), T.StructField("grp", T.StringType()),
    T.StructField("vector", T.BinaryType()), T.StructField("list", T.IntegerType()), T.StructField("codes", T.BinaryType()),
    T.StructField("error", T.DoubleType()), T.StructField("probes", T.ArrayType(T.IntegerType()))])


def unit(v: np.ndarray) -> np.ndarray:
    """A finite non-zero vector scaled to length one; no square over- or underflows."""
    v = v / np.abs(v).max()
    return v / np.sqrt((v * v).sum())


def _encode(batches: Iterator[pa.RecordBatch], model: Quantiser, reach: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            vectors = [unit(np.array(v, float)) for v in part.column("embedding").to_pylist()]
            if not vectors:
                continue
            x = model.view(vectors)
            lists, codes, error = model.encode(x)
            probes = [np.flatnonzero(p).astype(np.int32) for p in model.probes(x, reach)]
            yield pa.RecordBatch.from_arrays([
                part.column("node"), part.column("copies"), part.column("grp"),
                pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array(lists.astype(np.int32)),
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                pa.array(probes, pa.list_(pa.int32()))], schema=schema)


FOUND = T.StructType([
    T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("n", T.LongType())])


class _Tile:
    """One tile: members come first and are held, queries stream past in small lots. ``rows``
    yields (query, None, count) and (query, member, None), the links of a spanning forest."""

    def __init__(self, model: Quantiser, threshold: float, reach: float) -> None:
        self.model, self.threshold, self.reach = model, threshold, reach
        self.members: list[tuple] = []
        self.ready = False

    def start(self) -> None:
        node, copies, vector, codes, error = zip(*self.members)
        self.node, self.copies = np.array(node), np.array(copies)
        self.vectors = np.array([np.frombuffer(v) for v in vector])
        self.codes = np.array([np.frombuffer(c, np.uint8) for c in codes])
        self.limit = np.array(error) + self.reach + SLACK
        self.root = np.arange(len(node))
        self.ready = True

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def search(self, list_id: int, nodes: np.ndarray, vectors: np.ndarray) -> Iterator[tuple]:
        if not self.members:
            return
        if not self.ready:
            self.start()
        near = self.model.distances(self.model.view(list(vectors)), self.codes, list_id) <= self.limit[None, :]
        rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(rows):
            return
        cosine = vectors[rows] @ self.vectors[columns].T
        linked = near[np.ix_(rows, columns)] & (cosine >= self.threshold)
        linked &= nodes[rows][:, None] != self.node[columns][None, :]
        counts = linked @ self.copies[columns]
        for i in np.flatnonzero(counts):
            q, found = int(nodes[rows[i]]), columns[linked[i]]
            yield q, None, int(counts[i])
            parts: dict[int, int] = {}
            for m in np.unique(self.root[found], return_index=True)[1]:
                parts.setdefault(self.find(int(found[m])), int(self.node[found[m]]))
            for other in parts.values():
                yield q, other, None
            first = min(parts)
            for p in parts:
                self.root[p] = first


def _search(batches: Iterator[pa.RecordBatch], model: Quantiser, threshold: float, reach: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    key, tile, out = None, None, []
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        names, kinds = list(zip(cols["grp"], cols["list"], cols["block"], cols["lot"])), cols["is_query"]
        at = 0
        while at < len(names):
            if names[at] != key:
                key, tile = names[at], _Tile(model, threshold, reach)
            end = at + 1
            while end < len(names) and end - at < 256 and names[end] == key and kinds[end] == kinds[at]:
                end += 1
            if kinds[at]:
                vectors = np.array([np.frombuffer(v) for v in cols["vector"][at:end]])
                out.extend(tile.search(key[1], np.array(cols["node"][at:end]), vectors))
            else:
                tile.members.extend(zip(*(cols[c][at:end] for c in ("node", "copies", "vector", "codes", "error"))))
            at = end
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
            out = []


# --- frames -----------------------------------------------------------------------------------


def comparable(embedding: str | Column = "embedding") -> Column:
    """Vectors that can link: not null or empty, all numbers there and finite, one of them not 0."""
    v = F.col(embedding) if isinstance(embedding, str) else embedding
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _tiles(coded: DataFrame, block: int, lot: int) -> DataFrame:
    """Members and queries of all tiles. Both are dealt by a hash of their node; the number of
    blocks and lots of a list follows from its counts."""
    asked = coded.select("node", "grp", "vector", F.explode("probes").alias("list"))
    members = coded.groupBy("grp", "list").agg(F.count(F.lit(1)).alias("n_members"))
    queries = asked.groupBy("grp", "list").agg(F.count(F.lit(1)).alias("n_queries"))
    sizes = members.join(queries, ["grp", "list"]).select(
        "grp", "list", F.ceil(F.col("n_members") / block).alias("blocks"), F.ceil(F.col("n_queries") / lot).alias("lots"))
    part = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    held = join_splittable(coded.drop("probes"), sizes, ["grp", "list"]).select(
        "grp", "list", part("blocks", 1).alias("block"), every("lots").alias("lot"), F.lit(False).alias("is_query"),
        "node", "copies", "vector", "codes", "error")
    past = join_splittable(asked, sizes, ["grp", "list"]).select(
        "grp", "list", part("lots", 2).alias("lot"), every("blocks").alias("block"), F.lit(True).alias("is_query"), "node", "vector")
    tile = ["grp", "list", "block", "lot"]
    return held.unionByName(past, allowMissingColumns=True).repartition(*tile).sortWithinPartitions(*tile, "is_query")


def near_duplicates(
    df: DataFrame,
    threshold: float = THRESHOLD,
    *,
    sample: int = SAMPLE,
    list_size: int = LIST_SIZE,
    block: int = BLOCK,
    lot: int = QUERIES,
) -> DataFrame:
    """One row per row of ``df`` (vec_id integer, embedding array of numbers, label): vec_id, n_links
    (other rows with the same label and a cosine of ``threshold``, above 0, or more), component_id
    (the smallest vec_id reachable by links, its own included) and kept (vec_id is component_id).

    - null label; vector that is null, empty, zero or has a null or non-finite number: no links
    - vectors of different lengths do not link
    - repeated rows and equal vectors: each is a row, linked with the others
    - null vec_id: linked like others; component_id is the smallest id that is not null, if any;
      kept where both are null
    - an empty table gives no row; other columns are left out
    - ``sample``, ``list_size``, ``block`` and ``lot`` change the cost of the work, not the result
    """
    spark = df.sparkSession
    reach = float(np.sqrt(2 - 2 * threshold))
    rows = df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("string").alias("label"))
    # -0.0 and 0.0 are one number
    rows = rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    fit = rows.where(F.col("label").isNotNull() & comparable())
    path = scratch_path(spark, "vectors")
    distinct = fit.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    distinct.select(F.monotonically_increasing_id().alias("node"), "*").write.parquet(path)
    distinct = spark.read.parquet(path)
    n, groups, most = distinct.select(
        F.count(F.lit(1)), F.countDistinct("label"), F.max(F.size("embedding"))).first()
    if n == 0:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))

    # The length that the quantiser sees: that of the sampled vectors' median.
    picked = distinct.select(F.xxhash64("embedding").alias("h"), "node", "embedding").orderBy("h", "node").limit(sample)
    points = [unit(np.array(r.embedding, float)) for r in picked.select("embedding").toLocalIterator()]
    dim = sorted(len(p) for p in points)[len(points) // 2]
    model = Quantiser(np.zeros((1, dim)), [], dim)
    model = Quantiser.fit(model.view(points), int(np.clip(n / max(groups, 1) / list_size, *LISTS)))
    held = spark.sparkContext.broadcast(model)

    coded_arrow, found_arrow = to_arrow_schema(CODED), to_arrow_schema(FOUND)
    path = scratch_path(spark, "vector-codes")
    grp = F.concat_ws(":", F.size("embedding").cast("string"), "label").alias("grp")
    distinct.select("node", "copies", grp, "embedding").mapInArrow(
        lambda b: _encode(b, held.value, reach, coded_arrow), CODED).write.parquet(path)
    coded = spark.read.parquet(path)
    path = scratch_path(spark, "vector-links")
    _tiles(coded, block, lot).mapInArrow(
        lambda b: _search(b, held.value, threshold, reach, found_arrow), FOUND).write.parquet(path)
    found = spark.read.parquet(path)
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    comps = components(found.where("b IS NOT NULL").select("a", "b"))

    known = distinct.join(counts, "node", "left").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = join_splittable(known, least, ["component"]).select(
        "label", "embedding", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = join_splittable(fit, known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(F.col("label").isNotNull() & comparable(), F.lit(False)))
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_residual_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings``: links at a cosine of 0.98 or more, components, kept rows."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: Brute force: all pairs of a label, then reachability over the links.
ORACLE_OP13 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fine AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM fine a JOIN fine b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (
  SELECT r, r FROM v
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
parts AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
degree AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(degree.n, 0) AS BIGINT) AS n_links, parts.component_id,
       v.vec_id IS NOT DISTINCT FROM parts.component_id AS kept
FROM v JOIN parts USING (r) LEFT JOIN degree USING (r)
"""
