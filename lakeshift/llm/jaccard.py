"""N-gram Jaccard join by MinHash banding.

1. Words are hashed in the JVM; numpy makes the document's set of five-word shingles, the set's own
   fingerprint, and its MinHash bands. Numbers of bands and rows per band follow from the
   similarity and the recall wanted.
2. Documents with equal sets are one class. Classes are shuffled on (band, hash); those that share
   a hash form a bucket. Buckets with the same members are verified once.
3. Buckets are verified on full shingle sets, in blocks: a bucket of k classes is dealt into
   k / BLOCK blocks, and a task gets two blocks (or one with itself), counts common shingles of
   their members by a matrix product, and returns per class how many links it found and a spanning
   forest of them. A pair counts in the first band in which it meets, so that it counts once, no
   pair that met in a bucket is lost, and pairs are never written out as rows.
4. Classes that meet, directly or through others, are a candidate group. Where verifying a group's
   buckets one by one would send more rows to tasks than verifying the group as one bucket (always,
   if it fits into a block), the group is verified as one. So a small group's texts move once,
   and the work of a chain of texts, each like the next one only, follows their meetings.
5. Links are summed per class; their connected components are the near-duplicate classes.

Only shingle sets of classes that met another one are ever moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import join_splittable, table, text_or_empty
from lakeshift.llm.components import components
from lakeshift.session import scratch_path

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
MAX_HASHES = 200
BLOCK = 400


def choose_bands(similarity: float = SIMILARITY, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest chance meetings, with which a pair of
    the given similarity still meets in some band with the recall wanted."""
    best = None
    for rows in range(1, max_hashes + 1):
        p = similarity**rows
        bands = 1 if p >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-p)))
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no number of bands reaches this recall with so few hashes")
    return best


def word_hashes(text: Column) -> Column:
    """Hashes of the words (runs free of blanks, lower case), computed in the JVM."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of n consecutive words; all words together if there are fewer."""
    if not len(words):
        return np.empty(0, np.uint64)
    w = words.astype(np.int64).view(np.uint64)
    n = min(n, len(w))
    total = np.zeros(len(w) - n + 1, np.uint64)
    for k in range(n):
        total = _mix(total + w[k:len(w) - n + 1 + k] + np.uint64(0x9E3779B97F4A7C15))
    return np.unique(total)


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.times = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def band_hashes(self, shingles: np.ndarray) -> np.ndarray:
        """One hash per band of the set's minima."""
        least = np.full(self.bands * self.rows, np.iinfo(np.uint64).max, np.uint64)
        for lo in range(0, len(shingles), 256):
            part = shingles[lo:lo + 256, None] * self.times + self.plus
            np.minimum(least, part.min(axis=0), out=least)
        total = np.zeros(self.bands, np.uint64)
        for row in least.reshape(self.bands, self.rows).T:
            total = _mix(total + row + np.uint64(0x9E3779B97F4A7C15))
        return total.view(np.int64)


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of an array column as numpy views; null is empty."""
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i, ok in enumerate(valid):
        yield values[offsets[i]:offsets[i + 1]] if ok else values[:0]


def _sketches(df: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, of, key, bands): the set's fingerprint (two longs; null for a document without words)
    and its band hashes. ``df`` has (id, of, words)."""
    def run(batches):
        minhash = MinHash(bands, rows)
        for batch in batches:
            keys, hashes = [], []
            for words in _lists(batch.column(2)):
                s = shingle_set(words)
                if not len(s):
                    keys.append(None)
                    hashes.append(None)
                    continue
                fold = _mix(s ^ np.uint64(0x243F6A8885A308D3))
                keys.append([int(s.sum(dtype=np.uint64).view(np.int64)), int(fold.sum(dtype=np.uint64).view(np.int64))])
                hashes.append(minhash.band_hashes(s).tolist())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, longs), pa.array(hashes, longs)],
                names=["id", "of", "key", "bands"])

    return df.mapInArrow(run, "id long, of long, key array<long>, bands array<long>")


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (one of ``left``, one of ``right``) whose sets are similar enough.

    Common shingles are counted by products of 0/1 matrices over the shingles that two or more
    sets hold, some thousand columns at a time.
    """
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = np.array([[len(np.intersect1d(sets[0], sets[1], assume_unique=True))]], dtype=np.float32)
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keep = held[column] > 1
        number = np.cumsum(held > 1) - 1
        owner, column = owner[keep], number[column[keep]]
        common = np.zeros((len(left), len(right)), dtype=np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        width = 4096
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [lo, lo + width])
            holds = np.zeros((len(sets), width), dtype=np.float32)
            holds[owner[a:b], column[a:b] - lo] = 1
            common += holds[left] @ holds[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    i, j = np.nonzero(common >= similarity * union - 1e-6)
    return left[i], right[j]


def _verify(groups: DataFrame, similarity: float) -> DataFrame:
    """``groups`` has (band, bucket, i, j, block, class, copies, bands, words), rows of a block pair
    together; band -1 is a whole candidate group. Returns (class, n, n_docs, near): links found
    here for a class (to classes and to their documents), and a linked class that ties it into the
    forest."""
    def solve(key, class_ids, copies, blocks, bands, sets):
        band, _, i, j = key
        blocks = np.array(blocks)
        left, right = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
        a, b = _links(sets, left, right, similarity) if len(sets) > 1 else (left[:0], right[:0])
        inside = a < b if i == j else np.ones(len(a), bool)
        a, b = a[inside], b[inside]
        if band > 0:  # pairs that met in a band before are counted there
            earlier, bands = np.zeros(len(a), bool), np.array(bands)
            for k in range(band):
                earlier |= bands[a, k] == bands[b, k]
            a, b = a[~earlier], b[~earlier]
        n, n_docs = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
        np.add.at(n, a, 1)
        np.add.at(n, b, 1)
        copies = np.array(copies)
        np.add.at(n_docs, a, copies[b])
        np.add.at(n_docs, b, copies[a])
        # A forest by union-find: of all links, those that join two trees.
        root = list(range(len(sets)))

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        near = [None] * len(sets)
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = top(x), top(y)
            if p != q:
                lo, hi = min(p, q), max(p, q)
                root[hi] = lo
                near[hi] = class_ids[lo]
        at = [k for k in range(len(sets)) if n[k]]
        return pa.RecordBatch.from_arrays([
            pa.array([class_ids[k] for k in at], pa.int64()), pa.array(n[at], pa.int64()),
            pa.array(n_docs[at], pa.int64()), pa.array([near[k] for k in at], pa.int64())],
            names=["class", "n", "n_docs", "near"])

    def run(batches):
        key, rows = None, ([], [], [], [], [])
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True))
            blocks, ids, copies = (batch.column(c).to_pylist() for c in (4, 5, 6))
            bands = [x.copy() for x in _lists(batch.column(7))]
            for r, words in enumerate(_lists(batch.column(8))):
                if keys[r] != key:
                    if len(rows[0]) > 1:
                        yield solve(key, *rows)
                    key, rows = keys[r], ([], [], [], [], [])
                for store, value in zip(rows, (ids[r], copies[r], blocks[r], bands[r], shingle_set(words)), strict=True):
                    store.append(value)
        if len(rows[0]) > 1:
            yield solve(key, *rows)

    return groups.mapInArrow(run, "class long, n long, n_docs long, near long")


def jaccard_join(
    df: DataFrame, id_column: str = "doc_id", text: str = "text",
    similarity: float = SIMILARITY, recall: float = RECALL, block: int = BLOCK, null_ids: bool = False,
) -> DataFrame:
    """One row per row of ``df``: id, ``class_id`` (near-duplicate class: the smallest id among
    documents connected by links), ``copy_id`` (smallest id with an equal shingle set),
    ``n_links`` (other documents with a similarity of at least ``similarity``, copies counted) and
    ``n_linked_sets`` (different shingle sets among them).

    - null or empty text, or blanks only: no links; class and copy id are the row's own id
    - fewer than five words: the set has one shingle of all words
    - null id: the row stands alone, with null class and copy id and no links; with ``null_ids`` it
      is classed by its text like any other, and class and copy id are the smallest that are not
      null, or null where there is none
    - repeated rows and texts under different ids are copies; extra columns are ignored
    """
    out = _classified(df, id_column, text, similarity, recall, block, null_ids)
    return out.select(F.col("id").alias(id_column), "class_id", "copy_id", "n_links", "n_linked_sets")


def _classified(df: DataFrame, id_column: str, text: str, similarity: float, recall: float, block: int, null_ids: bool) -> DataFrame:
    """As ``jaccard_join``, with the id as ``id``, the text's hash as ``of`` and a number of the class
    as ``component`` (null: the text has no words)."""
    spark = df.sparkSession
    bands, rows = choose_bands(similarity, recall)
    body = text_or_empty(F.col(f"`{text}`"))
    docs = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.xxhash64(body, F.length(body)).alias("of"), body.alias("body"))
    path = scratch_path(spark, "sketches")
    _sketches(docs.select("id", "of", word_hashes(F.col("body")).alias("words")), bands, rows).write.parquet(path)
    sketches = spark.read.parquet(path)

    known = sketches.where("key IS NOT NULL" if null_ids else "key IS NOT NULL AND id IS NOT NULL")
    classes = known.groupBy("key").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "of")).alias("head"), F.count(F.lit(1)).alias("copies"), F.any_value("bands").alias("bands"))
    path = scratch_path(spark, "classes")
    classes.select(
        "key", F.xxhash64("key").alias("class"), F.col("head.id").alias("copy_id"), F.col("head.of").alias("of"),
        "copies", "bands").write.parquet(path)
    classes = spark.read.parquet(path)

    path = scratch_path(spark, "links")
    _verify(_groups(docs, classes, block), similarity).write.parquet(path)
    links = spark.read.parquet(path)
    sums = links.groupBy("class").agg(F.sum("n").alias("n_linked_sets"), F.sum("n_docs").alias("n_docs"))
    joined = components(links.where("near IS NOT NULL").select(F.col("class").alias("a"), F.col("near").alias("b")))
    members = joined.join(classes.select(F.col("class").alias("node"), "copy_id"), "node")
    named = members.join(members.groupBy("component").agg(F.min("copy_id").alias("class_id")), "component")
    found = (
        classes.select("key", "class", "copy_id", "copies")
        .join(sums, "class", "left")
        .join(named.select(F.col("node").alias("class"), "component", "class_id"), "class", "left")
    )
    alone = F.lit(False) if null_ids else F.col("id").isNull()
    out = sketches.select("id", "of", F.when(~alone, F.col("key")).alias("key")).join(found, "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "id", "of", F.coalesce("component", "class").alias("component"),
        F.coalesce("class_id", "copy_id", "id").alias("class_id"),
        F.coalesce("copy_id", "id").alias("copy_id"),
        (zero(F.col("n_docs")) + zero(F.col("copies") - 1)).alias("n_links"),
        zero(F.col("n_linked_sets")).alias("n_linked_sets"))


def _buckets(classes: DataFrame, block: int) -> DataFrame:
    """(band, bucket, n, class): the buckets to verify, their numbers of classes, and these; band -1
    is a whole candidate group."""
    spark = classes.sparkSession
    met = classes.select("class", F.posexplode("bands").alias("band", "hash"))
    shared = met.groupBy("band", "hash").agg(
        F.min("class").alias("leader"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("class")).alias("x"), F.bit_xor(F.xxhash64(F.lit("members"), "class")).alias("y")).where("n > 1")
    path = scratch_path(spark, "buckets")
    join_splittable(met, shared, ["band", "hash"]).write.parquet(path)
    members = spark.read.parquet(path)
    # Of buckets with the same members the first band's stays: a pair's first common band is kept.
    buckets = members.where("class = leader").groupBy("n", "x", "y").agg(
        F.min(F.struct("band", "hash", "leader")).alias("b")).select("b.band", "b.hash", F.col("b.leader").alias("node"), "n")

    grouped = components(members.where("class <> leader").select(F.col("class").alias("a"), F.col("leader").alias("b")))
    rows = lambda n: n * F.ceil(F.col("n") / block)  # rows that tasks get for a bucket
    buckets = buckets.join(grouped, "node").select("component", "band", "hash", "n")
    whole = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("n")).select("component", "n", rows(F.col("n")).alias("whole"))
    cost = buckets.groupBy("component").agg(F.sum(rows(F.col("n"))).alias("apart"))
    sizes = whole.join(cost, "component")
    one = join_splittable(grouped, sizes.where("apart >= whole").select("component", "n"), ["component"])
    some = join_splittable(buckets, sizes.where("apart < whole").select("component"), ["component"])
    some = join_splittable(members.select("class", "band", "hash"), some.select("band", "hash", "n"), ["band", "hash"])
    return one.select(F.lit(-1).alias("band"), F.col("component").alias("bucket"), "n", F.col("node").alias("class")).unionByName(
        some.select("band", F.col("hash").alias("bucket"), "n", "class"))


def _groups(docs: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """The block pairs to verify: (band, bucket, i, j, block, class, copies, bands, words), rows of a
    pair of blocks together in a partition."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = _buckets(classes, block).select("class", F.struct(
        "band", "bucket", blocks.alias("blocks"),
        F.pmod(F.xxhash64(F.lit("block"), "class"), blocks).cast("int").alias("block")).alias("place"))
    places = placed.groupBy("class").agg(F.collect_list("place").alias("places"))  # at most one per band
    heads = places.join(classes.select("class", "copies", "bands", F.col("copy_id").alias("id"), "of"), "class")
    # Equal rows of the table would bring a text more than once: one of them is enough.
    heads = heads.withColumnsRenamed({"id": "head_id", "of": "head_of"})
    same = docs["id"].eqNullSafe(heads["head_id"]) & (docs["of"] == heads["head_of"])
    texts = docs.join(heads, same).dropDuplicates(["class"]).select("class", "copies", "bands", "body", F.inline("places"))
    dealt = texts.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "band", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "class", "copies",
        F.when(F.col("band") > 0, F.col("bands")).alias("bands"), "body")
    # The words are hashed after the shuffle, which moves the shorter texts.
    key = ["band", "bucket", "i", "j"]
    dealt = dealt.repartition(*key)
    return dealt.select(*key, "block", "class", "copies", "bands", word_hashes(F.col("body")).alias("words")).sortWithinPartitions(*key)


def drop_near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text: str = "text",
    similarity: float = SIMILARITY, recall: float = RECALL, block: int = BLOCK, null_ids: bool = False,
) -> DataFrame:
    """``df`` with one row of each near-duplicate class, that with the smallest id (of several
    texts under this id, that with the smallest hash; of rows with the same id and text, that whose
    other columns have the smallest hash); its columns are kept.

    Texts without words are classes of their own, and rows with a null id all stay. With
    ``null_ids`` both are classed, too: a row with a null id stays only where its class has no other
    id, and one of all texts without words stays."""
    of = lambda: F.xxhash64(text_or_empty(F.col(f"`{text}`")), F.length(text_or_empty(F.col(f"`{text}`"))))
    id_ = F.col(f"`{id_column}`").cast("long")
    found = _classified(df, id_column, text, similarity, recall, block, null_ids)
    if null_ids:
        heads = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "of")).alias("head"))
        chosen = heads.select(F.col("head.id").alias("kept_id"), F.col("head.of").alias("kept_of"))
    else:
        heads = found.where("id = class_id")
        chosen = heads.groupBy(F.col("id").alias("kept_id")).agg(F.min("of").alias("kept_of"))
    inside = df if null_ids else df.where(id_.isNotNull())
    rows = inside.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns]).alias("row"), id_.alias("id"), of().alias("of"))
    rows = rows.join(chosen, rows["id"].eqNullSafe(chosen["kept_id"]) & (rows["of"] == chosen["kept_of"]), "left_semi")
    image = [F.to_json(F.col("row")[f.name]) if "map<" in f.dataType.simpleString() else F.col("row")[f.name] for f in df.schema.fields]
    one = rows.groupBy("id", "of").agg(F.min_by("row", F.xxhash64(*image)).alias("row"))
    one = one.select(*[F.col("row")[c].alias(c) for c in df.columns])
    return one if null_ids else one.unionByName(df.where(id_.isNull()))


def op7_minhash_join(spark, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more, over all documents."""
    return jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text"), null_ids=True)
