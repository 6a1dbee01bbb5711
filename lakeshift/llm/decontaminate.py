"""Benchmark decontamination: rare word-pair seeds without loss, then Smith-Waterman alignment.

The score of an item in a text is that of the best local alignment by words (match 1; replaced,
added or dropped word -1) over the item's length. An alignment of score S has at least S - 1 places
where two neighbouring words of the item stand unchanged side by side: its runs of matches are
parted by at least one error each, so matches - runs >= S - 1. So of the item's P places of pairs at most
P - S + 1 are missing, and of any P - S + 2 of them one stands in the text: the rarest ones are the seeds
(prefix filter). What follows only drops what cannot reach the score, and common pairs join nothing.
An alignment of score S to n words spans at most 2 n - S words of the text: the added words cost
what the matches bring in, and there are n matches at most.

1. The low hash bits of the items' word pairs make a table of two bytes an entry, which is all that is
   sent to every task: 16 entries for each pair, at least 8 MB and at most 32 MB, however large the
   benchmark is. Items are classed by the score that they need; a bit of an entry stands for a class.
2. One pass over the corpus marks the places whose pair is in the table. Where a class's least
   number of marked places lies within the longest span of the class, they are kept, with the
   words around them; equal texts are kept once.
   Items of one to four words match, where that is asked for, if all their words stand in a row:
   the same kind of table marks places in the texts, and a join on the full hashes, with the words
   compared, decides.
3. The stretches that hold a pair are counted, and each item's rarest pairs are joined to them on the full
   hashes. A stretch needs as many of the rarest as an alignment must have even if all others are there.
   Those that do are checked by all of the item's pairs, and aligned, which bears replaced, added
   and dropped words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import join_splittable, table, text_or_empty
from lakeshift.llm.jaccard import _lists, _mix
from lakeshift.session import scratch_path

#: Shorter items have no alignment with errors that would say anything: they match word by word.
LEAST_WORDS = 5
SEED_WORDS = 2
#: Entries of the table of word pairs, at least and at most; no more small integers reach the driver and
#: the tasks. A fuller table marks more places, which the join then drops.
BITMAP = 1 << 22
MOST_ENTRIES = 1 << 24
#: The least score that an item of a class needs; as many classes as an entry has bits.
NEEDS = (2, 3, 4, 6, 8, 10, 12, 15, 19, 24, 32, 45, 64, 96, 160, 320)
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 1.0, -1.0, -1.0


def word_hashes(text: Column) -> Column:
    """Hashes of the words: runs of letters and digits, lower case."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def ngrams(words: np.ndarray, n: int = SEED_WORDS) -> np.ndarray:
    """Hashes of n consecutive words, by place; none if there are fewer words."""
    if len(words) < n:
        return np.empty(0, np.int64)
    w = words.astype(np.int64).view(np.uint64)
    total = np.zeros(len(w) - n + 1, np.uint64)
    for k in range(n):
        total = _mix(total + w[k:len(w) - n + 1 + k] + np.uint64(0x9E3779B97F4A7C15))
    return total.view(np.int64)


def dense(places: np.ndarray, count: int, span: int) -> np.ndarray:
    """Which of the sorted places are among ``count`` places or more within ``span`` words."""
    held = np.zeros(len(places) + 1, np.int64)
    first = np.flatnonzero(places[count - 1:] - places[:max(0, len(places) - count + 1)] < span)
    np.add.at(held, first, 1)
    np.add.at(held, first + count, -1)
    return np.cumsum(held)[:-1] > 0


def _spans(places: np.ndarray, margin: int) -> list[tuple[int, int]]:
    """Runs of sorted places that are at most two margins apart, as (first, last)."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 2 * margin)
    firsts, lasts = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(places) - 1]])
    return list(zip(places[firsts].tolist(), places[lasts].tolist(), strict=True))


def _stretches(df: DataFrame, marks: np.ndarray, classes: list[tuple[int, int, int]]) -> DataFrame:
    """(of, at, words): the parts of texts, from word ``at``, that may hold an item. ``df`` has
    (of, words); ``marks`` is the table of pairs, and ``classes`` has (bit, count, span): an item
    of the class stands only where so many of its pairs are within so many words."""
    def run(batches):
        for batch in batches:
            out = ([], [], [])
            ofs = batch.column(0).to_pylist()
            for of, words in zip(ofs, _lists(batch.column(1)), strict=True):
                bits = marks[ngrams(words) & (len(marks) - 1)]
                marked = np.flatnonzero(bits)
                bits, parts = bits[marked], []
                for bit, count, span in classes:
                    places = marked[bits & (1 << bit) != 0]
                    if len(places) >= count:
                        parts += [(max(0, a - span), min(len(words), b + SEED_WORDS + span))
                                  for a, b in _spans(places[dense(places, count, span)], span)]
                end = 0
                for a, b in sorted(parts):
                    if out[0] and end and a <= end:
                        end = max(b, end)
                        out[2][-1] = words[out[1][-1]:end]
                    else:
                        end = b
                        for store, value in zip(out, (of, a, words[a:b]), strict=True):
                            store.append(value)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["of", "at", "words"])

    return df.mapInArrow(run, "of long, at long, words array<long>")


def _seeds(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., seed, times): the different word pairs of each row and at how many places they
    are. The last column of ``df`` has the word hashes; the keys are longs."""
    def run(batches):
        for batch in batches:
            found = [np.unique(ngrams(words), return_counts=True) for words in _lists(batch.column(len(keys)))]
            if found:
                at = pa.array(np.repeat(np.arange(len(found)), [len(seeds) for seeds, _ in found]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(at) for k in range(len(keys))), *(pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found, strict=True))],
                    names=[*keys, "seed", "times"])

    kinds = ", ".join(f"{k} long" for k in keys)
    return df.mapInArrow(run, f"{kinds}, seed long, times long")


def _entries(pairs: int) -> int:
    """Entries of a table for so many pairs: a power of two within the bounds."""
    return min(MOST_ENTRIES, max(BITMAP, 1 << (16 * pairs - 1).bit_length() if pairs else 0))


def _rarest(seeds: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs of each item that are joined: its rarest ones, together at n - need + 1 places, so that
    every alignment that reaches ``need`` has one of them. ``seeds`` has (item_of, seed, times, n, need),
    ``held`` (seed, held): in how many stretches a pair is. Returns (item_of, seed, times, least):
    an alignment has at least ``least`` places of these pairs."""
    by_rareness = Window.partitionBy("item_of").orderBy("held", "seed")  # an item's pairs
    before = F.coalesce(F.sum("times").over(by_rareness.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = seeds.join(held, "seed", "left").withColumn("held", F.coalesce("held", F.lit(0))).withColumn("before", before)
    chosen = ranked.where(F.col("before") < F.col("n") - F.col("need") + 1)
    # n - 1 places in all; those of the other pairs may all be in the text.
    places = F.sum("times").over(Window.partitionBy("item_of"))
    return chosen.select("item_of", "seed", "times", (F.col("need") - F.col("n") + places).alias("least"))


def _rows_of(df: DataFrame, marks: np.ndarray, lengths: list[int]) -> DataFrame:
    """(of, n, seed, at, words): the first place in each text of each run of n words that is marked
    (bit n of the entry). ``df`` has (of, words)."""
    def run(batches):
        for batch in batches:
            out = ([], [], [], [], [])
            for of, words in zip(batch.column(0).to_pylist(), _lists(batch.column(1)), strict=True):
                for n in lengths:
                    seeds = ngrams(words, n)
                    places = np.flatnonzero(marks[seeds & (BITMAP - 1)] & (1 << n))
                    for at in places[np.unique(seeds[places], return_index=True)[1]].tolist():
                        for store, value in zip(out, (of, n, int(seeds[at]), at, words[at:at + n]), strict=True):
                            store.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["of", "n", "seed", "at", "words"])

    return df.mapInArrow(run, "of long, n int, seed long, at long, words array<long>")


def _short_matches(docs: DataFrame, short: DataFrame) -> DataFrame | None:
    """Texts (of, words) that hold an item of ``short`` (item_of, item_words) word by word, as the
    rows of ``_aligned``; None if there is no such item."""
    lengths = sorted(r["n"] for r in short.select(F.size("item_words").alias("n")).distinct().collect())
    if not lengths:
        return None

    def hashed(batches):
        for batch in batches:
            seeds = [int(ngrams(words, len(words))[0]) for words in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seeds, pa.int64())], names=["item_of", "item_words", "seed"])

    keyed = short.select("item_of", "item_words").mapInArrow(hashed, "item_of long, item_words array<long>, seed long")
    keyed = keyed.withColumn("n", F.size("item_words"))
    entry = F.col("seed").bitwiseAND(F.lit(BITMAP - 1)).cast("int").alias("entry")
    found = keyed.groupBy(entry).agg(F.bit_or(F.pow(F.lit(2), F.col("n")).cast("int")).alias("bits")).toPandas()
    marks = np.zeros(BITMAP, np.uint8)
    marks[found["entry"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.uint8)
    held = _rows_of(docs, marks, lengths).dropDuplicates(["of", "n", "seed"])
    met = join_splittable(held, keyed, ["n", "seed"]).where(F.col("words") == F.col("item_words"))
    return met.select("of", "item_of", F.lit(1.0).alias("score"), F.col("at").alias("first_word"), (F.col("at") + F.col("n")).alias("end_word"))


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int]:
    """Best local alignment: its score, and where in ``text`` it first ends (exclusive). One numpy
    row per item word; runs of gaps along the row are a running maximum."""
    if not len(item) or not len(text):
        return 0.0, 0
    steps = -GAP * np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1)
    best, end = 0.0, 0
    for word in item:
        step = np.where(text == word, MATCH, MISMATCH)
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + step, row[1:] + GAP)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + steps) - steps
        k = int(row.argmax())
        if row[k] > best or (row[k] == best and 0 < k < end):
            best, end = float(row[k]), k
    return best, end


def needed(n: np.ndarray | int, min_score: float) -> np.ndarray:
    """The least whole score that is accepted for an item of n words."""
    return np.ceil(min_score * np.asarray(n) - 1e-9).astype(np.int64)


def best_alignment(item: np.ndarray, text: np.ndarray, min_score: float) -> tuple[float, int, int] | None:
    """(score, first word, end) of the best alignment in the text; None if it scores too little."""
    need = int(needed(len(item), min_score))
    places = np.flatnonzero(np.isin(ngrams(text), ngrams(item)))
    span, best = 2 * len(item) - need, (0.0, 0, 0)
    for a, b in _spans(places[dense(places, need - 1, span)], span):
        lo = max(0, a - span)
        part = text[lo:b + SEED_WORDS + span]
        score, end = align(item, part)
        if score > best[0]:
            _, length = align(item[::-1], part[:end][::-1])
            best = (score, lo + end - length, lo + end)
    return best if best[0] >= need else None


def _aligned(pairs: DataFrame, min_score: float) -> DataFrame:
    """``pairs`` has (of, at, item_of, item_words, words): parts of texts, from word ``at``.
    Returns the pairs whose best alignment scores enough, with its words (end exclusive)."""
    def run(batches):
        for batch in batches:
            out = []
            ofs, ats, item_ofs = (batch.column(c).to_pylist() for c in range(3))
            for r, (item, words) in enumerate(zip(*(_lists(batch.column(c)) for c in (3, 4)), strict=True)):
                if best := best_alignment(item, words, min_score):
                    out.append((ofs[r], item_ofs[r], best[0] / len(item), ats[r] + best[1], ats[r] + best[2]))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names=["of", "item_of", "score", "first_word", "end_word"])

    return pairs.mapInArrow(run, "of long, item_of long, score double, first_word long, end_word long")


def _docs(df: DataFrame, id_column: str, text: str) -> DataFrame:
    body = text_or_empty(F.col(f"`{text}`"))
    return df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.xxhash64(body, F.length(body)).alias("of"), body.alias("body"))


def contaminated(
    df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
    item_column: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE,
    short_items: bool = False,
) -> DataFrame:
    """(id, of, item, score, first_word, end_word): each document text (id and hash of the text)
    that holds a benchmark item, with the best alignment's score (0 to 1) and words.

    - null or empty texts, on either side: no match
    - items of one to four words: no match; with ``short_items`` they match where all their words
      stand in a row, with score 1
    - null ids stay null; rows that repeat id and text are reported once per item, with the best
      score; repeated item ids with different texts are aligned each and the best one is reported
    - ties of the score: the first place; extra columns are ignored
    - a ``min_score`` that a single word of the shortest item reaches: ValueError
    """
    if needed(LEAST_WORDS, min_score) < 2:
        raise ValueError(f"min_score {min_score} is too low for seeds of {SEED_WORDS} words")
    items = benchmark.select(
        F.col(f"`{item_column}`").cast("long").alias("item"),
        F.xxhash64(text_or_empty(F.col(f"`{item_text}`"))).alias("item_of"),
        word_hashes(text_or_empty(F.col(f"`{item_text}`"))).alias("item_words"))
    # Item texts are found by their hash; the ids, which may be null, are put to them at the end.
    names, items = items.select("item", "item_of").distinct(), items.select("item_of", "item_words").dropDuplicates(["item_of"])
    short = items.where((F.size("item_words") > 0) & (F.size("item_words") < LEAST_WORDS))
    items = items.where(F.size("item_words") >= LEAST_WORDS)
    need = F.ceil(F.lit(float(min_score)) * F.size("item_words") - F.lit(1e-9)).cast("int")
    items = items.withColumns({"n": F.size("item_words"), "need": need})
    in_class = sum((F.when(F.col("need") >= least, 1).otherwise(0) for least in NEEDS[1:]), F.lit(0))
    items = items.withColumn("class", in_class)
    seeds = _seeds(items.select("item_of", "item_words"), ["item_of"]).join(items.select("item_of", "n", "need", "class"), "item_of")

    # Bounded summaries: at most MOST_ENTRIES pairs of integers, and one row for each class.
    entries = _entries(items.agg(F.sum("n")).first()[0] or 0)
    entry = F.col("seed").bitwiseAND(F.lit(entries - 1)).cast("int").alias("entry")
    found = seeds.groupBy(entry).agg(F.bit_or(F.pow(F.lit(2), F.col("class")).cast("int")).alias("bits")).toPandas()
    marks = np.zeros(entries, np.uint16)
    marks[found["entry"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.uint16)
    sizes = items.groupBy("class").agg(F.min("need").alias("least"), F.max(2 * F.col("n") - F.col("need")).alias("span")).collect()
    classes = [(r["class"], r["least"] - 1, r["span"]) for r in sizes]

    docs = _docs(df, id_column, text)
    # Read twice below; the pass over the corpus that makes it is run once.
    path = scratch_path(df.sparkSession, "stretches")
    parts = _stretches(docs.select("of", word_hashes(F.col("body")).alias("words")), marks, classes)
    parts.dropDuplicates(["of", "at"]).write.parquet(path)
    parts = df.sparkSession.read.parquet(path)
    shared = _seeds(parts.select("of", "at", "words"), ["of", "at"]).drop("times")
    rare = _rarest(seeds, shared.groupBy("seed").agg(F.count(F.lit(1)).alias("held")))
    met = join_splittable(shared, rare, ["seed"])
    pairs = met.groupBy("of", "at", "item_of").agg(F.sum("times").alias("shared"), F.max("least").alias("least"))
    pairs = pairs.where("shared >= least").select("of", "at", "item_of")
    ready = pairs.join(parts, ["of", "at"]).join(items, "item_of").select("of", "at", "item_of", "item_words", "words")
    scored = _aligned(ready, min_score)
    whole = _short_matches(docs.select("of", word_hashes(F.col("body")).alias("words")), short) if short_items else None
    scored = (scored if whole is None else scored.unionByName(whole)).join(names, "item_of")
    best = F.max_by(F.struct("first_word", "end_word"), F.struct("score", -F.col("first_word")))
    found = scored.groupBy("of", "item").agg(F.max("score").alias("score"), best.alias("at"))
    ids = docs.select("id", "of").distinct()
    return ids.join(found, "of").select("id", "of", "item", "score", "at.first_word", "at.end_word")


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` without the rows whose text holds a benchmark item; its columns are kept."""
    held = contaminated(df, benchmark, id_column, text, **options).select("id", "of").distinct()
    body = text_or_empty(F.col(f"`{text}`"))
    same = F.col(f"`{id_column}`").cast("long").eqNullSafe(held["id"]) & (F.xxhash64(body, F.length(body)) == held["of"])
    return df.join(held, same, "left_anti")


def op5_seeded_alignment(spark, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it holds."""
    found = contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"), short_items=True)
    return found.groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id")).agg(
        F.max("score").alias("score"), F.min_by("first_word", -F.col("score")).alias("first_word"),
        F.min_by("end_word", -F.col("score")).alias("end_word"))
