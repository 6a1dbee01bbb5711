"""Collocations by best-first branch and bound over phrase prefixes.

Texts are cut at punctuation and line ends into pieces and these into words. ``f`` counts a
phrase's occurrences within pieces; a candidate has 2 to 4 words and ``f >= LEAST``; its score is
that of its worst cut, ``floor(SCALE * a / (l + r))`` with a = f(phrase), l and r = f of the first
and the second part. Everything is per language, and each language's best ``TOP`` are wanted.

Phrases grow word by word from their prefix. With p a prefix (of first word w) and c any phrase
that begins with it, the cut after w gives ``score(c) <= SCALE * a / (f(w) + r)``, and as
``a <= f(p)`` and ``r >= a``, no growth of p can score above

    bound(p) = floor(SCALE * f(p) / (f(w) + f(p))).

So p is grown only while its bound reaches the score that the language's last result must have.
That score (the floor) starts at the score of the ``FIRST``-th best pair of words; when fewer than
``TOP`` candidates above the floor survive, the language goes on with a lower floor, at last with 0.
A language is settled when ``TOP`` survivors reach the floor: whatever was not grown scores below
it, so the result, ties included, is what counting everything would give.

A candidate goes when a longer one holds it and is nearly as frequent. If any longer one does, the
one-word extension within that does too, so next to the growths the extensions of the candidates
above the floor are counted, to the right (growths) and to the left; and for the cut after the
first word of grown phrases of four, what its remaining three words have.

Each level is one pass over the texts. A task counts in its own dictionary, so a phrase that holds
a third of all occurrences reaches the shuffle once per task and lot; sums are exact, on the
phrases themselves. Which phrases a pass must count is told by bitmaps over hashes of words and
prefixes. They are of bounded size; a bit that is set by chance makes a task count a phrase too
many, never one too few.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeshift.llm.common import join_splittable, table
from lakeshift.session import scratch_path

LEAST = 30
LONGEST = 4
SCALE = 2_000_000
TOP = 2000
#: A longer candidate with this percentage of the occurrences takes the place of what it holds.
WITHIN = 80
#: The first floor is the score of this pair of words, the next ones of four times as many.
FIRST = 3000
UNKNOWN = "und"

#: Bits of a bitmap per entry, and the largest bitmap (16 MB).
BITS_PER_ENTRY = 16
BITMAP_BITS = 1 << 27
#: Words counted in one dictionary, and bytes split at once.
LOT_WORDS = 2_500_000
SLICE = 2_000_000
#: Places whose hashes are looked up at once.
PLACES = 500_000

BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK, NONE = 1, 0
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b"\t" + BREAKS, bytes(range(97, 123)) + b" " + b"\n" * len(BREAKS))


class Words(dict):
    """Numbers of words in order of appearance; the empty word is 0, a break 1."""

    def __init__(self) -> None:
        super().__init__({b"": NONE, b"\n": BREAK})

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at

    def read(self, texts: bytes) -> np.ndarray:
        tokens = texts.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))
        return ids[ids != NONE]


# --- bitmaps ----------------------------------------------------------------------------------


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def fold(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one more word (unsigned 64-bit arrays)."""
    h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


@dataclass
class Bitmap:
    """A set of (language, phrase); it may hold others by chance, but misses none."""

    bits: np.ndarray

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(len(self.bits) * 64 - 1)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _size(entries: int) -> int:
    """Bits for a number of entries, a power of two."""
    return min(BITMAP_BITS, 1 << max(12, (BITS_PER_ENTRY * entries).bit_length()))


def bitmap(phrases: DataFrame, size: int) -> Bitmap:
    """The bitmap of the rows (lang, phrase). Words of the bitmap that have a bit reach the driver:
    at most ``size / 64`` numbers."""
    kind = T.StructType([T.StructField("slot", T.LongType()), T.StructField("bits", T.LongType())])
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros(size // 64, np.uint64)
            by_length: dict[int, list] = {}
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = phrase.encode().split(b" ")
                by_length.setdefault(len(words), []).append((word_hash(lang.encode()), *map(word_hash, words)))
            for rows in by_length.values():
                columns = np.array(rows, np.uint64).T
                h = columns[0]
                for word in columns[1:]:
                    h = fold(h, word)
                at = h & np.uint64(size - 1)
                np.bitwise_or.at(bits, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
            slots = np.flatnonzero(bits)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(bits[slots].view(np.int64))], schema=schema)

    found = phrases.select("lang", "phrase").mapInArrow(run, kind).groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Bitmap(bits)


# --- counting ---------------------------------------------------------------------------------


@dataclass
class Wanted:
    """Which phrases of ``length`` words a pass counts. Conditions are (start, length, bitmap) on
    parts of the phrase: all of ``every`` and, if there are any, one of ``some`` must hold."""

    length: int
    every: Sequence[tuple[int, int, Bitmap]] = ()
    some: Sequence[tuple[int, int, Bitmap]] = ()


COUNTS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()), T.StructField("a", T.LongType())])


def _places(ids: np.ndarray, hashes: np.ndarray | None, lang: int, want: Wanted) -> np.ndarray:
    """Where a wanted phrase begins."""
    n = len(ids) - want.length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    fine = np.ones(n, bool)
    for j in range(want.length):
        fine &= ids[j: j + n] != BREAK
    for start, length, known in want.every:
        if length == 1:  # looked up once per word, not per place
            fine &= known.has(fold(np.full(len(hashes), lang, np.uint64), hashes))[ids[start: start + n]]
    places = np.flatnonzero(fine)
    every = [c for c in want.every if c[1] > 1]
    if not every and not want.some:
        return places

    def held(condition: tuple[int, int, Bitmap], at: np.ndarray) -> np.ndarray:
        start, length, known = condition
        h = np.full(len(at), lang, np.uint64)
        for j in range(start, start + length):
            h = fold(h, hashes[ids[at + j]])
        return known.has(h)

    kept = []
    for lo in range(0, len(places), PLACES):
        at = places[lo: lo + PLACES]
        for condition in every:
            at = at[held(condition, at)]
        if want.some and len(at):
            at = at[np.logical_or.reduce([held(c, at) for c in want.some])]
        kept.append(at)
    return np.concatenate(kept) if kept else places


def _tally(ids: np.ndarray, places: np.ndarray, length: int, n_words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Word numbers (one array per position) and counts of the different phrases at places."""
    if length == 1:
        counts = np.bincount(ids[places], minlength=n_words)
        found = np.flatnonzero(counts)
        return [found], counts[found]
    levels, code = [], ids[places].astype(np.int64)
    for j in range(1, length):
        if j > 1:
            values, code = np.unique(code, return_inverse=True)
            levels.append(values)
        code = code * n_words + ids[places + j]
    code, counts = np.unique(code, return_counts=True)
    words = []
    for j in range(length - 1, 0, -1):
        words.append(code % n_words)
        code = code // n_words
        if levels:
            code = levels.pop()[code]
    return [code, *reversed(words)], counts


def _count(batches: Iterator[pa.RecordBatch], wants: Sequence[Wanted], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Counts per lot of texts: (lang, phrase, a); with phrases of one word also (lang, null, words)."""
    words, read, waiting, size, total = Words(), {}, {}, 0, 0

    def split() -> int:
        n = 0
        for lang, texts in waiting.items():
            ids = words.read(b"\n".join(texts) + b"\n")
            read.setdefault(lang, []).append(ids)
            n += len(ids)
        waiting.clear()
        return n

    def flush() -> Iterator[pa.RecordBatch]:
        names = pa.array(list(words), pa.binary()).cast(pa.string())
        hashes = None
        if any(w.every or w.some for w in wants):
            hashes = np.fromiter(map(word_hash, words), np.uint64, len(words))
        for lang, parts in read.items():
            ids = np.concatenate(parts)
            seed = word_hash(lang.encode())
            for want in wants:
                places = _places(ids, hashes, seed, want)
                if want.length == 1:
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([len(places)])], schema=schema)
                found, counts = _tally(ids, places, want.length, len(words))
                for at in range(0, len(counts), 500_000):
                    cut = [names.take(pa.array(w[at: at + 500_000])) for w in found]
                    phrase = pc.binary_join_element_wise(*cut, " ") if len(cut) > 1 else cut[0]
                    n = pa.array(counts[at: at + 500_000].astype(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(n)), phrase, n], schema=schema)

    rows = (batch.slice(at, 500) for batch in batches for at in range(0, batch.num_rows, 500))
    for batch in rows:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if not text:
                continue
            waiting.setdefault(UNKNOWN if lang is None else lang, []).append(text)
            size += len(text)
            if size >= SLICE:
                total += split()
                size = 0
                if total >= LOT_WORDS:
                    yield from flush()
                    words, read, total = Words(), {}, 0
    split()
    if read:
        yield from flush()


def _pass(docs: DataFrame, wants: Sequence[Wanted], least: int) -> DataFrame:
    """One pass over the texts: (lang, phrase, a) of the wanted phrases with ``a >= least`` (and
    the totals of single words), written to the shared folder."""
    spark = docs.sparkSession
    schema = to_arrow_schema(COUNTS)
    held = spark.sparkContext.broadcast(list(wants))
    path = scratch_path(spark, "phrases")
    counted = docs.mapInArrow(lambda b: _count(b, held.value, schema), COUNTS)
    summed = counted.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    summed.where((F.col("a") >= least) | F.col("phrase").isNull()).write.parquet(path)
    return spark.read.parquet(path)


# --- scores -----------------------------------------------------------------------------------


def _ratio(a: Column, other: Column) -> Column:
    """``floor(SCALE * a / other)``; exact, in decimals."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(a) * F.lit(SCALE).cast("decimal(8,0)"), wide(other))


def score(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` (lang, phrase, a) plus l, r and score of the lowest-scoring cut (ties: the first
    cut) and ``bound``; ``known`` has the counts of their parts. A phrase with a part that is not
    known is left out: its bound is below the floor (it was counted for another reason)."""
    words = F.split("phrase", " ")
    cuts = found.select("lang", "phrase", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", (F.size("w") - 1).alias("n_cuts"),
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right"))
    part = lambda side, n: known.select("lang", F.col("phrase").alias(side), F.col("a").alias(n))
    cuts = join_splittable(cuts, part("left", "l"), ["lang", "left"])
    cuts = join_splittable(cuts, part("right", "r"), ["lang", "right"])
    wide = F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)")
    cuts = cuts.withColumn("cut", F.struct(_ratio(F.col("a"), wide).cast("long").alias("score"), "k", "l", "r"))
    best = cuts.groupBy("lang", "phrase", "a", "n_cuts").agg(
        F.min("cut").alias("cut"), F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("k") == 1, F.col("l"))).alias("first"))
    whole = F.col("first").cast("decimal(20,0)") + F.col("a").cast("decimal(20,0)")
    return best.where(F.col("n") == F.col("n_cuts")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score", _ratio(F.col("a"), whole).cast("long").alias("bound"))


def _parts(phrases: DataFrame) -> DataFrame:
    """For every phrase the two that lack its first or its last word: lang, part, a."""
    words = F.split("phrase", " ")
    both = F.array(
        F.array_join(F.slice(words, F.lit(2), F.size(words) - 1), " "), F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "))
    return phrases.select("lang", F.explode(F.array_distinct(both)).alias("part"), F.col("a"))


def survivors(candidates: DataFrame, longer: DataFrame, within: int) -> DataFrame:
    """Candidates that no phrase of ``longer`` (all their one-word extensions) takes the place of."""
    held = _parts(longer).groupBy("lang", F.col("part").alias("phrase")).agg(F.max("a").alias("outer"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    joined = candidates.join(held, ["lang", "phrase"], "left")
    return joined.where(F.coalesce(wide("outer") * 100 < wide("a") * within, F.lit(True))).drop("outer")


def _ranked(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each language; partitions cut their rows before the shuffle."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    top: int = TOP,
    least: int = LEAST,
    within: int = WITHIN,
    first: int = FIRST,
) -> DataFrame:
    """The best ``top`` collocations of each language: lang, rank (from 1), phrase (words joined by
    a space), a, l, r, n (words of the language) and score, all numbers long.

    - A-Z are lower-cased; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words at space and tab
    - order: score descending, a descending, phrase ascending by its UTF-8 bytes
    - null text: empty; null language: ``und``; repeated rows count each; ids are not read
    - a very long text is read whole; an empty table, or one without candidates, gives no row
    - ``first`` changes the number of passes, not the result
    """
    spark = df.sparkSession
    docs = df.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    ones = _pass(docs, [Wanted(1)], least)
    totals = ones.where("phrase IS NULL").select("lang", F.col("a").alias("n"))
    ones = ones.where("phrase IS NOT NULL")
    common = bitmap(ones, _size(ones.count()))
    twos = _pass(docs, [Wanted(2, every=[(0, 1, common), (1, 1, common)])], least)
    size = _size(twos.count())
    pairs = bitmap(twos, size)
    path = scratch_path(spark, "phrase-pairs")
    score(twos, ones).write.parquet(path)
    scored = spark.read.parquet(path)

    open_ = scored.select("lang").distinct()
    results = []
    while True:
        # The score of each open language's pair number `first`, or 0 where there are fewer.
        floors = _ranked(scored, first).where(F.col("rank") == first).select("lang", F.col("score").alias("floor"))
        floors = open_.join(floors, "lang", "left").select("lang", F.coalesce("floor", F.lit(0)).alias("floor"))
        path = scratch_path(spark, "phrase-floors")
        floors.write.parquet(path)
        floors = spark.read.parquet(path)
        reach = lambda rows, what: rows.join(floors, "lang").where(F.col(what) >= F.col("floor"))

        frontier, best = reach(scored, "bound"), reach(scored, "score")
        threes = _pass(docs, [Wanted(
            3, every=[(0, 2, pairs), (1, 2, pairs)], some=[(0, 2, bitmap(frontier, size)), (1, 2, bitmap(best, size))])], least)
        path = scratch_path(spark, "phrase-threes")
        score(threes, ones.unionByName(twos)).write.parquet(path)
        scored3 = spark.read.parquet(path)

        frontier3, best3 = reach(scored3, "bound"), reach(scored3, "score")
        rests = frontier3.select("lang", F.substring_index("phrase", " ", -2).alias("phrase")).distinct()
        rests = rests.join(frontier.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
        size3 = _size(scored3.count())
        more = _pass(docs, [
            Wanted(4, every=[(0, 2, pairs), (1, 2, pairs), (2, 2, pairs)],
                   some=[(0, 3, bitmap(frontier3, size3)), (1, 3, bitmap(best3, size3))]),
            Wanted(3, every=[(0, 2, pairs), (1, 2, pairs), (0, 2, bitmap(rests, size3))])], least)
        length = F.size(F.split("phrase", " "))
        fours = more.where(length == 4)
        known = ones.unionByName(twos).unionByName(threes.unionByName(more.where(length == 3)).distinct())
        scored4 = score(fours, known)

        reached = reach(scored.unionByName(scored3).unionByName(scored4), "score")
        path = scratch_path(spark, "phrase-survivors")
        survivors(reached, threes.unionByName(fours), within).write.parquet(path)
        left = spark.read.parquet(path)
        done = floors.join(left.groupBy("lang").agg(F.count(F.lit(1)).alias("n_left")), "lang", "left").select(
            "lang", ((F.col("floor") == 0) | (F.coalesce("n_left", F.lit(0)) >= top)).alias("settled"))
        results.append(_ranked(left.join(done.where("settled").select("lang"), "lang"), top))
        open_ = done.where(~F.col("settled")).select("lang")
        if open_.isEmpty():
            break
        first *= 4

    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: each language's best 2000 collocations."""
    return collocations(table(spark, sf_dir, "documents"))


#: Counting all phrases of up to four words.
ORACLE_OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
f AS MATERIALIZED (
  SELECT lang, k, w[i:i + k - 1] AS p, count(*) AS a
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY lang, k, p),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, p, array_to_string(p, ' ') AS phrase, a FROM f WHERE k > 1 AND a >= 30),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.cut, c.a, x.a AS l, y.a AS r,
         CAST(2000000 AS HUGEINT) * c.a // (CAST(x.a AS HUGEINT) + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.k = c.cut AND x.p = c.p[1:c.cut]
              JOIN f y ON y.lang = c.lang AND y.k = c.k - c.cut AND y.p = c.p[c.cut + 1:c.k]),
worst AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS turn FROM scored),
left_over AS (
  SELECT * FROM worst WHERE turn = 1 AND NOT EXISTS (
    SELECT 1 FROM candidates e WHERE e.lang = worst.lang AND e.phrase <> worst.phrase
      AND contains(' ' || e.phrase || ' ', ' ' || worst.phrase || ' ') AND 100 * e.a >= 80 * worst.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
