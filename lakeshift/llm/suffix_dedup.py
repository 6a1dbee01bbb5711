"""Removal of long byte strings that occur more than once, through a column-wise collection BWT.

**What meets.** Two places share a string of ``LENGTH`` bytes. In such a window, the 32-byte gram
with the smallest hash is its *anchor*; equal windows have equal anchors at equal offsets. Consecutive
windows with the same anchor form a segment (its windows' bytes). Only segments with equal anchors can
share a window, so segments are what is dealt out, by the hash of their anchor. Anchors that occur
once are done. Equal segments are counted, and all others go through the index: each different segment
around an anchor is a document of the collection, once, with the number of its copies.

**Hot anchors** (a passage in a third of all documents, each time in other surroundings) would bring
very many different segments to one task. Anchors with more than ``GROUP`` of them are parted
instead: a segment's windows are dealt into eight parts, by their distance from the anchor, and each
part gets a more exact anchor, the bytes that all its windows have in common. That is repeated for
parts that are still too many, three times at most; with one window to a part, equal anchors are
equal parts. Nothing is left out, and no group grows with the data.

**The index** (Bauer, Cox and Rosone, "Lightweight algorithms for constructing and inverting the BWT
of string collections", 2013; common prefixes from the BWT as in Beller, Gog, Ohlebusch and Schnattinger, "Computing
the longest common prefix array based on the Burrows-Wheeler transform", 2013). Each segment gives one document per phase, whose symbols are its blocks of ``BLOCK`` bytes
from that phase on, so that every byte position begins a suffix. Round by round, one symbol per
document is put in front: the symbol is entered in the BWT at the place
of the suffix that it extends, and the BWT alone says where the longer suffix goes: after all smaller
symbols, and after as many equal ones as stand before that place. Old and new columns are merged in one sequential
pass. Which suffix stands where, and its common prefix with the one before, are read once from the finished BWT, as
each of its symbols leads to the suffix that begins with it: neighbours that begin with the same symbol share
one more than their rests do. A window occurs elsewhere when its document has copies, or when its suffix shares
LENGTH / BLOCK symbols with a neighbour in the list. Symbols are equal only where the bytes are: each
block is compared with the first one of its symbol.

The published method keeps the columns in external files because the collection is one. Here the
collection is dealt out, a batch of whole anchors at a time, so the columns of a batch are arrays of a
task, and nothing is written to a machine's own disk; a lost task rebuilds its batch from the shuffle.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.llm.common import table, text_or_empty
from lakeshift.llm.jaccard import _mix
from lakeshift.session import scratch_path

LENGTH = 400
GRAM = 32
BLOCK = 100
#: Segments are indexed in batches of whole anchors of about this many bytes.
BATCH = 1 << 19
#: Anchors with more different segments than this are parted.
GROUP = 1000
PARTS = 8
#: Longer texts are cut into parts of this many windows; a cut only parts a segment in two.
PART = 1 << 22
#: Short texts are scanned together, up to about this many bytes.
TOGETHER = 1 << 16

_rng = np.random.default_rng(400)
_BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_rng.integers(1 << 61, 1 << 62)) * 2 + 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


class _Hashes:
    """Hashes of any substring of a byte array, from sums of bytes times powers."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up[:-1], out=self.sums[1:])

    def of(self, start, stop) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.down[start])

    def all(self, length: int) -> np.ndarray:
        """The hash of every substring of a length."""
        return _mix((self.sums[length:] - self.sums[:-length]) * self.down[:len(self.sums) - length])


def _window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Minima of all w consecutive values: of 2, 4, 8 ... values, then two overlapping ranges."""
    span = 1
    while 2 * span <= w:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    return np.minimum(x[:len(x) - (w - span)], x[w - span:]) if w > span else x


def segments(
    data: np.ndarray, length: int = LENGTH, gram: int = GRAM, stops: np.ndarray | None = None,
) -> tuple[np.ndarray, ...]:
    """(anchor, content, start, stop, at) of a text's segments; content is a hash of the bytes, at
    the anchor's place. With ``stops``, data holds texts one after another, up to these places each;
    no segment reaches into another text."""
    found: list[tuple[np.ndarray, ...]] = []
    stops = np.array([len(data)]) if stops is None else stops
    begins = np.r_[0, stops[:-1]]
    long = stops - begins >= length
    edges = np.concatenate([begins[long], stops[long] - length + 1])  # where a text's windows begin and end
    for lo in range(0, len(data) - length + 1, PART):
        part = data[lo:lo + PART + length - 1]
        hashes = _Hashes(part)
        grams = hashes.all(gram)
        low = np.uint64((1 << 24) - 1)
        # The smallest upper bits decide; among equal ones the leftmost gram of the window.
        least = _window_minima((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        new[edges[(edges >= lo) & (edges < lo + len(least))] - lo] = True
        begin = np.flatnonzero(new)
        stop = np.r_[begin[1:], len(least)] + length - 1
        at = (least[begin] & low).astype(np.int64)
        if len(stops) > 1:
            inside = stop + lo <= stops[np.searchsorted(stops, begin + lo, side="right")]
            begin, stop, at = begin[inside], stop[inside], at[inside]
        content = hashes.of(begin, stop) ^ (stop - begin).astype(np.uint64)
        found.append((grams[at].view(np.int64), content.view(np.int64), begin + lo, stop + lo, at + lo))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def part(data: bytes, anchor: int, start: int, at: int, lo: int, hi: int, length: int = LENGTH) -> list[tuple]:
    """The parts of a segment, as (anchor, content, start, stop, lo, hi). Windows begin from ``lo``
    to ``hi`` (exclusive) bytes after the anchor's place; parts without a window are left out."""
    hashes, found = _Hashes(np.frombuffer(data, np.uint8)), []
    bounds = sorted({lo + (hi - lo) * k // PARTS for k in range(PARTS + 1)})
    for a, b in zip(bounds, bounds[1:], strict=False):
        first = max(start, at + a)
        last = min(start + len(data) - length, at + b - 1)
        if first > last:
            continue
        core = hashes.of(np.array([at + b - 1 - start]), np.array([at + a + length - start]))
        stop = last + length
        content = hashes.of(np.array([first - start]), np.array([stop - start])) ^ np.uint64(stop - first)
        exact = _mix(core + np.array([anchor]).view(np.uint64) + np.array([a - 2 * length]).view(np.uint64))
        found.append((int(exact.view(np.int64)[0]), int(content.view(np.int64)[0]), first, stop, a, b))
    return found


class CollectionIndex:
    """Sorted suffixes of a collection as columns, built by one symbol per document and round."""

    def __init__(self, depth: int):
        self.depth = depth  # common prefixes are counted up to here

    def build(self, codes: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        """``codes``: the symbol at each suffix; ``rest``: the suffix after it (-1: the document's
        end); ``counts``: symbols of each suffix. Leaves ``who`` (which suffix; -1: a document's
        end), ``bwt`` and ``common`` in sorted order."""
        n = int((rest < 0).sum())
        self.bwt = np.full(n, -1, np.int32)
        self.held = np.empty(0, np.int64)
        place = np.empty(len(codes), np.int64)
        most = counts.max(initial=0)
        by_count = np.argsort(counts.astype(np.uint16) if most < 1 << 16 else counts, kind="stable")  # short integers: radix sort
        bounds = np.searchsorted(counts[by_count], np.arange(1, most + 2))
        rounds = [by_count[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
        for k, new in enumerate(rounds):
            x = place[rest[new]] if k else np.arange(n)  # suffixes of one symbol extend the ends
            order = np.argsort(codes[new] * (len(self.bwt) + 1) + x)
            place[new[order]] = self._merge(n, codes[new[order]], x[order])
        # Each symbol of the finished BWT leads to the place of the suffix that begins with it.
        leads = np.empty(len(self.bwt), np.int64)
        leads[self.held] = np.arange(n, len(self.bwt))
        self.who = np.full(len(self.bwt), -1, np.int64)
        for k, new in enumerate(rounds):
            place[new] = leads[place[rest[new]] if k else np.arange(n)]
            self.who[place[new]] = new
        self._count_common(n)

    def _merge(self, n: int, codes: np.ndarray, x: np.ndarray) -> np.ndarray:
        """One sequential pass that puts the new suffixes, by symbol and place ``x`` of what they
        extend, between the old ones. After the ``n`` ends the list holds one suffix for each symbol
        of the BWT, by symbol and then by place: ``held`` lists these places, and a new one's rank
        in it is its place. Returns the places of the new suffixes."""
        big = len(self.bwt) + 1
        rank = np.searchsorted(self.bwt[self.held] * np.int64(big) + self.held, codes * big + x)
        self.bwt[x] = codes  # the symbol that this round puts before the suffix at x
        to = n + rank + np.arange(len(x))
        is_old = np.ones(len(self.bwt) + len(x), bool)
        is_old[to] = False
        old_to = np.flatnonzero(is_old)
        held = np.empty(len(is_old) - n, np.int64)
        held[old_to[n:] - n], held[to - n] = old_to[self.held], old_to[x]
        bwt = np.full(len(is_old), -1, np.int32)
        bwt[old_to] = self.bwt
        self.held, self.bwt = held, bwt
        return to

    def _count_common(self, n: int) -> None:
        """``common`` from the finished BWT: two neighbours that begin with the same symbol share one
        more than their rests do, and rests share k symbols when no place between them has fewer."""
        self.common = np.zeros(len(self.bwt), np.int8)
        first = self.bwt[self.held]
        at = np.flatnonzero(first[1:] == first[:-1]) + 1  # places after the ends
        for k in range(1, self.depth + 1):
            if k > 1:
                run = np.cumsum(self.common < k - 1, dtype=np.int32)
                at = at[run[self.held[at]] == run[self.held[at - 1]]]
            self.common[n + at] = k


def symbols(data: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    """A number for the bytes of each block that begins at ``at``: equal numbers, equal bytes.
    Numbers follow from hashes, and every block is compared with the first one of its number;
    should two differ, all are numbered by their bytes."""
    hashes = _Hashes(data).of(at, at + block)
    order = np.argsort(hashes)
    starts = np.flatnonzero(np.r_[True, np.diff(hashes[order]) != 0]) if len(at) else order
    codes = np.empty(len(at), np.int64)
    codes[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(at)]))
    # A block whose neighbour to the left is as far from its first one has 99 of 100 bytes compared
    # there already; the others are compared whole.
    head = np.minimum.reduceat(order, starts) if len(at) else order
    away = at - at[head[codes]]
    step = np.zeros(len(at), bool)
    step[1:] = (away[1:] == away[:-1]) & (at[1:] == at[:-1] + 1)
    blocks = np.lib.stride_tricks.sliding_window_view(data, block) if len(at) else data
    again = away != 0
    whole, last = np.flatnonzero(again & ~step), at[again & step] + block - 1
    equal = np.array_equal(data[last], data[last - away[again & step]])
    for lo in range(0, len(whole) if equal else 0, 1 << 14):
        some = at[whole[lo:lo + (1 << 14)]]
        equal = equal and np.array_equal(blocks[some], blocks[some - away[whole[lo:lo + (1 << 14)]]])
    return codes if equal else np.unique(blocks[at], axis=0, return_inverse=True)[1].reshape(-1).astype(np.int64)


def shared_windows(
    parts: list[bytes], length: int = LENGTH, block: int = BLOCK, copies: list[int] | None = None,
) -> list[np.ndarray]:
    """For each byte string which of its windows of ``length`` bytes occur at another place of the
    collection, as a boolean per start. ``copies``: how often each string is in the collection."""
    sizes = np.array([len(p) for p in parts], np.int64)
    hit = _hits(np.frombuffer(b"".join(parts), np.uint8), sizes, length, block, copies)
    return [hit[stop - size:max(stop - size, stop - length + 1)] for stop, size in zip(np.cumsum(sizes), sizes, strict=True)]


def _hits(data: np.ndarray, sizes: np.ndarray, length: int, block: int, copies=None) -> np.ndarray:
    """``shared_windows`` of byte strings that stand one after another, as one boolean per byte; false
    where no window begins."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    valid = np.flatnonzero(left >= block)  # positions that begin at least one whole block
    codes = symbols(data, valid, block)
    counts = left[valid] // block
    rest = np.where(counts > 1, np.arange(len(valid)) + block, -1)  # a string's valid positions have no gap
    depth = length // block
    index = CollectionIndex(depth)
    index.build(codes, rest, counts)
    deep = index.common >= depth
    deep[:-1] |= deep[1:]
    hit = np.zeros(len(data), bool)
    hit[valid[index.who[deep]]] = True  # ends share nothing, so none of them is deep
    if copies is not None:
        hit |= np.repeat(np.asarray(copies) > 1, sizes) & (left >= length)
    return hit


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, one value after another, and where each ends."""
    if not len(column):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    places = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[places[0]:places[-1]], places[1:] - places[0]


def _spans(hit: np.ndarray, length: int, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, lo, hi): maximal byte runs covered by windows that start where ``hit`` is true, of rows
    that stand one after another up to ``stops``; lo and hi count from the row's begin."""
    starts = np.flatnonzero(hit)
    row = np.searchsorted(stops, starts, side="right")
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] - starts[:-1] > length) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(starts)] - 1 if len(first) else first
    begin = np.r_[0, stops][row[first]]
    return row[first], starts[first] - begin, starts[last] + length - begin


FOUND = "id long, of long, anchor long, content long, start long, stop long, at long, lo int, hi int"


def _scan(docs: DataFrame, length: int) -> DataFrame:
    """The segments of all texts, with the range of window starts around the anchor (lo, hi)."""
    def run(batches):
        for batch in batches:
            data, stops = _bytes_of(batch.column(2))
            begins, columns, k = np.r_[0, stops], [[] for _ in range(6)], 0
            while k < len(stops):
                lo = begins[k]
                next_ = max(k + 1, int(np.searchsorted(stops, lo + TOGETHER, side="right")))
                anchor, content, start, stop, at = segments(data[lo:stops[next_ - 1]], length, stops=stops[k:next_] - lo)
                row = np.searchsorted(stops, start + lo, side="right")
                shift = begins[row] - lo
                for store, values in zip(columns, (row, anchor, content, start - shift, stop - shift, at - shift), strict=True):
                    store.append(values)
                k = next_
            if columns[0]:
                row, *rest = (np.concatenate(c) for c in columns)
                at, n = pa.array(row), len(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c) for c in rest),
                     pa.array(np.full(n, GRAM - length, np.int32)), pa.array(np.ones(n, np.int32))],
                    names=[f.split()[0] for f in FOUND.split(", ")])

    return docs.mapInArrow(run, FOUND)


def _parted(rows: DataFrame, length: int) -> DataFrame:
    """Rows of FOUND with their bytes (``data``) as rows of the same columns for their parts."""
    names = [*(f.split()[0] for f in FOUND.split(", ")), "data"]
    kinds = {n: pa.int32() if n in ("lo", "hi") else pa.binary() if n == "data" else pa.int64() for n in names}

    def run(batches):
        for batch in (b.slice(k, 500) for b in batches for k in range(0, b.num_rows, 500)):
            out = []
            for r in batch.to_pylist():
                for anchor, content, start, stop, lo, hi in part(r["data"], r["anchor"], r["start"], r["at"], r["lo"], r["hi"], length):
                    out.append({"id": r["id"], "of": r["of"], "anchor": anchor, "content": content, "start": start, "stop": stop,
                                "at": r["at"], "lo": lo, "hi": hi, "data": r["data"][start - r["start"]:stop - r["start"]]})
            yield pa.RecordBatch.from_arrays([pa.array([o[n] for o in out], kinds[n]) for n in names], names=names)

    return rows.mapInArrow(run, FOUND + ", data binary")


def _with_bytes(places: DataFrame, docs: DataFrame) -> DataFrame:
    """``places`` (id, of, cuts: array of structs with start and stop) unfolded, with the bytes
    between start and stop as ``data``. Rows that repeat id and text bring each cut again."""
    texts = places.alias("w").join(docs.alias("d"), F.col("w.id").eqNullSafe(F.col("d.id")) & (F.col("w.of") == F.col("d.of")))
    cuts = texts.select("w.id", "w.of", "data", F.inline("cuts"))
    return cuts.withColumn("data", F.expr("substring(data, cast(start + 1 as int), cast(stop - start as int))"))


def _indexed(parts: DataFrame, length: int, block: int, batch_bytes: int) -> DataFrame:
    """``parts`` has (anchor, content, n, least, data): a segment, how often it occurs, and the least
    such number around its anchor. Rows of an anchor are together, unless all of them have copies.
    Returns the covered spans (lo, hi) of each part in which a window occurs elsewhere."""
    def run(batches):
        def solve(batch):
            data, stops = _bytes_of(batch.column(4))
            hit = _hits(data, np.diff(stops, prepend=0), length, block, batch.column(2).to_numpy())
            row, lo, hi = _spans(hit, length, stops)
            rows, counts = np.unique(row, return_counts=True)
            pairs = pa.StructArray.from_arrays([pa.array(lo), pa.array(hi)], names=["lo", "hi"])
            spans = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pairs)
            at = pa.array(rows, pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), spans], names=["anchor", "content", "spans"])

        rest = None
        for batch in batches:
            batch = batch if rest is None else pa.concat_batches([rest, batch])
            anchor, least, stops = batch.column(0).to_numpy(), batch.column(3).to_numpy(), _bytes_of(batch.column(4))[1]
            # Where all have copies, no window depends on what else is in the batch.
            may_begin = np.flatnonzero((anchor[1:] != anchor[:-1]) | (least[1:] > 1)) + 1
            size, lo = stops[may_begin - 1], 0
            while (k := np.searchsorted(size, (stops[lo - 1] if lo else 0) + batch_bytes)) < len(size):
                yield solve(batch.slice(lo, may_begin[k] - lo))
                lo = may_begin[k]
            rest = batch.slice(lo)
        if rest is not None and rest.num_rows:
            yield solve(rest)

    return parts.mapInArrow(run, "anchor long, content long, spans array<struct<lo:long,hi:long>>")


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, block: int = BLOCK, batch_bytes: int = BATCH, group: int = GROUP,
) -> DataFrame:
    """(id, of, spans) of the texts in which a string of ``length`` bytes occurs that also starts
    elsewhere; spans (lo, hi) may overlap. ``docs`` has (id, of, data): an id, a hash of the text,
    the bytes."""
    if length % block or block <= 0:
        raise ValueError("length must be a multiple of block")
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    found = written(_scan(docs.select("id", "of", "data"), length), "segments")
    covered = None
    while True:  # once, and once more for each time that hot anchors are parted
        # Per content: how often, and one place to read it from. Anchors that occur once are done.
        sums = found.groupBy("anchor", "content").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "of", "start", "stop", "lo", "hi")).alias("head"))
        anchors = sums.groupBy("anchor").agg(
            F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"), F.sum("n").alias("total")).where("total > 1")
        contents = written(sums.join(anchors, "anchor"), "contents")
        hot = (F.col("kinds") > group) & (F.col("least") == 1) & (F.col("head.hi") - F.col("head.lo") > 1)
        now = _covered(found, docs, contents.where(~hot), length, block, batch_bytes)
        covered = now if covered is None else covered.unionByName(now)
        anchors = contents.where(hot).select("anchor").distinct()
        if anchors.isEmpty():
            break
        rows = found.join(anchors, "anchor")
        if "data" not in found.columns:
            # The bytes of hot segments are read once and stay with their rows from here on. Rows
            # of the table that are equal come once in ``places`` and as often as they are from
            # the join, so that counts stay right.
            places = rows.groupBy("id", "of").agg(
                F.collect_set(F.struct("anchor", "start", "stop", "at", "lo", "hi")).alias("cuts"))  # at most a text's segments
            rows = _with_bytes(places, docs)
        found = written(_parted(rows, length), "segments")
    return covered.groupBy("id", "of").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))  # at most one per segment


def _covered(found: DataFrame, docs: DataFrame, contents: DataFrame, length: int, block: int, batch_bytes: int) -> DataFrame:
    """(id, of, lo, hi): bytes covered by windows that occur elsewhere, for the contents given."""
    known = contents.select("anchor", "content", "n", "least")
    if "data" in found.columns:
        bytes_ = found.join(known.select("anchor", "content"), ["anchor", "content"])
    else:
        bytes_ = _with_bytes(contents.groupBy("head.id", "head.of").agg(
            F.collect_list(F.struct("anchor", "content", "head.start", "head.stop")).alias("cuts")), docs)  # at most a text's segments
    # Equal parts come from many rows, or from rows that repeat id and text; one of each is kept, on
    # the mapper's side first.
    parts = bytes_.groupBy("anchor", "content").agg(F.any_value("data").alias("data"))
    parts = parts.join(known, ["anchor", "content"]).select("anchor", "content", "n", "least", "data")
    parts = parts.repartition("anchor", F.when(F.col("least") > 1, F.col("content"))).sortWithinPartitions("anchor")
    spans = _indexed(parts, length, block, batch_bytes)
    return (
        found.select("id", "of", "anchor", "content", "start").join(spans, ["anchor", "content"])
        .select("id", "of", "start", F.inline("spans"))
        .select("id", "of", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi")))


def remove_repeats(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH,
    block: int = BLOCK, batch_bytes: int = BATCH, group: int = GROUP,
) -> DataFrame:
    """Each row's id (as ``id_column``), ``n_bytes``, ``n_removed``, ``spans`` (maximal removed
    byte runs, lo and hi) and ``kept`` (the remaining bytes; a cut can part a character).

    Every byte covered by a ``length``-byte string that also starts at another place, in another
    row or the same one, is removed; matches never cross rows.
    - null or empty text, and texts shorter than ``length``: nothing is removed
    - repeated rows are copies of each other, so each loses all that is long enough
    - null ids are kept; extra columns are ignored
    """
    body = text_or_empty(F.col(f"`{text}`"))
    docs = df.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.xxhash64(body, F.length(body)).alias("of"), body.cast("binary").alias("data"))
    spans = repeated_spans(docs, length, block, batch_bytes, group)
    rows = docs.alias("d").join(
        spans.alias("s"), F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.of") == F.col("s.of")), "left")
    rows = rows.select("d.id", "data", F.array_sort("spans").alias("spans"))
    pairs = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def run(batches):
        for batch in (b.slice(k, 500) for b in batches for k in range(0, b.num_rows, 500)):
            removed, kept, sizes = [], [], []
            for data, spans_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                runs: list[list[int]] = []
                for s in spans_ or ():
                    if runs and s["lo"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s["hi"])
                    else:
                        runs.append([s["lo"], s["hi"]])
                edges = [0, *(x for r in runs for x in r), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append([{"lo": a, "hi": b} for a, b in runs])
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pairs), pa.array(kept, pa.binary())],
                names=[id_column, "n_bytes", "spans", "kept"])

    out = rows.mapInArrow(run, T.StructType([
        T.StructField(id_column, T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]))),
        T.StructField("kept", T.BinaryType())]))
    return out.select(id_column, "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "spans", "kept")


def op2_collection_bwt(spark, sf_dir: str) -> DataFrame:
    """400-byte strings over all documents."""
    found = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c0 AS (
  SELECT r, 500 * j AS b, substr(h, 1000 * j + 1, 1798) AS c
  FROM (SELECT r, h, unnest(range(length(h) // 1000 + 1)) AS j FROM d)),
w AS (
  SELECT r, b + i AS i, hash(substr(c, 2 * i + 1, 800)) AS k
  FROM (SELECT r, b, c, unnest(range(least(500, length(c) // 2 - 399))) AS i FROM c0 WHERE length(c) >= 800)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM w) WHERE n > 1),
s AS (SELECT r, i, coalesce(i - lag(i) OVER o > 400, true) AS first FROM dup WINDOW o AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, sum(first::INT) OVER (PARTITION BY r ORDER BY i) AS run FROM s),
runs AS (SELECT r, min(i) AS lo, max(i) + 400 AS hi FROM g GROUP BY r, run),
parts AS (
  SELECT r, lo, substr(h, 2 * prev + 1, 2 * (lo - prev)) AS part
  FROM (SELECT r, lo, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS prev FROM runs) JOIN d USING (r)
  UNION ALL
  SELECT r, NULL, substr(h, 2 * coalesce(hi, 0) + 1) FROM d LEFT JOIN (SELECT r, max(hi) AS hi FROM runs GROUP BY r) USING (r)),
kept AS (SELECT r, string_agg(part, '' ORDER BY lo NULLS LAST) AS kept FROM parts GROUP BY r),
c AS (SELECT r, count(*) AS n FROM runs GROUP BY r)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, ((length(h) - length(kept)) // 2)::BIGINT AS n_removed,
  coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN c USING (r)
"""
