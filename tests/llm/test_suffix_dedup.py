from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from lakeshift.llm import suffix_dedup
from support import docs, edge_docs, empty_docs, prose


def brute(pairs, length):
    data = [(i, (t or "").encode()) for i, t in pairs]
    held = Counter(b[k:k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if held[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def run(df, length, block, **options):
    found = suffix_dedup.remove_repeats(df, length=length, block=block, **options).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in found), key=str)


def test_shared_windows_against_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        length, block = rng.choice([(8, 2), (8, 4), (12, 3), (8, 1), (8, 8)])
        base = bytes(rng.choice(b"ab") for _ in range(60))
        parts = []
        for _ in range(rng.randrange(1, 8)):
            i = rng.randrange(50)
            part = bytearray(base[i:rng.randrange(i, 60)])
            for _ in range(rng.randrange(3)):
                if part:
                    part[rng.randrange(len(part))] = rng.choice(b"abc")
            parts.append(bytes(part))
        held = Counter(p[i:i + length] for p in parts for i in range(len(p) - length + 1))
        if any(parts):
            for got, p in zip(suffix_dedup.shared_windows(parts, length, block), parts, strict=True):
                assert got.tolist() == [held[p[i:i + length]] > 1 for i in range(len(p) - length + 1)]


def test_index_columns():
    """Suffixes come out sorted, with their BWT symbols and common prefixes."""
    rng = random.Random(4)
    for _ in range(60):
        strings = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 6))]
        flat = [(d, k) for d, s in enumerate(strings) for k in range(len(s))]
        number = {x: n for n, x in enumerate(flat)}
        index = suffix_dedup.CollectionIndex(5)
        index.build(np.array([strings[d][k] for d, k in flat]), np.array([number.get((d, k + 1), -1) for d, k in flat]),
                    np.array([len(strings[d]) - k for d, k in flat]))
        real = [flat[w] for w in index.who if w >= 0]
        suffixes = [tuple(strings[d][k:]) for d, k in real]
        assert suffixes == sorted(suffixes) and len(real) == len(flat)
        assert [b for b, w in zip(index.bwt, index.who, strict=True) if w >= 0] == [strings[d][k - 1] if k else -1 for d, k in real]
        common = [c for c, w in zip(index.common, index.who, strict=True) if w >= 0]
        for n in range(1, len(real)):
            same = next((m for m, (x, y) in enumerate(zip(suffixes[n - 1], suffixes[n], strict=False)) if x != y), min(len(suffixes[n - 1]), len(suffixes[n])))
            assert common[n] == min(5, same)


@pytest.mark.parametrize(("batch_bytes", "group"), [(1, 1000), (1 << 20, 1), (1 << 20, 3)])
def test_against_brute_force(spark, batch_bytes, group):
    rng = random.Random(6)
    passage, other = prose(30, 1), prose(40, 2)
    pairs = [(i, prose(rng.randrange(30), 50 + i) + " é " + passage[rng.randrange(40):] + prose(5, i)) for i in range(12)]
    pairs += [(40, other + "x" + other), (41, "ab" * 300), (42, "z" * 500), (43, passage), (44, passage), (44, passage), (45, None), (46, "")]
    pairs += [(47, "q" + "ab" * 300 + "r"), (None, prose(30, 9)), (None, prose(30, 9))]
    assert run(docs(spark, *pairs), 64, 16, batch_bytes=batch_bytes, group=group) == brute(pairs, 64)


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 777)
    text = prose(700, 3)
    rows = [np.concatenate(c) for c in zip(*[suffix_dedup.segments(np.frombuffer(text.encode(), np.uint8), 400)], strict=True)]
    windows = sorted(k for b, e in zip(rows[2], rows[3], strict=True) for k in range(b, e - 399))
    assert windows == list(range(len(text.encode()) - 399))


def test_edges(spark):
    df = edge_docs(spark)
    pairs = [(r["doc_id"], r["text"]) for r in df.collect()]
    found = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in suffix_dedup.remove_repeats(df).collect()}
    long = len(pairs[3][1])
    assert found[4, long] == long and found[7, long] == long and found[1, 0] == 0
    assert found[6, 1000] == 1000  # a run of one character: shifted by one character the window is the same
    assert suffix_dedup.remove_repeats(empty_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, length=10, block=3)


def test_symbols_are_told_apart_by_their_bytes(monkeypatch):
    """With hashes that always meet, blocks still get equal numbers only for equal bytes."""
    data = np.frombuffer(b"abcabdabcxyz", np.uint8)
    at = np.arange(len(data) - 2)
    honest = suffix_dedup.symbols(data, at, 3)
    monkeypatch.setattr(suffix_dedup._Hashes, "of", lambda self, start, stop: np.zeros(len(start), np.uint64))
    met = suffix_dedup.symbols(data, at, 3)
    for numbers in (honest, met):
        assert [[x == y for y in numbers] for x in numbers] == [[data[i:i + 3].tolist() == data[j:j + 3].tolist() for j in at] for i in at]
    assert len(suffix_dedup.symbols(data, at[:0], 3)) == 0


def test_places_follow_from_the_bwt_alone():
    """The finished transform spells the collection when it is read back by symbol counts and ranks."""
    rng = random.Random(9)
    for _ in range(40):
        strings = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 6))]
        flat = [(d, k) for d, s in enumerate(strings) for k in range(len(s))]
        number = {x: n for n, x in enumerate(flat)}
        index = suffix_dedup.CollectionIndex(4)
        index.build(np.array([strings[d][k] for d, k in flat]), np.array([number.get((d, k + 1), -1) for d, k in flat]),
                    np.array([len(strings[d]) - k for d, k in flat]))
        bwt = index.bwt.tolist()
        for d, s in enumerate(strings):
            place, read = d, []
            while bwt[place] >= 0:
                c = bwt[place]
                read.append(c)
                place = len(strings) + sum(0 <= x < c for x in bwt) + bwt[:place].count(c)
            assert read[::-1] == s


def test_copies_are_found_by_their_count():
    found = suffix_dedup.shared_windows([b"abcdefgh", b"zzabcdxx", b"qrstuvwx"], 4, 2, [2, 1, 1])
    assert found[0].all() and found[1].tolist() == [False, False, True, False, False] and not found[2].any()


def test_texts_scanned_together_have_the_segments_of_each():
    rng = random.Random(12)
    for _ in range(20):
        texts = [prose(rng.choice([0, 1, 5, 20, 60]), rng.randrange(4)).encode() for _ in range(12)]
        stops = np.cumsum([len(t) for t in texts])
        together = zip(*suffix_dedup.segments(np.frombuffer(b"".join(texts), np.uint8), 64, 16, stops), strict=True)
        alone = []
        for text, begin in zip(texts, np.r_[0, stops], strict=False):
            for anchor, content, *places in zip(*suffix_dedup.segments(np.frombuffer(text, np.uint8), 64, 16), strict=True):
                alone.append((anchor, content, *(p + begin for p in places)))
        assert list(together) == alone


def test_blocks_in_a_row_are_compared_whole(monkeypatch):
    """With hashes that leave out some bytes, blocks whose neighbours are equal still are told apart."""
    rng = random.Random(13)
    honest = suffix_dedup._Hashes.of
    for cut in ((0, 1), (1, 0), (1, 1), (2, 0)):
        monkeypatch.setattr(suffix_dedup._Hashes, "of", lambda self, a, b, cut=cut: honest(self, a + cut[0], b - cut[1]))
        for _ in range(50):
            base = bytes(rng.choice(b"ab") for _ in range(20))
            data = base + base[:-1] + b"c" + base[rng.randrange(20):]
            at = np.array([k for k in range(len(data) - 4) if rng.random() < 0.9])
            numbers = suffix_dedup.symbols(np.frombuffer(data, np.uint8), at, 5)
            assert [[x == y for y in numbers] for x in numbers] == [[data[i:i + 5] == data[j:j + 5] for j in at] for i in at]


@pytest.mark.parametrize("batch_bytes", [1, 300, 1 << 20])
def test_batches_reach_over_arrow_batches(spark, batch_bytes):
    rng = random.Random(14)
    passage = prose(30, 1)
    pairs = [(i, prose(rng.randrange(30), 50 + i // 2) + passage[rng.randrange(150):] + prose(5, i)) for i in range(30)]
    pairs += [(30, None), (31, ""), (32, passage), (32, passage)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert run(docs(spark, *pairs), 64, 16, batch_bytes=batch_bytes) == brute(pairs, 64)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_planted_passages_are_caught_by_what_is_removed(spark):
    """Passages of over 50 words (400 bytes or more) in two documents each; ``n_bytes`` is the size before."""
    pairs = []
    for i in range(12):
        passage = prose(60, 1000 + i)
        pairs += [(3 * i, prose(40, 3 * i) + " " + passage), (3 * i + 1, passage + " " + prose(70, 3 * i + 1)), (3 * i + 2, prose(120, 3 * i + 2))]
    found = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs(spark, *pairs)).collect()}
    for i, text in pairs:
        least = 0 if i % 3 == 2 else len(prose(60, 1000 + i // 3).encode())
        assert found[i]["n_bytes"] == len(text) and least <= found[i]["n_removed"] <= (least + 2 if least else 0)
