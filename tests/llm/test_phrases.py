"""Collocations against counting every phrase, in Python and in SQL."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from lakeshift.llm import phrases as P

SCHEMA = "doc_id long, text string, lang string, phrase string, a long, n int"
FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2) for i, (lang, t) in enumerate(rows)], SCHEMA)


def plain(rows, top=2000, least=30, within=80):
    f = {}
    for lang, text in rows:
        counts = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLD)):
            w = re.findall("[^ \t]+", piece)
            counts.update(tuple(w[i: i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        wanted = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        n, kept = sum(a for p, a in counts.items() if len(p) == 1), []
        for p, a in wanted.items():
            longer = (q for q in wanted if len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if any(100 * wanted[q] >= within * a for q in longer):
                continue
            s, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def corpus(n, seed, n_words=60):
    """Texts over a small vocabulary with fixed phrases, so that many phrases are frequent."""
    rng = random.Random(seed)
    vocab = [f"{rng.choice('abcdefgéß')}{i}" for i in range(n_words)]
    fixed = [[rng.choice(vocab) for _ in range(rng.randrange(2, 7))] for _ in range(25)]
    rows = []
    for _ in range(n):
        words = []
        while len(words) < 60:
            words += rng.choice(fixed) if rng.random() < 0.6 else [vocab[int(n_words * rng.random() ** 3)]]
            words += [rng.choice([".", ",", "\n", "\t", "  ", "! ?"])] if rng.random() < 0.2 else []
        rows.append((rng.choice(["en", "fr", None]), " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words)))
    return rows


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("first, top", [(5, 20), (40, 2000), (3000, 15)])
def test_any_first_floor_gives_the_same_result(spark, first, top):
    rows = corpus(160, 4)
    assert got(P.collocations(frame(spark, rows), top=top, first=first)) == plain(rows, top=top)


def test_full_bitmaps_change_nothing(spark, monkeypatch):
    rows = corpus(120, 9)
    monkeypatch.setattr(P, "_size", lambda entries: 64)
    assert got(P.collocations(frame(spark, rows), top=30, least=10, first=20)) == plain(rows, top=30, least=10)


def test_edges(spark):
    assert P.collocations(frame(spark, [])).collect() == []
    assert P.collocations(frame(spark, [("en", None), (None, ""), ("en", " .\t\n"), ("en", "one word")])).collect() == []
    overlaps = [("en", "a a a a a " * 10 + "x"), (None, "b\tC " * 40), ("und", "B c\x0bb c"), ("en", "q w.e r " * 40)]
    overlaps += [("fr", "long tail " * 60_000)] + [("fr", "same row here")] * 40
    assert got(P.collocations(frame(spark, overlaps))) == plain(overlaps)


def test_a_bound_holds_for_all_growth():
    """No phrase scores above the bound of any of its prefixes."""
    counts = Counter()
    for _, text in corpus(60, 2):
        for piece in re.split("[.,!?\n]", text.translate(FOLD)):
            w = piece.split()
            counts.update(tuple(w[i: i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    for p, a in counts.items():
        if len(p) > 1:
            s = min(2000000 * a // (counts[p[:k]] + counts[p[k:]]) for k in range(1, len(p)))
            assert all(s <= 2000000 * counts[p[:j]] // (counts[p[:1]] + counts[p[:j]]) for j in range(1, len(p) + 1))


def test_large_counts_are_exact(spark):
    big = 2**62
    known = spark.createDataFrame([("x", "a", big), ("x", "b", big + 3)], "lang string, phrase string, a long")
    row = P.score(spark.createDataFrame([("x", "a b", big - 1)], known.schema), known).first()
    assert row.score == 2000000 * (big - 1) // (2 * big + 3) and row.bound == 2000000 * (big - 1) // (2 * big - 1)


def test_tally_counts_phrases():
    ids = np.array([2, 3, 2, 3, 4, 1, 2, 3, 2], np.int32)
    words, counts = P._tally(ids, np.array([0, 1, 2, 6]), 3, 5)
    assert dict(zip(zip(*(w.tolist() for w in words)), counts.tolist())) == {(2, 3, 2): 2, (3, 2, 3): 1, (2, 3, 4): 1}


def test_sql_on_a_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = duckdb.sql(P.ORACLE_OP12.replace("FROM documents", f"FROM '{folder}/documents.parquet'")).fetchall()
    assert got(P.op12_branch_and_bound(spark, folder)) == sorted(rows) and len(rows) > 100
