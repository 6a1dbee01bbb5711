from __future__ import annotations

import random

import numpy as np
import pytest

from lakeshift.llm import decontaminate
from support import docs, edge_docs, empty_docs, prose

ITEMS = "item_id long, text string, id string"


def items(spark, *pairs):
    return spark.createDataFrame([(i, t, "x") for i, t in pairs], ITEMS)


def brute_align(item, text):
    best, end = 0.0, 0
    row = [0.0] * (len(text) + 1)
    for w in item:
        new = [0.0] * (len(text) + 1)
        for j, x in enumerate(text, 1):
            new[j] = max(0.0, row[j - 1] + (1 if x == w else -1), row[j] - 1, new[j - 1] - 1)
            if new[j] > best:
                best, end = new[j], j
        row = new
    return best, end


def test_alignment_against_plain_recurrence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        score, end = decontaminate.align(np.array(a), np.array(b))
        expected = brute_align(a, b)
        assert score == expected[0] and (not a or not b or end >= 0)


def test_exact_edited_and_clean(spark):
    item, other, short = prose(30, 1), prose(24, 2), "one two three four"
    words = item.split()
    edits = {
        2: words[:9] + ["changed"] + words[10:20] + words[21:],
        3: words[:12] + ["put", "in"] + words[12:],
        4: [w.upper() + "," for w in words],
    }
    rows = [(1, prose(50, 11) + "\n" + item + "\n" + prose(50, 12)), (5, prose(300, 13)), (6, " ".join(words[:7]) + " " + prose(80, 14)),
            (7, item + " " + prose(9, 15) + " " + other + " " + item), (8, short), (9, prose(2000, 16) + " " + item)]
    rows += [(i, prose(40, 20 + i) + " " + " ".join(w) + " " + prose(40, 30 + i)) for i, w in edits.items()]
    bench = items(spark, (1, item), (2, other), (3, short), (4, None), (5, ""), (1, item))
    found = {(r["id"], r["item"]): r for r in decontaminate.contaminated(docs(spark, *rows), bench).collect()}
    assert set(found) == {(i, 1) for i in (1, 2, 3, 4, 7, 9)} | {(7, 2)}
    assert found[1, 1]["score"] == 1.0 and (found[1, 1]["first_word"], found[1, 1]["end_word"]) == (50, 80)
    assert found[9, 1]["first_word"] == 2000 and 0.8 < found[2, 1]["score"] < 1


def test_an_item_that_leaked_very_often(spark):
    item = prose(20, 1)
    rows = [(i, prose(8, 100 + i) + " " + item) for i in range(200)] + [(500 + i, prose(30, 900 + i)) for i in range(50)]
    found = decontaminate.contaminated(docs(spark, *rows), items(spark, (1, item), (2, prose(20, 2)))).collect()
    assert sorted((r["id"], r["item"]) for r in found) == [(i, 1) for i in range(200)]


def test_dropping_keeps_columns_nulls_and_clean_rows(spark):
    item = prose(20, 1)
    df = edge_docs(spark).union(docs(spark, (None, "a " + item), (50, item), (50, item), (50, "clean text")))
    out = decontaminate.drop_contaminated(df, items(spark, (1, item)))
    assert out.columns == df.columns
    expected = [r for r in df.collect() if item not in (r["text"] or "")]
    assert sorted(map(str, out.collect())) == sorted(map(str, expected))


def test_an_item_without_id(spark):
    item, other = prose(20, 1), prose(24, 2)
    df = docs(spark, (1, "a " + item), (None, item + " b"), (3, prose(30, 3)), (4, other))
    bench = items(spark, (None, item), (7, item), (None, other))
    found = [(r["id"], r["item"], r["score"]) for r in decontaminate.contaminated(df, bench).collect()]
    assert sorted(found, key=str) == sorted([(i, j, 1.0) for i in (1, None) for j in (None, 7)] + [(4, None, 1.0)], key=str)
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(df, items(spark, (None, item), (None, other))).collect()] == [3]


def test_partial_copies_in_a_hot_group_beside_a_full_one(spark):
    item = prose(38, 1)
    part = " ".join(item.split()[:30])
    rows = [(i, part + " " + prose(8, 5)) for i in range(100)] + [(100 + i, part + " " + prose(8, 10 + i)) for i in range(100)]
    rows += [(900, item + " " + prose(8, 6)), (901, prose(60, 7))]
    found = {r["id"]: r["score"] for r in decontaminate.contaminated(docs(spark, *rows), items(spark, (1, item))).collect()}
    assert set(found) == {*range(200), 900} and found[900] == 1.0 and all(found[i] == 30 / 38 for i in range(200))


def brute_pairs(rows, bench):
    """All pairs whose alignment scores enough, by plain alignment of everything."""
    split = {t: t.split() for t in {t for _, t in [*rows, *bench]}}
    scores = {(i, j): brute_align(split[b], split[t])[0] / len(split[b]) for i, t in rows for j, b in bench}
    return {k: v for k, v in scores.items() if v >= decontaminate.MIN_SCORE}


def edited(words, share, rng):
    """Words replaced, dropped or added at random."""
    out = []
    for w in words:
        kind = rng.random()
        if kind < share:
            out += rng.choice([["x"], ["x"], [], [w, "y"]])
        else:
            out.append(w)
    return " ".join(out)


def test_edited_copies_against_alignment_of_all_pairs(spark):
    """Few words, so that pairs of words are common, and items of any length from five words."""
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bench = [(j, text(rng.choice([5, 6, 8, 12, 15, 20, 38, 60]))) for j in range(30)]
    rows = []
    for i in range(240):
        _, item = rng.choice(bench)
        rows.append((i, f"{text(rng.randrange(40))} {edited(item.split(), rng.choice([0.1, 0.2, 0.25, 0.3]), rng)} {text(rng.randrange(40))}"))
    # Runs of two words only, and two halves with every second word replaced in between.
    long = text(40).split()
    bench.append((90, " ".join(long)))
    rows.append((500, " ".join(w + " z" * (k % 2) for k, w in enumerate(long))))
    rows.append((501, " ".join(long[:11] + [w if k % 2 else "z" for k, w in enumerate(long[11:29])] + long[29:])))
    found = {(r["id"], r["item"]): r["score"] for r in decontaminate.contaminated(docs(spark, *rows), items(spark, *bench)).collect()}
    expected = brute_pairs(rows, bench)
    assert {(500, 90), (501, 90)} <= set(expected) and found == expected


def test_a_score_too_low_for_seeds(spark):
    with pytest.raises(ValueError):
        decontaminate.contaminated(edge_docs(spark), items(spark, (1, prose(9, 1))), min_score=0.2)


def test_empty_tables(spark):
    df = edge_docs(spark)
    assert decontaminate.contaminated(empty_docs(spark), items(spark, (1, prose(9, 1)))).collect() == []
    assert decontaminate.contaminated(df, items(spark)).collect() == []
    assert decontaminate.drop_contaminated(df, items(spark)).count() == df.count()


def test_short_items_match_word_by_word(spark):
    import re

    rng = random.Random(6)
    words = [f"w{n}" for n in range(30)]
    texts = [(n, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))) for n in range(120)]
    texts += [(None, "W3, w4!"), (500, None), (3, "w1 w2"), (7, "w5 " * 3000)]
    bench = [(n, " ".join(rng.choice(words) for _ in range(1 + n % 4))) for n in range(24)]
    bench += [(None, "w3 w4"), (90, "..."), (91, None), (92, "W5"), (92, "w1  w2"), (93, prose(30, 1))]
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    expected = set()
    for i, t in texts:
        for k, b in bench:
            w, p = split(t), split(b)
            at = next((a for a in range(len(w) - len(p) + 1) if w[a:a + len(p)] == p), None) if p else None
            if at is not None and len(p) < decontaminate.LEAST_WORDS:
                expected.add((i, t, k, at, at + len(p)))
    found = decontaminate.contaminated(docs(spark, *texts), items(spark, *bench), short_items=True).collect()
    assert {(r["id"], r["item"]) for r in found} == {(i, k) for i, _, k, _, _ in expected} and len(expected) > 100
    assert all(r["score"] == 1.0 for r in found)
    places = {(i, k, a, e) for i, _, k, a, e in expected}
    assert all((r["id"], r["item"], r["first_word"], r["end_word"]) in places for r in found)
    left = decontaminate.drop_contaminated(docs(spark, *texts), items(spark, *bench), short_items=True)
    assert {(r["doc_id"], r["text"]) for r in left.collect()} == set(texts) - {(i, t) for i, t, _, _, _ in expected}


def test_only_the_rarest_pairs_are_joined(spark):
    """Of nine places with a score of at least five of ten words, six are enough, the rarest ones; a
    pair at two places counts twice, and then an alignment must have more of them."""
    held = spark.createDataFrame([(k, 10 * k) for k in range(1, 9)], "seed long, held long")
    seeds = [(1, k, 1, 10, 5) for k in range(9)] + [(2, 0, 5, 10, 5), (2, 3, 2, 10, 5), (2, 8, 2, 10, 5)]
    rare = decontaminate._rarest(spark.createDataFrame(seeds, "item_of long, seed long, times long, n int, need int"), held).collect()
    assert sorted((r["item_of"], r["seed"], r["least"]) for r in rare) == [(1, k, 1) for k in range(6)] + [(2, 0, 2), (2, 3, 2)]


def test_common_pairs_join_nothing(spark):
    """A phrase in every text is in no candidate unless the item has nothing rarer."""
    phrase = "as shown in the table below"
    item = phrase + " " + prose(14, 1)
    rows = [(i, prose(12, 40 + i) + " " + phrase + " " + prose(12, 400 + i)) for i in range(60)]
    rows += [(100, phrase + " " + phrase + " " + phrase), (101, prose(9, 5) + " " + " ".join(item.split()[4:])), (102, item)]
    found = {(r["id"], r["item"]): r["score"] for r in decontaminate.contaminated(docs(spark, *rows), items(spark, (1, item), (2, phrase))).collect()}
    assert found == brute_pairs(rows, [(1, item), (2, phrase)]) and (5, 2) in found and (5, 1) not in found


def test_the_table_grows_with_the_benchmark():
    sizes = [decontaminate._entries(pairs) for pairs in (0, 1, 1 << 18, (1 << 18) + 1, 1 << 30)]
    assert sizes == [1 << 22, 1 << 22, 1 << 22, 1 << 23, 1 << 24]
