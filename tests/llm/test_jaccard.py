from __future__ import annotations

import random
import re

import pytest

from lakeshift.llm import jaccard
from lakeshift.llm.components import components
from support import docs, edge_docs, empty_docs, prose


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(pairs, similarity=0.8):
    """Per row (id, class, copies' id, links), for distinct ids."""
    sets = {i: shingles(t) for i, t in pairs}
    ids = sorted(sets)
    root, links = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            union = len(sets[a] | sets[b])
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * union:
                links[a] += 1
                links[b] += 1
                p, q = top(a), top(b)
                root[max(p, q)] = min(p, q)
    copy = {i: min(j for j in ids if sets[j] == sets[i]) if sets[i] else i for i in ids}
    return [(i, top(i), copy[i], links[i]) for i in ids]


def edited(text, rng, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


def corpus():
    rng = random.Random(4)
    pairs = [(i, prose(rng.randrange(3, 120), 500 + i)) for i in range(40)]
    base = prose(150, 1)
    pairs += [(100 + i, edited(base, rng, rng.randrange(4))) for i in range(30)]
    pairs += [(200 + i, base) for i in range(8)] + [(300, base.upper()), (301, "  " + base.replace(" ", "\n"))]
    pairs += [(400, None), (401, ""), (402, " "), (403, "two words"), (404, "Two  words"), (405, "words two")]
    return pairs


def got(df, **options):
    return sorted(((r["doc_id"], r["class_id"], r["copy_id"], r["n_links"]) for r in jaccard.jaccard_join(df, **options).collect()), key=str)


@pytest.mark.parametrize("block", [400, 7])
def test_against_brute_force(spark, block):
    pairs = corpus()
    assert got(docs(spark, *pairs), block=block) == sorted(brute(pairs), key=str)


def chain(n, first=0):
    """Texts of which each is similar to the next ones only; every text meets the others through them."""
    words = prose(4 * n + 100, 77).split()
    return [(first + i, " ".join(f"{w}{4 * i + k}" for k, w in enumerate(words[4 * i:4 * i + 80]))) for i in range(n)]


def test_work_of_a_chain_follows_its_meetings(spark, monkeypatch):
    rows, verify = [], jaccard._verify

    def counted(groups, similarity):
        rows.append([(r["band"], r["n"]) for r in groups.groupBy("band").count().withColumnRenamed("count", "n").collect()])
        return verify(groups, similarity)

    monkeypatch.setattr(jaccard, "_verify", counted)
    for n in (90, 270):
        pairs = chain(n)
        assert got(docs(spark, *pairs), block=4) == sorted(brute(pairs), key=str)
    short, long = (sum(n for _, n in r) for r in rows)
    assert all(band >= 0 for r in rows for band, _ in r)
    assert 2.5 * short < long < 3.5 * short and long < 270 * 270 / 4


def test_chains_beside_tight_groups(spark):
    rng = random.Random(9)
    base = prose(60, 5)
    pairs = chain(30) + [(1000 + i, edited(base, rng, i % 3)) for i in range(25)] + [(2000 + i, t) for i, t in chain(30)[::7]]
    assert got(docs(spark, *pairs), block=3) == sorted(brute(pairs), key=str)


def test_edges(spark):
    df = edge_docs(spark)
    out = jaccard.jaccard_join(df).collect()
    assert len(out) == df.count()
    by = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert by[4]["class_id"] == by[7]["class_id"] == 4 and by[7]["n_links"] == 1
    assert [r["class_id"] for r in out if r["doc_id"] is None] == [None, None]
    assert jaccard.jaccard_join(empty_docs(spark)).collect() == []


def test_one_row_of_each_group_stays(spark):
    pairs = corpus()
    df = docs(spark, *pairs, *pairs[:3], (None, "x"), (None, "x"))
    out = jaccard.drop_near_duplicates(df)
    assert out.columns == df.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c, _, _ in brute(pairs)}) and ids.count(None) == 2


def test_bands_reach_the_recall():
    for similarity, recall in ((0.8, 0.9999), (0.9, 0.99), (0.5, 0.9)):
        bands, rows = jaccard.choose_bands(similarity, recall, 300)
        assert 1 - (1 - similarity**rows) ** bands >= recall and bands * rows <= 300
    with pytest.raises(ValueError):
        jaccard.choose_bands(0.1, 0.9999, 10)


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(30)] + [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(90)]
    edges += [(7, 7), (900, None), (901, 900), (901, 900)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            p, q = top(a), top(b)
            root[max(p, q)] = min(p, q)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {x: top(x) for x in root} and len(found) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def with_null_ids(pairs):
    """Brute force for rows of which some ids are null: rows get numbers, classes their ids."""
    found = brute([(n, t) for n, (_, t) in enumerate(pairs)])
    members = {}
    for n, c, _, _ in found:
        members.setdefault(c, []).append(n)
    copies = {}
    for n, _, c, _ in found:
        copies.setdefault(c, []).append(n)
    least = lambda group: min((pairs[n][0] for n in group if pairs[n][0] is not None), default=None)
    return [(pairs[n][0], least(members[c]), least(copies[k]), links) for n, c, k, links in found], members


def null_id_corpus():
    base, other = prose(90, 7), prose(90, 8)
    rng = random.Random(1)
    pairs = [(None, base), (None, base), (1, base), (5, edited(base, rng, 1)), (None, edited(base, rng, 2))]
    pairs += [(None, other), (None, other), (None, edited(other, rng, 1)), (None, None), (7, ""), (3, " "), (None, "x"), (9, prose(50, 3))]
    return pairs


def test_null_ids_are_classed_by_their_texts(spark):
    pairs = null_id_corpus()
    expected, _ = with_null_ids(pairs)
    assert got(docs(spark, *pairs), null_ids=True) == sorted(expected, key=str)


def test_one_row_of_each_group_stays_with_null_ids(spark):
    pairs = null_id_corpus()
    df = docs(spark, *pairs)
    kept = [(r["doc_id"], r["text"]) for r in jaccard.drop_near_duplicates(df, null_ids=True).collect()]
    _, members = with_null_ids(pairs)
    wordless = {n for n, (_, t) in enumerate(pairs) if not (t or "").split()}
    groups = [g for g in members.values() if not wordless & set(g)] + [sorted(wordless)]
    least = lambda g: min((pairs[n][0] for n in g if pairs[n][0] is not None), default=None)
    assert sorted((i for i, _ in kept), key=str) == sorted(map(least, groups), key=str)
    assert all((i, t) in pairs for i, t in kept)
    edges = edge_docs(spark)
    assert sorted((r["doc_id"] for r in jaccard.drop_near_duplicates(edges, null_ids=True).collect()), key=str) == [1, 4, 5, 5, 6, None]
    assert jaccard.drop_near_duplicates(empty_docs(spark), null_ids=True).collect() == []


def test_rows_that_differ_in_other_columns_only(spark):
    text = prose(40, 1)
    rows = [(1, text, f"s{n}") for n in range(20)] + [(2, text, "t")]
    for null_ids in (False, True):
        kept = {
            tuple(jaccard.drop_near_duplicates(
                spark.createDataFrame(rows[n:] + rows[:n], "doc_id long, text string, source string").repartition(1 + n % 4),
                null_ids=null_ids).first())
            for n in (0, 3, 11)}
        assert len(kept) == 1 and next(iter(kept))[0] == 1
