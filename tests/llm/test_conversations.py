"""Conversation repair against a search over all sequences of edits."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from lakeshift.llm import conversations as C

BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, gone int, kind string, digest string"


def cheapest(rows):
    """Uniform-cost search over (cost, audit): ``rows`` are (initial, must_go, truncated)."""
    takes = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return cost, audit
        if (i, q) in seen and len(audit) > 3 * len(rows) + 4:
            continue
        seen.add((i, q))
        for role in "ua":
            if (q, role) in takes:
                heapq.heappush(heap, (cost + 2, audit + "I", i, takes[q, role]))
        if i < len(rows):
            initial, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q))
            if not gone:
                if (q, initial) in takes:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, takes[q, initial]))
                for role in "ua":
                    if (q, role) in takes:
                        heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, takes[q, role]))


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({46: None, 33: None, 63: None}) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def expected(conv, rows, search=cheapest):
    """The result row of a conversation whose (turn, role, text) rows are in order."""
    seen, classes, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        body = text.strip(BLANK)
        faults = [not body, (role, text) in seen, body[-1:] not in (".", "!", "?")]
        seen.add((role, text))
        first = faults.index(True) if True in faults else None
        if first is not None:
            counts[first] += 1
        classes.append((role[:1], first in (0, 1), int(first == 2)))
    cost, audit = search(classes)
    todo, q, kept = iter(rows), 0, []
    for letter in audit:
        if letter == "I":
            role, text = ("assistant" if q == 2 else "user"), ""
        else:
            _, role, text = next(todo)
            if letter == "D":
                continue
            if letter == "R":
                role = "assistant" if q == 2 else "user"
        kept.append(f"{role}:{text}")
        q = {"s": 1, "u": 2, "a": 3}[role[0]]
    turns = {t for t, _, _ in rows if t is not None}
    pairs = zip(classes, classes[1:])
    return (
        conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts,
        sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
        hashlib.sha256("\n".join(kept).encode()).hexdigest())


def by_conversation(rows):
    body = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    found = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, body(r))):
        found.setdefault(r[0], []).append(r[1:])
    return found


def plain(rows, damaged=True, search=cheapest):
    after = by_conversation(plain_damage(rows) if damaged else rows)
    return sorted((expected(c, after.get(c, []), search) for c in {r[0] for r in rows}), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "k", "d") for r in rows], SCHEMA)


def random_rows(n_convs, seed, most=9):
    rng = random.Random(seed)
    texts = ["yes.", "no!", "why?", "so", "", " \n", "a. b", "x.\t", None]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None]
    return [
        (conv, None if rng.random() < 0.05 else t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"t{rng.random()}.")
        for conv in [None, *range(n_convs)] for t in range(rng.randrange(1, most))]


@pytest.mark.parametrize("classes", ["".join(c) for n in range(1, 4) for c in itertools.product("-suaoSA", repeat=n)])
def test_weights_give_the_cheapest_edits(classes):
    ends, costs = C.best_ends(classes, list(C.CLOSING))
    audit = C.letters(C.lightest(classes)[0][ends[0]], C.width(classes)) + ("I" if ends[0] == C.AFTER_U else "")
    rows = [(c.lower(), c == C.GONE, int(c.isupper())) for c in classes]
    assert (costs[0], audit) == cheapest(rows)


def test_tables_of_chunks_combine():
    rng = random.Random(5)
    for _ in range(60):
        classes = "".join(rng.choice("-suaouaUA") for _ in range(rng.randrange(2, 14)))
        whole, cost = C.best_ends(classes, list(C.CLOSING))
        cuts = sorted(rng.sample(range(1, len(classes)), min(len(classes) - 1, 3)))
        parts = [classes[a:b] for a, b in zip([0, *cuts], [*cuts, len(classes)])]
        rest, ends = list(C.CLOSING), []
        for part in reversed(parts):
            best, rest = C.best_ends(part, rest)
            ends.insert(0, best)
        state, audit = 0, ""
        for part, best in zip(parts, ends):
            audit += C.letters(C.lightest(part)[state][best[state]], C.width(part))
            state = best[state]
        assert rest[0] == cost[0]
        assert audit == C.letters(C.lightest(classes)[0][whole[0]], C.width(classes)) and state == whole[0]


def test_query_columns_match_the_search(spark, tmp_path):
    rows = random_rows(150, 1)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, C.op11_scalar_repair(spark, str(tmp_path)).collect()), key=str)
    assert got == plain(rows)


def test_long_conversations_in_many_chunks(spark):
    """One conversation holds most rows: chunks of five rows, and repeated rows across them."""
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"t{t}.", "same.", "cut"])) for t in range(90)]
    rows += [(2, 0, "user", "once.")] * 12 + [(3, t, "user", "q?") for t in range(3)]
    whole = C.summary(frame(spark, rows)).collect()

    def dp(classes):
        text = "".join("-" if g else (i.upper() if c else i) for i, g, c in classes)
        ends, costs = C.best_ends(text, list(C.CLOSING))
        return costs[0], C.letters(C.lightest(text)[0][ends[0]], C.width(text)) + "I" * (ends[0] == C.AFTER_U)

    assert sorted(map(tuple, whole), key=str) == plain(rows, damaged=False, search=dp)
    small = C.summary(frame(spark, rows).repartition(7), chunk=5).collect()
    assert sorted(map(tuple, small), key=str) == sorted(map(tuple, whole), key=str)


def test_repaired_rows_are_legal(spark):
    rows = random_rows(40, 3)
    kept = {}
    for r in sorted(C.repair(frame(spark, rows)).collect(), key=lambda r: (str(r.conv_id), r.position)):
        kept.setdefault(r.conv_id, "")
        kept[r.conv_id] += "" if r.edit == "D" else r.role[0]
    assert set(kept) == {r[0] for r in rows}
    assert all(re.fullmatch("(s?(ua)+)?", k) for k in kept.values())


def test_edges(spark, tmp_path):
    empty = frame(spark, [])
    assert C.summary(empty).collect() == [] and C.repair(empty).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    whole = next(c for c in range(100, 200) if zlib.crc32(f"{c}: ".encode()) % 20 > 4)
    long = "w " * 2_000_000 + "."
    rows = [(9, gone, "user", "x."), (whole, None, None, None), (7, 1, "user", long), (7, 2, "assistant", long)]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in C.op11_scalar_repair(spark, str(tmp_path)).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert tuple(got[9]) == (9, 0, 0, 0, 0, 0, 0, "", none)
    r = got[whole]
    assert (r.blank, r.cost, r.audit, r.repaired_sha256) == (1, 3, "D", none)
    assert sorted(map(tuple, got.values()), key=str) == plain(rows)


def test_query_on_a_given_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r.values()) for r in pq.read_table(f"{path}/conversations.parquet").to_pylist()]
    assert sorted(map(tuple, C.op11_scalar_repair(spark, path).collect()), key=str) == plain(rows)
