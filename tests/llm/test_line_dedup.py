from __future__ import annotations

import hashlib
from collections import defaultdict

from lakeshift.llm.line_dedup import dedup_lines
from support import docs, edge_docs, empty_docs, prose

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(pairs, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UP)
    held = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(i)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


def run(df, **options):
    found = dedup_lines(df, n_lines="n", n_dropped="d", **options).collect()
    return sorted((r["doc_id"], r["n"], r["d"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in found)


def test_against_brute_force(spark):
    shared, short, other = prose(12, 9), "short line", prose(12, 8)
    pairs = [(i, "\n".join([prose(9, 100 + i), "  " + shared.upper() + "\t", short, other if i % 3 else "", shared])) for i in range(9)]
    pairs += [(20, shared), (20, shared), (21, None), (22, ""), (23, "\n\n"), (24, " " + shared), (25, shared + "\r")]
    assert run(docs(spark, *pairs)) == brute(pairs)


def test_non_ascii_is_not_folded_and_code_points_count(spark):
    line = "É" * 40
    pairs = [(i, line) for i in range(5)] + [(9, line.lower()), (10, "É" * 39)]
    assert run(docs(spark, *pairs)) == brute(pairs)


def test_edges_keep_rows_and_columns(spark):
    df = edge_docs(spark)
    out = dedup_lines(df, min_docs=99)
    assert out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_one_line_documents_and_null_ids(spark):
    line = prose(20, 5)
    out = dedup_lines(docs(spark, (None, line), (1, line), (2, line)), min_docs=2).collect()
    assert {r["doc_id"]: r["text"] for r in out} == {None: "", 1: "", 2: line}


def test_empty_table(spark):
    assert dedup_lines(empty_docs(spark)).collect() == []
