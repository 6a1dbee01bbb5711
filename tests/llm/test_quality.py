from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeshift.llm import quality
from lakeshift.llm.quality import BASE, DEFAULT, Policy, ablation, kept, ledger
from support import docs, edge_docs, empty_docs, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            sum(x == y for x, y in zip(words, words[1:], strict=False)))


TEXTS = [
    None, "", " \n\t", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "a " * 40, "x y " * 30 + "z " + "x y " * 9,
    prose(200, 1), prose(30, 2) + "\n" + prose(30, 2) + "\n" + prose(9, 3), "line\nline\n line\n\n\n", "é#*$%&|<>\x0b\x0cß \r\nß",
    "   word word", "LOUD WORDS " * 30, prose(20_000, 4) + " " + prose(500, 4)]


def test_measurements_against_brute_force(spark):
    df = docs(spark, *enumerate(TEXTS))
    found = {r["doc_id"]: r for r in ledger(df).collect()}
    for i, text in enumerate(TEXTS):
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["n_same_next"]) == brute(text), i
        n, _, _, _, repeated, _ = brute(text)
        assert bool(r["failed"] & BASE.mask) == (n < 20 or 100 * repeated > 30 * n)


def test_edges(spark):
    df = edge_docs(spark)
    rows = ledger(df)
    assert rows.count() == df.count() and set(df.columns) - {"text"} <= set(rows.columns)
    assert ledger(empty_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        ledger(df.withColumn("n_words", F.lit(1)))


def test_policies_read_the_ledger_only(spark):
    rows = ledger(docs(spark, *enumerate(TEXTS)))
    loose = Policy("loose", ("symbols",))
    got = {r["doc_id"]: r for r in rows.withColumn("loose", kept(loose)).withColumn("all", kept(DEFAULT)).collect()}
    assert all(r["loose"] == (not r["failed"] & 4) and r["all"] == (r["failed"] == 0) for r in got.values())


def test_ablation(spark):
    rows = ledger(docs(spark, *enumerate(TEXTS))).cache()
    failed = [r["failed"] for r in rows.collect()]
    found = {r["rule"]: r for r in ablation(rows).collect()}
    for i, rule in enumerate(quality.RULES):
        bit = 1 << i
        assert found[rule.name]["n_failed"] == sum(bool(f & bit) for f in failed)
        assert found[rule.name]["n_only_this"] == sum(f == bit for f in failed)
        assert found[rule.name]["n_kept_without"] == sum(not f & ~bit for f in failed)
    assert ablation(rows.limit(0)).collect() == []


def test_clean_labelled_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.op9_quality_ledger(spark, sf).join(labels, "doc_id").where("NOT base_failed").select("quality", "kept").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert sum(good) >= 0.99 * len(good)
