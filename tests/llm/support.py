"""Small inputs for the tests of the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, id string, `of` string, row string, cell int, key string, body string"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def rows(*pairs):
    """(doc_id, text) with extra columns that have the names of inner ones."""
    return [(i, t, "x", None, "r", 7, "k", "b") for i, t in pairs]


def docs(spark, *pairs):
    return spark.createDataFrame(rows(*pairs), DOCS)


def edge_docs(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, repeated ids."""
    long = prose(30_000, 1)
    return docs(
        spark, (1, None), (2, ""), (3, " \n\t "), (4, long), (5, prose(60, 2)), (5, prose(60, 2)),
        (5, prose(60, 3)), (None, prose(60, 4)), (None, None), (6, "é" * 500), (7, long))


def empty_docs(spark):
    return docs(spark)
