"""Secret scans: fixed rules plus character Markov models compared by log-likelihood ratio.

Two second-order models are trained on labelled strings: *random* strings (values that the fixed
rules find in a bounded sample of documents, and generated strings over the alphabets that keys
are written in) and *ordinary* ones (the other long words of that sample and identifiers joined
from them). A run of key characters that no rule covers is reported when the log of its
likelihood ratio, random against ordinary, is high enough in total and per character.

The trained table has one number per three characters of a fixed alphabet, so what is sent to the
tasks does not grow with the data. The scan itself is one pass without a shuffle.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.llm.common import add_text_columns, table

#: Fixed rules. Letters of ``assign`` match in either case.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "markov")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Characters of the models; any other character ends a run.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST_RUN = 20
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST_RUN)
WORD = re.compile(r"[A-Za-z0-9_-]{4,}")
START = len(ALPHABET)
SIZE = START + 1
CODES = bytes(ALPHABET.index(chr(b)) if chr(b) in ALPHABET else START for b in range(256))

#: Documents in the training sample at most, and generated strings per alphabet.
TRAIN_DOCS = 2000
GENERATED = 400
SMOOTHING = 0.2
#: Natural logs: least total ratio, and least mean ratio per character.
MIN_RATIO = 15.0
MIN_MEAN = 0.5


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the fixed rules, in code points; per kind leftmost without
    overlap, then the short ones are dropped."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    # A long hexadecimal run lies inside a long run of key characters.
    for run in RUN.finditer(text):
        if len(run[0]) >= LEAST["hex"]:
            found += [
                (m.start(), m.end(), "hex")
                for m in HEX.finditer(text, run.start(), run.end()) if m.end() - m.start() >= LEAST["hex"]
            ]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _counts(strings) -> np.ndarray:
    """How often each character follows two others (or the start)."""
    counts = np.zeros((SIZE, SIZE, SIZE), dtype=np.int64)
    for s in strings:
        c = np.frombuffer(bytes([START, START]) + s.encode("ascii").translate(CODES), dtype=np.uint8)
        np.add.at(counts, (c[:-2], c[1:-1], c[2:]), 1)
    return counts


def _generated() -> list[str]:
    """Labelled random strings: a fixed seed, so that each training gives the same model."""
    rng = random.Random(20240229)
    alphabets = ("0123456789abcdef", ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[:62] + "_-", ALPHABET[:26] + "234567", ALPHABET[26:62])
    return ["".join(rng.choices(a, k=rng.randrange(20, 64))) for a in alphabets for _ in range(GENERATED)]


def labelled(text: str) -> tuple[list[str], list[str]]:
    """(random, ordinary) strings of a text: values found by the rules, and the words elsewhere,
    alone and joined in pairs as identifiers are."""
    spans = base_spans(text)
    values = [re.split(r"[:=]\x20*[\"']?", text[a:b], maxsplit=1)[-1].replace(".", "") for a, b, _ in spans]
    rest, at = [], 0
    for a, b, _ in spans:
        rest.append(text[at:max(a, at)])
        at = max(at, b)
    words = WORD.findall(" ".join([*rest, text[at:]]))
    pairs = [x + j + y for i, (x, y) in enumerate(zip(words[::2], words[1::2], strict=False)) for j in (("_", "-", "")[i % 3],)]
    return values, words + pairs


@dataclass(frozen=True)
class RatioModel:
    """Log-likelihood ratios, random against ordinary, per three characters."""

    ratio: np.ndarray

    @staticmethod
    def from_counts(random_counts: np.ndarray, ordinary_counts: np.ndarray) -> RatioModel:
        def log_p(n: np.ndarray) -> np.ndarray:
            # Second order, smoothed towards first order, and that towards even odds.
            first = n.sum(axis=0)
            p1 = (first + 1.0) / (first.sum(axis=1, keepdims=True) + SIZE)
            weight = SMOOTHING * SIZE
            return np.log((n + weight * p1[None]) / (n.sum(axis=2, keepdims=True) + weight))

        return RatioModel((log_p(random_counts) - log_p(ordinary_counts)).astype(np.float32))

    def score(self, run: str) -> float:
        c = np.frombuffer(bytes([START, START]) + run.encode("ascii").translate(CODES), dtype=np.uint8)
        return float(self.ratio[c[:-2], c[1:-1], c[2:]].sum())

    def is_secret(self, run: str) -> bool:
        score = self.score(run)
        return score >= MIN_RATIO and score >= MIN_MEAN * len(run)


def train(df: DataFrame, id_column: str = "doc_id", text: str = "text", sample: int = TRAIN_DOCS) -> RatioModel:
    """Fit on at most ``sample`` different rows, those with the smallest hash of their id and
    text, so the same ones each time, however often ids or rows repeat. Counting runs in tasks;
    the driver gets sums over a fixed alphabet. An empty table leaves the generated strings
    against even odds."""
    rows = df.select(F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("text"))
    least = rows.select("h").distinct().orderBy("h").limit(sample)
    # Rows of one hash are copies: one counts, and of a chance meeting the smallest text.
    chosen = rows.join(F.broadcast(least), "h", "left_semi").groupBy("h").agg(F.min("text").alias("text")).select("text")

    def count(batches):
        totals = np.zeros((2, SIZE, SIZE, SIZE), dtype=np.int64)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                for label, strings in enumerate(labelled(body or "")):
                    totals[label] += _counts(strings)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals.ravel()[at])], names=["at", "n"])

    sums = chosen.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(2 * SIZE**3, dtype=np.int64)
    for row in sums:
        totals[row["at"]] = row["n"]
    totals = totals.reshape(2, SIZE, SIZE, SIZE)
    return RatioModel.from_counts(totals[0] + _counts(_generated()), totals[1])


def spans(text: str, model: RatioModel) -> list[tuple[int, int, str]]:
    """All spans in order: those of the rules, and runs, or parts of runs clear of them, of 20 or
    more characters that the model calls random."""
    found = base_spans(text)
    taken = [(a, b) for a, b, _ in found]
    for run in RUN.finditer(text):
        at, inside = run.start(), [(a, b) for a, b in taken if a < run.end() and run.start() < b]
        for a, b in [*inside, (run.end(), run.end())]:
            if a - at >= LEAST_RUN and model.is_secret(text[at:a]):
                found.append((at, a, "markov"))
            at = max(at, b)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def scan(df: DataFrame, model: RatioModel, text: str = "text", result: str = "secrets") -> DataFrame:
    """``df`` plus an array of the spans found (kind, start, end; code points, end exclusive), by
    start and then kind in the order of KINDS.

    Null or empty text: an empty array; texts of any length are read whole; repeated rows: each is
    scanned; ``result`` named like a column of ``df``: ValueError.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def start():
        def make(texts):
            rows = [[{"kind": k, "start": a, "end": b} for a, b, k in spans(t, model)] for t in texts]
            return [pa.array(rows, kind)]

        return make

    return add_text_columns(df, text, [T.StructField(result, T.ArrayType(SPAN))], start)


def op4_markov_secrets(spark, sf_dir: str) -> DataFrame:
    """Counts and spans of all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = scan(docs, train(docs)).drop("text")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"), number("markov").alias("n_markov"))
