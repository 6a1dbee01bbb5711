"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row keeps the measurements and one integer
whose bit ``i`` says that rule ``i`` failed. A policy is a named, versioned mask over those bits:
applying another policy, comparing two of them or asking what each rule removes on its own
(ablation) reads the ledger only and never the texts again.

Only DataFrame and SQL functions are used. Repeated word windows are found inside the row: words
become 64-bit hashes, each window of eight a hash of those, and equal windows meet in a sorted
array, so a document costs n log n and no shuffle is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import BLANKS, materialised, table, text_or_empty

WINDOW = 8
INNER = "__ledger_"


@dataclass(frozen=True)
class Rule:
    """A named test on the measurements; it fails where ``fails`` (SQL over their names) is true."""

    name: str
    fails: str


#: Bit i of the ledger belongs to rule i. New rules are appended, so that old ledgers stay readable.
RULES: tuple[Rule, ...] = (
    Rule("too_few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 24 * n_words"),
    Rule("upper_case", "2 * n_upper > word_chars"),
    Rule("stuttering", "10 * n_same_next > 3 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """Rules that decide under a version; a document is kept when none of them failed."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [r.name for r in RULES]
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_windows"))
DEFAULT = Policy("3", tuple(r.name for r in RULES))


def _n_repeat_words(df: DataFrame) -> DataFrame:
    """Add the number of words that lie in a window found twice or more; ``df`` has the word
    hashes. Each array step is materialised, as lambdas refer to the arrays before it."""
    h, sh, pairs, starts = (INNER + n for n in ("hashes", "windows", "pairs", "starts"))
    n_windows = f"size({h}) - {WINDOW - 1}"
    window = ", ".join(f"{h}[i + {k}]" for k in range(WINDOW))
    df = materialised(df, **{sh: F.expr(
        f"if({n_windows} > 1, transform(sequence(0, greatest({n_windows}, 1) - 1), i -> xxhash64({window})),"
        " cast(array() AS array<bigint>))")})
    df = materialised(df, **{pairs: F.expr(
        f"if(size(array_distinct({sh})) < size({sh}), sort_array(transform({sh}, (x, i) -> struct(x AS h, i AS i))),"
        " cast(array() AS array<struct<h:bigint,i:int>>))")})
    # Neighbours in the sorted array that are equal: both starts belong to a repeated window.
    df = materialised(df, **{starts: F.expr(
        f"sort_array(array_distinct(flatten(zip_with({pairs}, slice({pairs}, 2, greatest(size({pairs}) - 1, 0)),"
        " (a, b) -> if(a.h = b.h, array(a.i, b.i), cast(array() AS array<int>))))))")})
    covered = F.expr(
        f"aggregate(zip_with({starts}, slice({starts}, 2, greatest(size({starts}) - 1, 0)),"
        f" (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW}))), 0L, (n, x) -> n + x)")
    return df.withColumn("n_repeat_words", covered).drop(sh, pairs, starts)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus the measurements: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_upper,
    n_same_next, n_repeat_words (all long).

    - words: ``[^\\x20\\x09-\\x0D]+``; null or empty text: no words, all measurements 0
    - n_lines, n_dup_lines: lines with a word; of these, lines equal to an earlier one
    - n_same_next: words equal to the word after them
    - texts of any length are read whole; repeated rows: each is measured on its own
    - a column of ``df`` with the name of a measurement raises ValueError
    """
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_upper", "n_same_next", "n_repeat_words")
    if set(names) & set(df.columns):
        raise ValueError(f"columns {sorted(set(names) & set(df.columns))} have the names of measurements")
    t, words, lines, h = (INNER + n for n in ("text", "words", "lines", "hashes"))
    df = df.withColumn(t, text_or_empty(F.col(f"`{text}`")))
    df = materialised(df, **{
        words: F.filter(F.split(F.col(t), r"[\x20\x09-\x0D]+"), lambda w: w != ""),
        lines: F.filter(F.split(F.col(t), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""),
    })
    lost = lambda pattern: F.length(t) - F.length(F.regexp_replace(t, pattern, ""))
    df = materialised(df, **{
        "n_words": F.size(words).cast("long"),
        "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)),
        "n_symbols": lost(r"[#*$%&|<>]+").cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_upper": lost(r"\p{Lu}+").cast("long"),
        h: F.transform(words, lambda w: F.xxhash64(w)),
    }).drop(t, words, lines)
    df = df.withColumn("n_same_next", F.expr(
        f"size(filter(zip_with({h}, slice({h}, 2, greatest(size({h}) - 1, 0)), (a, b) -> a = b), x -> x))").cast("long"))
    return _n_repeat_words(df).drop(h)


def failure_bits(rules: Sequence[Rule] = RULES) -> Column:
    """The ledger's integer: bit i is set where rule i fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules)]
    total = F.lit(0)
    for bit in bits:
        total = total.bitwiseOR(bit)
    return total.cast("long")


def ledger(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``df`` without its text, plus measurements and ``failed`` (long), one row per input row."""
    return measure(df, text).withColumn("failed", failure_bits(rules)).drop(text)


def kept(policy: Policy = DEFAULT, failed: str = "failed") -> Column:
    """True where no rule of the policy failed."""
    return F.col(failed).bitwiseAND(F.lit(policy.mask)) == 0


def ablation(ledger_rows: DataFrame, policy: Policy = DEFAULT, by: Sequence[str] = ()) -> DataFrame:
    """What each rule of a policy does, from the ledger alone: one row per rule (and group ``by``)
    with the number of rows it fails, that it alone rejects, and that stay without it.

    The failure sets are counted first (at most 2^rules rows per group), rules are unfolded after.
    An empty ledger gives no row.
    """
    inside = F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("sets")
    counts = ledger_rows.select(*by, inside).groupBy(*by, "sets").agg(F.count(F.lit(1)).alias("n"))
    bits = [(i, r.name) for i, r in enumerate(RULES) if r.name in policy.rules]
    each = F.array(*[F.struct(F.lit(1 << i).cast("long").alias("bit"), F.lit(n).alias("rule")) for i, n in bits])
    hit = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return counts.select(*by, "sets", "n", F.inline(each)).groupBy(*by, "rule").agg(
        hit(F.col("sets").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        hit(F.col("sets") == F.col("bit")).alias("n_only_this"),
        hit(F.col("sets").bitwiseAND(F.bitwise_not("bit")) == 0).alias("n_kept_without"),
    )


def op9_quality_ledger(spark, sf_dir: str) -> DataFrame:
    """The ledger of all documents with the base verdict and the default policy's."""
    rows = ledger(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~kept(BASE)).alias("base_failed"), kept(DEFAULT).alias("kept"), "failed", "n_lines", "n_upper", "n_same_next")


ORACLE_OP9 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
g AS (
  SELECT r, unnest(generate_series(1, len(words) - 7)) AS i, words FROM w WHERE len(words) >= 8),
k AS (SELECT r, i, array_to_string(words[i:i+7], ' ') AS s FROM g),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM k) WHERE n > 1),
gap AS (SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS c FROM dup),
rep AS (SELECT r, sum(c)::BIGINT AS n_repeat_words FROM gap GROUP BY r),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    (length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')))::BIGINT AS n_upper,
    len(list_filter(generate_series(1, len(words) - 1), lambda i: words[i] = words[i + 1]))::BIGINT AS n_same_next
  FROM w LEFT JOIN rep USING (r)),
f AS (
  SELECT *, ((n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
    + 4 * (10 * n_symbols > 3 * n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
    + 16 * (word_chars < 2 * n_words OR word_chars > 24 * n_words)::BIGINT
    + 32 * (2 * n_upper > word_chars)::BIGINT + 64 * (10 * n_same_next > 3 * n_words)::BIGINT)::BIGINT AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed, n_lines, n_upper, n_same_next
FROM f
"""
