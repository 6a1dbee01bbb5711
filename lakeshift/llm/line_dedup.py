"""Line de-duplication over a corpus.

Lines are exploded with their position, normalised and hashed; distinct documents per hash are
counted; a line found in too many of them stays only in the document with the largest id. What
travels through the shuffles are hashes and positions. The texts move once, when the positions to
drop come back to their document and the kept lines are put together again by position.

A line that a third of all documents hold is no hot group: documents are counted with partial
sums per (hash, document), and the join back on the hash is an ordinary join that adaptive
execution splits where one hash is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import BLANKS, join_splittable, table, text_or_empty

MIN_CHARS = 40
MIN_DOCS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A-Z in lower case (other letters as they are)."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hash(*columns) -> Column:
    """128 bits of hash, so that different lines of a large corpus do not meet."""
    return F.struct(
        F.xxhash64(F.lit(1), *columns).alias("a"), F.xxhash64(F.lit(2), *columns, F.lit(3)).alias("b"))


def dedup_lines(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    n_lines: str | None = None,
    n_dropped: str | None = None,
) -> DataFrame:
    """``df`` with its text cut: keys of at least ``min_chars`` code points found in at least
    ``min_docs`` documents (ids) lose all their lines except in the largest id holding them.

    Lines are what ``\\n`` splits; kept ones are joined by it again. ``n_lines`` / ``n_dropped``
    name further result columns (long): lines before dropping, lines dropped.
    - null or empty text: one empty line, never dropped; the text comes back as it was
    - a text all of whose lines go becomes empty
    - null id: a document of its own kind, smaller than any other; rows that share an id are one
      document for counting, and each loses the same lines
    - extra columns are kept; inner columns are nested, so names cannot clash
    """
    columns = [F.col(f"`{c}`").alias(c) for c in df.columns]
    body = text_or_empty(F.col(f"`{text}`"))
    docs = df.select(F.struct(*columns).alias("row"), F.col(f"`{id_column}`").alias("id"), _hash(body).alias("of"))
    lines = (
        df.select(F.col(f"`{id_column}`").alias("id"), _hash(body).alias("of"), F.posexplode(F.split(body, "\n")).alias("pos", "line"))
        # Blanks only shorten a line, so shorter ones are out before the key is made.
        .where(F.length("line") >= min_chars)
        .select("id", "of", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", "of", "pos", _hash(F.col("key")).alias("hash"))
    )
    # One row per (hash, document), then per hash; both steps add up on the mapper's side first.
    common = (
        lines.groupBy("hash", "id").agg(F.lit(1).alias("one"))
        .groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("hash", "keeper")
    )
    doomed = (
        join_splittable(lines, common, ["hash"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "of").agg(F.collect_set("pos").alias("gone"))
        .withColumnsRenamed({"id": "gone_id", "of": "gone_of"})
    )
    joined = docs.join(
        doomed, docs["id"].eqNullSafe(doomed["gone_id"]) & (docs["of"] == doomed["gone_of"]), "left")
    old = F.col("row")[text]
    parts = F.split(text_or_empty(old), "\n")
    # array_except is a hash set over positions: linear, and in order of position.
    rest = F.expr("array_except(sequence(0, size(parts) - 1), gone)")
    cut = joined.select("row", "gone", parts.alias("parts")).select(
        "row", F.size("parts").cast("long").alias("lines"), F.coalesce(F.size("gone"), F.lit(0)).alias("lost"),
        F.when(F.col("gone").isNull(), old).otherwise(
            F.array_join(F.transform(rest, lambda i: F.get("parts", i)), "\n")).alias("cut"))
    out = [F.col("cut").alias(c) if c == text else F.col("row")[c].alias(c) for c in df.columns]
    if n_lines:
        out.append(F.col("lines").alias(n_lines))
    if n_dropped:
        out.append(F.greatest("lost", F.lit(0)).cast("long").alias(n_dropped))
    return cut.select(*out)


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Line counts and the digest of what is kept, for all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    cut = dedup_lines(docs, n_lines="n_lines", n_dropped="n_dropped")
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(text_or_empty("text"), 256).alias("kept_sha256"))


ORACLE_CUT = r"""
lines_ AS (
  SELECT r, doc_id, text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
    unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM numbered_),
keys_ AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines_),
common_ AS (
  SELECT key, max(doc_id) AS keeper FROM keys_ WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked_ AS (
  SELECT keys_.*, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM keys_ LEFT JOIN common_ USING (key)),
cut_ AS (
  SELECT r, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM marked_ GROUP BY r)
"""
ORACLE_OP3 = (
    "WITH numbered_ AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),"
    + ORACLE_CUT
    + "SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM cut_ JOIN numbered_ USING (r)"
)
