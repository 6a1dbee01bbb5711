"""A training corpus from raw documents, in five stages built on the operators of lakeshift.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns
of ``documents``. ``run`` writes every stage's result as Parquet in the shared folder and reads it
again, so that later stages neither repeat earlier work nor depend on its lineage.

Stages bear nulls, empty texts and repeated rows as their operators say. A document whose lines
all go stays as an empty text; near-duplicate removal keeps the smallest doc_id of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm import bpe, decontaminate, jaccard, line_dedup, quality
from lakeshift.llm.common import table
from lakeshift.session import scratch_path


def _same_columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, its character count (if there is one) brought up to date."""
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return df.select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the default policy rejects, with all their columns, whatever their
    names. Null and empty texts have too few words; very long texts are read whole; repeated rows
    are judged each."""
    # The row travels in one column, so that none of its names meets a measurement's.
    whole = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("row"), F.col("text").alias("body"))
    ledger = quality.measure(whole, "body").withColumn("failed", quality.failure_bits())
    return ledger.where(quality.kept(quality.DEFAULT, "failed")).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that many documents share stay in the document with the largest id. A document
    whose lines all go stays as an empty text; null texts are read as empty ones."""
    return _same_columns(line_dedup.dedup_lines(docs), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id. Null ids are
    classed by their text, and one of all texts without words stays; of rows with equal id and text
    one stays, chosen by its other columns."""
    return jaccard.drop_near_duplicates(docs, null_ids=True)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; items of one to four words must stand word by word.
    Ids do not matter: the same text under any id, or none, goes as well."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), short_items=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with the digest of the text they decode to: doc_id, lang, source,
    n_tokens, ids, decoded_sha256. Other columns, the text too, are left out; null texts are empty."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), bpe.default_path(), decoded="decoded")
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("drop_repeated_lines", drop_repeated_lines),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_benchmark", drop_benchmark),
    ("encode", encode),
]

#: BPE ids and MinHash bands have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
