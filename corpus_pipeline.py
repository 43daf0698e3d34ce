"""From raw documents to token ids: low quality out, one of each group of near copies, no benchmark items, no secrets.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the shared folder
and reads it again as the next stage's documents.

Defined cases, in all stages: null and empty texts are scored, joined and scanned as empty ones (near copies of nothing, so each
stays by the join); rows that repeat a doc_id are judged by their own text, and of rows of equal id and set of shingles one stays;
a null doc_id stays in the join; further columns go through every stage but the last, whatever their names; texts of any length
are taken whole; empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.llm import bpe, decontam, jaccard, quality, secrets
from plenum.llm.common import table, written
from plenum.llm.queries import VOCABULARY


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.rejected_removed(docs, quality.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; n_chars follows the text."""
    return secrets.redact(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each text, and whether they decode to its bytes."""
    path = public_tokenizers.path(VOCABULARY)
    coded = bpe.round_trip(docs.select("doc_id", "text", "lang", "source"), path, public_tokenizers.PATTERN)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"), exact.alias("round_trip"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level BPE encoding and decoding", encoded),
]

#: A learned model and hashed templates decide what stays: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
