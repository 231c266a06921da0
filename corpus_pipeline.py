"""Corpus pipeline: rules, near duplicates, decontamination, secrets, tokens, each stage over all its predecessor kept.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents. Columns besides those are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.llm import bpe, decontaminate, ngram_join, quality_rules, secret_scan
from siltstone.llm._base import settle
from siltstone.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by 5-word shingles at 0.75 or more."""
    return ngram_join.first_of_each(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, each secret in its text replaced by its kind, and n_chars counted anew."""
    rest = [c for c in COLUMNS if c not in ("text", "n_chars")]
    field = secret_scan.learned(docs)
    found = secret_scan.scan(docs.select(*COLUMNS), field, rest)
    return found.withColumn("text", F.col("redacted")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as token ids, with the digest of what they decode to."""
    rest = [c for c in COLUMNS if c != "text"]
    made = bpe.encode_texts(docs.select(*COLUMNS), tokenizer_path(), rest)
    return made.select(*rest, F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontamination), ("secret_scan", secrets), ("bpe", tokens)]

#: The first, fourth and fifth stages are not for SQL (hashed ratios, a random field, a tokenizer); tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
