"""The queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import bpe, context_mixing, decontaminate, language_id, ngram_join, quality_classifier, quality_rules, secret_scan, substring_dedup, url_filter


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer files are installed; the path is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quadratic_quality_classifier": lambda s, d: quality_classifier.op1(_docs(s, d), _labels(s, d)),
    "op2_temporal_url_filter": lambda s, d: url_filter.op2(s.read.parquet(f"{d}/pages.parquet")),
    "op3_fm_index_substring_dedup": lambda s, d: substring_dedup.op3(_docs(s, d)),
    "op4_hyperdimensional_language_id": lambda s, d: language_id.op4(_docs(s, d)),
    "op5_crf_secret_scan": lambda s, d: secret_scan.op5(_docs(s, d)),
    "op6_pigeonhole_jaccard_join": lambda s, d: ngram_join.op6(_docs(s, d)),
    "op7_chunked_bpe": lambda s, d: bpe.op7(_docs(s, d), tokenizer_path()),
    "op8_ngram_ratio_rules": lambda s, d: quality_rules.op8(_docs(s, d), _labels(s, d)),
    "op9_template_decontamination": lambda s, d: decontaminate.op9(_docs(s, d), s.read.parquet(f"{d}/benchmark.parquet")),
    "op10_context_mixing_lm": lambda s, d: context_mixing.op10(_docs(s, d)),
}

ORACLE_SQL: dict[str, str] = {
    "op2_temporal_url_filter": url_filter.ORACLE,
    "op3_fm_index_substring_dedup": substring_dedup.ORACLE,
    "op6_pigeonhole_jaccard_join": ngram_join.ORACLE,
    "op9_template_decontamination": decontaminate.ORACLE,
}
