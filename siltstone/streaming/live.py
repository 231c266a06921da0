"""Freshness and keep-first over streams; an extension of the batch operators, with state bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.text import title_hash


def live_articles(stream: DataFrame, hours: int = 6, at: str = "published_at") -> DataFrame:
    """Articles of a stream with a time, those later than the watermark dropped, the first of each URL within it."""
    marked = stream.where(F.col(at).isNotNull()).withColumn("title_hash", title_hash(F.col("title")))
    return marked.withWatermark(at, f"{hours} hours").dropDuplicatesWithinWatermark(["url"])


def live_counts(stream: DataFrame, window: str = "1 hour", hours: int = 6, at: str = "published_at") -> DataFrame:
    """Counts by source and window, final once the watermark has passed."""
    return stream.withWatermark(at, f"{hours} hours").groupBy(F.window(at, window), "source").agg(F.count("*").alias("n"))
