"""Article metadata: normalising, union of sources, freshness, topics and run counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.functions.text import strip, title_hash
from siltstone.operators.dedup import keep_first
from siltstone.operators.news_rules import CATEGORIES, KEPT_CATEGORIES


def article_meta(df: DataFrame, default_category: str = "綜合") -> DataFrame:
    """(source, title, url, published_at, summary, feed_category, title_hash) with stripped fields."""
    title = strip(F.col("title"))
    return df.select(
        "source", title.alias("title"), strip(F.col("url")).alias("url"), "published_at",
        F.coalesce(F.substring("summary", 1, 500), F.lit("")).alias("summary"), F.coalesce("feed_category", F.lit(default_category)).alias("feed_category"), title_hash(title).alias("title_hash"),
    )


def union_sources(sources: list[DataFrame], key: str = "url") -> DataFrame:
    """All sources in order, each row with `source_order` and `pos`; the first row of each key stays."""
    out = None
    for i, df in enumerate(sources):
        part = df.withColumn("source_order", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return keep_first(out, [key], ["source_order", "pos"])


def fresh(df: DataFrame, now: Column, hours: int = 6, at: str = "published_at") -> DataFrame:
    """Rows not older than `hours`, or without a time; these come last (`fresh_order`, then pos)."""
    return df.where(F.col(at).isNull() | (F.col(at) >= now - F.make_interval(hours=F.lit(hours)))).withColumn("fresh_order", F.col(at).isNull().cast("int"))


def classifier_input(title: Column, summary: Column) -> Column:
    """Title, and 200 characters of the summary if there is one."""
    return F.when(F.coalesce(summary, F.lit("")) != "", F.concat(title, F.lit(" "), F.substring(summary, 1, 200))).otherwise(title)


def topics(df: DataFrame, logits: str = "logits", labels: list[str] = CATEGORIES, kept: list[str] | None = None) -> DataFrame:
    """`df` with keep, score, topic (null if not kept) and all_scores, from a classifier's logits. The first of
    equal scores wins; an empty `kept` means the default."""
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x.cast("double") - top.cast("double")))
    df = df.withColumn("_p", powers)
    total = F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)
    df = df.withColumn("_total", total).withColumn("_at", F.array_position("_p", F.array_max("_p")).cast("int"))
    names = F.array(*(F.lit(x) for x in labels))
    label = F.element_at(names, F.col("_at"))
    keep = label.isin(*(kept or KEPT_CATEGORIES))
    scores = F.map_from_arrays(names, F.transform("_p", lambda x: F.round(x / F.col("_total"), 4)))
    out = df.withColumns({"keep": keep, "score": F.element_at("_p", F.col("_at")) / F.col("_total"), "topic": F.when(keep, label), "all_scores": scores})
    return out.drop("_p", "_total", "_at")


def ranked_counts(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """(key, n) with the largest first, ties in order of first appearance."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(pos).alias("_first")).orderBy(F.desc("n"), "_first").drop("_first")


def run_counts(df: DataFrame, status: str = "status", names: tuple[str, ...] = ("ok", "extract_failed", "quality_failed", "blocked", "robots_blocked", "duplicate")) -> DataFrame:
    """One row: how many rows have each status, and all, in one pass."""
    return df.agg(*(F.count_if(F.col(status) == n).alias(n) for n in names), F.count("*").alias("total_collected"))


def first_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in order; 0 means all."""
    return df.orderBy(*order).limit(n) if n else df


def windowed_rank(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """`df` with `turn`, its place within the key, and `queue`, where the key first appears."""
    return df.withColumns({"turn": F.row_number().over(Window.partitionBy(key).orderBy(pos)), "queue": F.min(pos).over(Window.partitionBy(key))})
