"""Sinks: API rows, batches, retrying delivery and the run report."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from siltstone.operators.news_rules import SOURCE_NAMES


def api_rows(df: DataFrame, names: dict[str, str] = SOURCE_NAMES) -> DataFrame:
    """Articles as the API takes them: source names mapped (unknown ones pass), published_at falls back to
    crawled_at, duplicate_urls beside the metadata, status added."""
    table = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    meta = F.struct("article_type", "max_similarity", "cluster_size", "is_primary")
    return df.withColumns({"source": F.coalesce(F.element_at(table, F.col("source")), F.col("source")), "published_at": F.coalesce("published_at", "crawled_at"), "dedup_metadata": meta, "status": F.lit("deduplicated")})


def batches(df: DataFrame, order: str = "pos", size: int = 50, queue: str | None = None) -> DataFrame:
    """`df` with batch, in chunks of `size` in order. With `queue`, each queue is numbered by itself, and no
    task sees all rows; without one, rows are numbered from counts by partition of a range sort."""
    if queue:
        return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(queue).orderBy(order)) - 1) / size))
    ranged = df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id())
    local = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(order)))
    before = local.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    return local.join(F.broadcast(before), "_part").withColumn("batch", F.floor((F.col("_n") + F.col("_before") - 1) / size)).drop("_part", "_n", "_before")


def deliver(df: DataFrame, post: Callable[[list[dict]], tuple[int, bool]], dry_run: bool = False, key: str | None = "", tries: int = 3, first_wait: float = 5.0) -> DataFrame:
    """(batch, accepted, rejected) of each batch of `df`. `post` returns an HTTP status and success. Server errors
    are tried again with doubled waits, client errors and refusals are not. A dry run accepts all; without a
    key all is rejected. Spark may run a task twice, so receivers should take article_id as the key."""
    size = df.groupBy("batch").agg(F.count("*").alias("n"))
    if dry_run:
        return size.select("batch", F.col("n").alias("accepted"), F.lit(0).cast("long").alias("rejected"))
    if not key:
        return size.select("batch", F.lit(0).cast("long").alias("accepted"), F.col("n").alias("rejected"))

    def send(pdf):
        import pandas as pd

        wait, ok = first_wait, False
        for attempt in range(tries):
            status, ok = post(pdf.to_dict("records"))
            if status < 500:
                break
            if attempt + 1 < tries:
                time.sleep(wait)
                wait *= 2
        n = len(pdf)
        return pd.DataFrame({"batch": [pdf["batch"].iloc[0]], "accepted": [n if ok else 0], "rejected": [0 if ok else n]})

    return df.groupBy("batch").applyInPandas(send, "batch long, accepted long, rejected long")


def report(stats: DataFrame, articles: DataFrame, path: str, run_time: str) -> None:
    """Articles as JSON lines in `path`/articles, and one line of run_time and counts in `path`/run."""
    articles.write.mode("overwrite").json(f"{path}/articles")
    stats.withColumn("run_time", F.lit(run_time)).coalesce(1).write.mode("overwrite").json(f"{path}/run")
