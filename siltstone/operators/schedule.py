"""Fetch scheduling: interleave by domain, circuit breaker, delays, robots rules, extractor routing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.operators.meta import windowed_rank

#: Seconds between requests to one and to different domains, and failures that block a domain.
SAME_DOMAIN, OTHER_DOMAIN, BREAKER = 2.0, 0.5, 3


def round_robin(df: DataFrame, domain: str = "domain", pos: str = "pos") -> DataFrame:
    """`df` with turn and queue; ordered by these, each round takes one row of each domain in order of first appearance."""
    return windowed_rank(df, domain, pos)


def breaker(log: DataFrame, domain: str = "domain", ok: str = "ok", pos: str = "pos", failures: int = BREAKER) -> DataFrame:
    """`log` with blocked: whether the domain had `failures` consecutive failures before this attempt."""
    by = Window.partitionBy(domain).orderBy(pos)
    recent = F.sum(F.when(F.col(ok), 0).otherwise(1)).over(by.rowsBetween(1 - failures, 0))
    tripped = F.min(F.when(recent == failures, F.col(pos))).over(Window.partitionBy(domain))
    return log.withColumn("blocked", F.coalesce(F.col(pos) > tripped, F.lit(False)))


def delays(df: DataFrame, order: list[str], domain: str = "domain", crawl_delay: Column | None = None) -> DataFrame:
    """`df` with wait, the least seconds before each request; the random part is left out. Rows are one global
    sequence by nature; run it on the queue of one crawler (`queue_of`), not on a whole corpus."""
    before = F.lag(domain).over(Window.partitionBy("queue_of").orderBy(*order))
    asked = F.nullif(crawl_delay, F.lit(0.0)) if crawl_delay is not None else F.lit(None).cast("double")
    same = F.greatest(F.coalesce(asked, F.lit(SAME_DOMAIN)), F.lit(0.0))
    return df.withColumn("wait", F.when(before.isNull(), 0.0).when(before == F.col(domain), same).otherwise(OTHER_DOMAIN))


def fallback(df: DataFrame, first: str = "service", second: str = "library") -> DataFrame:
    """`df` (method, a struct `first` and a struct `second` of success and content) with `result`: the library's
    answer where that is the method, or where the service failed; never the reverse."""
    use_second = (F.col("method") == "library") | ~F.col(f"{first}.success")
    return df.withColumn("result", F.when(use_second, F.col(second)).otherwise(F.col(first)))


@lru_cache(maxsize=4096)
def _rules(body: str):
    from urllib.robotparser import RobotFileParser

    parser = RobotFileParser()
    parser.parse(body.splitlines())
    return parser


def robots(df: DataFrame, agent: str, any_agent: bool = False) -> DataFrame:
    """`df` (url, status, body) with allowed and crawl_delay. 404 and 410 allow all, as does whatever was not read.
    `any_agent` also allows what the rules for * allow, even where the agent's own forbid it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            allowed, delay = [], []
            get = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
            for url, status, body in zip(get("url"), get("status"), get("body"), strict=True):
                rules = _rules(body or "") if status == 200 else None
                allowed.append(rules is None or rules.can_fetch(agent, url or "") or (any_agent and rules.can_fetch("*", url or "")))
                wait = None if rules is None else rules.crawl_delay(agent) or rules.crawl_delay("*")
                delay.append(None if wait is None else float(wait))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(allowed, pa.bool_()), pa.array(delay, pa.float64())], names=[*batch.schema.names, "allowed", "crawl_delay"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, allowed boolean, crawl_delay double")
