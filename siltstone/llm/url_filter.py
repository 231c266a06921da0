"""URL filters as a temporal list join.

List entries are dated events: at `at`, `value` of a `kind` is added to or removed from a `list`. Each
addition becomes a validity interval that ends at the next event of the same list, kind and value. A
capture is evaluated as of its fetch time: its keys (host suffixes, host labels, host-and-path prefixes)
are equi-joined with the entries and kept where from <= fetch_time < to. Intervals of one value are
disjoint, so a key meets at most one interval of a list.

The entries are broadcast when counted to be few, else both sides are dealt by key, and AQE splits a hot key.

Defined cases: a null or unparsable URL has no keys, a null fetch time meets no interval, both are not
blocked; of events at one instant the last (by entry_id) holds; entries with null at, kind, value or
action are ignored; repeated entries or captures change nothing and are each answered; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from siltstone.llm._base import sized

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"

#: The query's list, dated. Fixed values of this operator.
ENTRIES = [
    (1, "spam", "label", "spam-farm", "add", "2024-01-01"), (2, "spam", "label", "cheap-pills", "add", "2024-02-01"), (3, "spam", "label", "cheap-pills", "remove", "2024-06-01"), (4, "spam", "label", "cheap-pills", "add", "2024-09-01"),
    (5, "gambling", "label", "casino-win", "add", "2024-01-01"), (6, "gambling", "label", "free-bets", "add", "2024-03-15"), (7, "adult", "label", "adult-x", "add", "2024-01-01"), (8, "ads", "label", "ads-track", "add", "2024-01-01"), (9, "ads", "label", "ads-track", "remove", "2024-11-01"),
    (10, "adult", "domain", "adult-x.example.com", "add", "2024-05-01"), (11, "retracted", "prefix", "tionsh.example.net/de/", "add", "2024-04-01"), (12, "retracted", "prefix", "tionsh.example.net/de/", "remove", "2024-08-01"), (13, "mirror", "domain", "example.org", "add", "2024-10-01"), (14, "mirror", "domain", "example.org", "remove", "2024-10-15"),
]
DAY_ZERO = "2024-01-01"


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, value, entry_id, from_, to_) of every addition; to_ is null while it holds."""
    known = entries.where("at is not null and kind is not null and value is not null and action in ('add', 'remove')")
    order = Window.partitionBy("list", "kind", "value").orderBy("at", "entry_id")
    out = known.withColumn("to_", F.lead("at").over(order)).where("action = 'add' and (to_ is null or to_ > at)")
    return out.select("list", "kind", F.lower("value").alias("value"), "entry_id", F.col("at").alias("from_"), "to_")


def keyed(captures: DataFrame) -> DataFrame:
    """(page_id, url, fetch_time, kind, value): every key of every distinct capture."""
    host, path = F.lower(F.regexp_extract("url", HOST, 1)), F.regexp_extract("url", PATH, 1)
    out = captures.select("page_id", "url", "fetch_time").distinct().withColumns({"labels": F.split(host, r"\."), "steps": F.split(path, "/"), "host": host}).where("host != ''")
    suffix = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice("labels", i, F.size("labels")), ".").alias("value")))
    label = F.transform(F.array_distinct("labels"), lambda x: F.struct(F.lit("label").alias("kind"), x.alias("value")))
    cut = lambda i: F.concat("host", F.array_join(F.slice("steps", F.lit(1), i), "/"), F.lit("/"))
    prefix = F.when(F.size("steps") > 1, F.transform(F.sequence(F.lit(1), F.size("steps") - 1), lambda i: F.struct(F.lit("prefix").alias("kind"), F.lower(cut(i)).alias("value"))))
    every = F.concat(suffix, label, F.coalesce(prefix, F.array().cast("array<struct<kind: string, value: string>>")))
    return out.select("page_id", "url", "fetch_time", F.explode(F.array_distinct(every)).alias("key")).select("page_id", "url", "fetch_time", "key.*")


def evaluate(captures: DataFrame, entries: DataFrame, most_broadcast: int = 200_000) -> DataFrame:
    """One row for each row of `captures`: page_id, url, fetch_time, blocked, the lists and entries that hold."""
    held = keyed(captures).join(sized(intervals(entries), most_broadcast), ["kind", "value"])
    held = held.where((F.col("from_") <= F.col("fetch_time")) & (F.col("to_").isNull() | (F.col("fetch_time") < F.col("to_"))))
    found = held.groupBy(F.col("page_id").alias("_p"), F.col("url").alias("_u"), F.col("fetch_time").alias("_t")).agg(F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"), F.array_join(F.array_sort(F.collect_set("entry_id")), ",").alias("entries"))
    rows = captures.select("page_id", "url", "fetch_time")
    out = rows.join(found, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("url") == F.col("_u")) & (F.col("fetch_time") == F.col("_t")), "left")
    return out.select("page_id", "url", "fetch_time", F.col("_u").isNotNull().alias("blocked"), F.coalesce("lists", F.lit("")).alias("lists"), F.coalesce("entries", F.lit("")).alias("entries"))


def listed(spark: SparkSession) -> DataFrame:
    """The query's list as a table."""
    rows = spark.createDataFrame(ENTRIES, "entry_id long, list string, kind string, value string, action string, at string")
    return rows.withColumn("at", F.to_timestamp("at"))


def op2(pages: DataFrame) -> DataFrame:
    """The query: `pages` has no fetch time, so page n counts as fetched on day n mod 366 of 2024."""
    fetched = F.to_timestamp(F.lit(DAY_ZERO)) + F.make_interval(days=F.pmod("page_id", F.lit(366)).cast("int"))
    return evaluate(pages.select("page_id", "url", fetched.alias("fetch_time")), listed(pages.sparkSession)).withColumn("fetch_time", F.date_format("fetch_time", "yyyy-MM-dd"))


_VALUES = ", ".join(f"({i}, '{n}', '{k}', '{v}', '{a}', TIMESTAMP '{t}')" for i, n, k, v, a, t in ENTRIES)
ORACLE = rf"""
WITH e(entry_id, li, kind, va, act, since) AS (VALUES {_VALUES}),
iv AS (SELECT * FROM (SELECT *, lead(since) OVER (PARTITION BY li, kind, va ORDER BY since, entry_id) AS to_ FROM e) WHERE act = 'add' AND (to_ IS NULL OR to_ > since)),
c AS (SELECT row_number() OVER () AS rid, page_id, url, TIMESTAMP '{DAY_ZERO}' + to_days((page_id % 366)::INT) AS ft, lower(regexp_extract(url, '{HOST}', 1)) AS host, lower(regexp_extract(url, '{PATH}', 1)) AS path FROM pages),
hit AS (SELECT DISTINCT rid, li, entry_id FROM c JOIN iv ON since <= ft AND (to_ IS NULL OR ft < to_) AND host <> '' AND (
  (kind = 'domain' AND (host = va OR suffix(host, '.' || va))) OR (kind = 'label' AND list_contains(string_split(host, '.'), va)) OR (kind = 'prefix' AND path <> '' AND starts_with(host || path, va)))),
g AS (SELECT rid, string_agg(DISTINCT li, ',' ORDER BY li) AS lists, string_agg(entry_id::VARCHAR, ',' ORDER BY entry_id) AS entries FROM hit GROUP BY rid)
SELECT page_id, url, strftime(ft, '%Y-%m-%d') AS fetch_time, g.rid IS NOT NULL AS blocked, coalesce(lists, '') AS lists, coalesce(entries, '') AS entries FROM c LEFT JOIN g USING (rid)
"""
