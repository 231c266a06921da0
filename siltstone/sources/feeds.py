"""Scans of landed feeds: RSS items, JSON API pages and news sitemaps, each with a stated schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.functions.text import canonical_url, clean_html, entry_category, noon_bump, parse_time, strip
from siltstone.operators.dedup import keep_first

def _placed(df: DataFrame) -> DataFrame:
    """With the order of reading: file by name, block of the file, and `pos`, the place in it. Spark reads large files
    first, so `pos` alone, or the number of the task, says nothing about files."""
    return df.withColumns({"pos": F.monotonically_increasing_id(), "_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")})


def _first(df: DataFrame) -> DataFrame:
    order = [c for c in ("_file", "_block", "pos") if c in df.columns]
    return keep_first(df, ["source", "url"], order).drop("_file", "_block")


def rss(spark: SparkSession, path: str, source: str, category: str, prefix: str | None = None, replace: tuple[str, str] | None = None) -> DataFrame:
    """Items with a title and a usable link, the first of each URL."""
    schema = "title string, link string, pubDate string, description string, category array<string>"
    raw = _placed(spark.read.format("xml").option("rowTag", "item").schema(schema).load(path))
    url = canonical_url(strip(F.col("link")), prefix, replace)
    tag = F.get("category", F.lit(0))
    out = raw.select(F.lit(source).alias("source"), strip(F.col("title")).alias("title"), url.alias("url"), parse_time(F.col("pubDate")).alias("published_at"), F.substring(clean_html(F.coalesce("description", F.lit(""))), 1, 500).alias("summary"), entry_category(tag, F.lit(category)).alias("feed_category"), "pos", "_file", "_block")
    return _first(out.where("title != '' and url is not null and url != ''"))


def json_api(spark: SparkSession, path: str, source: str, category: str, prefix: str, most_pages: int = 5) -> DataFrame:
    """Landed pages {page, status, lists, end}: rows before the first page that fails, is empty or says end
    (that page's own rows count if it says end), the first of each URL."""
    schema = "page int, status int, end boolean, lists array<struct<title: string, titleLink: string, cate_name: string, time: struct<date: string>>>"
    pages = spark.read.schema(schema).json(path).where(F.col("page") < most_pages)
    bad = (F.coalesce("status", F.lit(200)) != 200) | (F.coalesce(F.size("lists"), F.lit(0)) <= 0)
    stop = pages.agg(F.min(F.when(bad, F.col("page"))).alias("bad"), F.min(F.when(F.col("end"), F.col("page"))).alias("end")).first()
    limit = min(stop.bad if stop.bad is not None else most_pages, stop.end + 1 if stop.end is not None else most_pages)
    rows = pages.where(F.col("page") < limit).select("page", F.posexplode("lists").alias("i", "x"))
    url = F.concat(F.lit(prefix), F.substring_index("x.titleLink", "?", 1))
    out = rows.where("x.title != '' and x.titleLink != ''").select(F.lit(source).alias("source"), strip(F.col("x.title")).alias("title"), url.alias("url"), parse_time(F.col("x.time.date")).alias("published_at"), F.lit("").alias("summary"), F.coalesce("x.cate_name", F.lit(category)).alias("feed_category"), (F.col("page").cast("long") * 1_000_000 + F.col("i")).alias("pos"))
    return _first(out)


def sitemap(spark: SparkSession, path: str, source: str, category: str) -> DataFrame:
    """News sitemap entries: a URL counts as seen at its first entry, titled or not; dates without a time are noon."""
    schema = "loc string, `news:news` struct<`news:title`: string, `news:publication_date`: string>"
    raw = _placed(spark.read.format("xml").option("rowTag", "url").schema(schema).load(path))
    date: Column = strip(F.col("`news:news`.`news:publication_date`"))
    out = raw.select(F.lit(source).alias("source"), strip(F.col("`news:news`.`news:title`")).alias("title"), strip(F.col("loc")).alias("url"), noon_bump(parse_time(date), date).alias("published_at"), F.lit("").alias("summary"), F.lit(category).alias("feed_category"), "pos", "_file", "_block")
    return _first(out.where("url != ''")).where("title != ''")
