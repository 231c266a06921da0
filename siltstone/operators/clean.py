"""Article cleaning: line rules, late cut, body extraction, front matter and the quality gate.

All of it is one narrow stage: array functions over the lines of a text, no shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.text import HAN, LINK, blank, count_of, first_filled, pinned, strip, strip_html
from siltstone.operators import news_rules


@dataclass(frozen=True)
class RuleSet:
    """Lists and limits of the cleaner; the defaults are those of the news pack."""

    noise: list[str] = field(default_factory=lambda: news_rules.NOISE)
    strong: list[str] = field(default_factory=lambda: news_rules.STRONG_ENDS)
    weak: list[str] = field(default_factory=lambda: news_rules.WEAK_ENDS)
    late: list[str] = field(default_factory=lambda: news_rules.LATE_ENDS)
    script: str = HAN
    script_name: str = "Chinese"
    least_script: int = 20
    least_tag_text: int = 10
    least_heading: int = 3
    least_chars: int = 100
    least_paragraphs: int = 2
    most_chars: int = 50_000


NEWS = RuleSet()
#: For texts in Latin letters: no outlet rules, same limits.
LATIN = RuleSet(noise=[r"^\[\s*\]\(.*?\)\s*$", r"javascript:\s*void", r"All [Rr]ights [Rr]eserved"], strong=["All Rights Reserved"], weak=["Related articles"], late=["All Rights Reserved"], script="[A-Za-z]", script_name="Latin")
#: Fixed value: punctuation that saves a line of three characters or less.
SAVING = r"[.,;:!?。，；：！？、]"


def _any(patterns: list[str]) -> str:
    return "(?dU)" + "|".join(f"(?:{p})" for p in patterns) if patterns else r"(?!)"


def _contains(markers: list[str]) -> str:
    return "|".join(re.sub(r"([\\.\[\]{}()*+?^$|#&~-])", r"\\\1", m) for m in markers) if markers else r"(?!)"


def is_noise(s: Column, rules: RuleSet = NEWS) -> Column:
    return s.rlike(_any(rules.noise))


def is_link_heavy(s: Column) -> Column:
    """Three links or more and fewer than 20 other characters."""
    return s.contains("](") & (count_of(s, LINK) >= 3) & (F.length(strip(F.regexp_replace(s, LINK, ""))) < 20)


def is_tag_line(s: Column, rules: RuleSet = NEWS) -> Column:
    """Has a link, and little text of the rules' script beside links."""
    return s.contains("](") & (count_of(F.regexp_replace(s, LINK, ""), rules.script) < rules.least_tag_text)


def is_short(s: Column) -> Column:
    return F.length(s).between(1, 3) & ~s.rlike(SAVING)


def is_template(s: Column) -> Column:
    return s.contains("{{") & (F.length(s) < 120) & s.rlike(r"(?d)\{\{.*?\}\}")


def dropped(s: Column, rules: RuleSet = NEWS) -> Column:
    """Whether any line rule drops a stripped line; the costly rule comes last."""
    return is_short(s) | is_link_heavy(s) | is_tag_line(s, rules) | is_template(s) | is_noise(s, rules)


def _first(flags: Column) -> Column:
    """1-based place of the first true flag, 0 if there is none."""
    return F.coalesce(F.array_position(flags, F.lit(True)), F.lit(0)).cast("int")


def _before(lines: Column, at: Column) -> Column:
    """The lines before place `at`; all of them if it is 0."""
    return F.when(at > 0, F.slice(lines, F.lit(1), at - 1)).otherwise(lines)


def _trimmed(lines: Column) -> Column:
    """Without blank lines at both ends."""
    flags = F.transform(lines, lambda x: ~blank(x))
    first, last = _first(flags), _first(F.reverse(flags))
    return F.when(first == 0, F.slice(lines, 1, 0)).otherwise(F.slice(lines, first, F.size(lines) - first - last + 2))


def late_cut(lines: Column, rules: RuleSet = NEWS) -> Column:
    """The lines before the first that has a late marker."""
    return _before(lines, _first(F.transform(lines, lambda x: reduce(lambda a, m: a | strip(x).contains(m), rules.late, F.lit(False)))))


def paragraphs(joined: Column) -> Column:
    """Single newlines doubled where there is no paragraph break, and runs of newlines cut to two."""
    doubled = F.when(~joined.contains("\n\n"), F.replace(joined, F.lit("\n"), F.lit("\n\n"))).otherwise(joined)
    return F.regexp_replace(doubled, "\n{3,}", "\n\n")


def clean_content(df: DataFrame, source: str = "text", out: str = "content", rules: RuleSet = NEWS) -> DataFrame:
    """`df` with the cleaned `source` in `out`; null counts as empty."""
    lines = F.transform(F.split(F.coalesce(source, F.lit("")), "\n"), lambda x: F.struct(x.alias("line"), strip(x).alias("s")))
    df = df.withColumn("_lines", pinned(lines))  # stripped once a line, not once a rule
    df = df.withColumn("_lines", pinned(F.transform(F.filter("_lines", lambda x: ~dropped(x.s, rules)), lambda x: x.line)))
    df = df.withColumn("_lines", pinned(late_cut(F.col("_lines"), rules)))
    df = df.withColumn("_lines", pinned(_trimmed(F.col("_lines"))))
    df = df.withColumn("_lines", pinned(F.array_join("_lines", "\n")))
    df = df.withColumn("_lines", pinned(paragraphs(F.col("_lines"))))
    text = F.when(F.col("_lines").contains("<"), strip_html(F.col("_lines"))).otherwise(F.col("_lines"))
    return df.withColumn(out, pinned(strip(F.substring(text, 1, rules.most_chars)))).drop("_lines")  # gate, hash and length read it


def quality_reason(content: Column, rules: RuleSet = NEWS) -> Column:
    """OK, or the first check that fails with its count."""
    script = count_of(content, rules.script)
    # the script's letters are counted to the end only where the beginning has too few
    few = F.when(count_of(F.substring(content, 1, 40 * rules.least_script), rules.script) >= rules.least_script, False).otherwise(script < rules.least_script)
    parts = F.size(F.filter(F.split(content, "\n\n"), lambda p: ~blank(p)))
    text = lambda *xs: F.concat(*(x if isinstance(x, Column) else F.lit(x) for x in xs))
    return (
        F.when(F.coalesce(content, F.lit("")) == "", "Empty content")
        .when(F.length(content) < rules.least_chars, text("Too short (", F.length(content).cast("string"), f" < {rules.least_chars} chars)"))
        .when(few, text(f"Insufficient {rules.script_name} (", script.cast("string"), " chars)"))
        .when(parts < rules.least_paragraphs, text("Too few paragraphs (", parts.cast("string"), f" < {rules.least_paragraphs})"))
        .otherwise("OK")
    )


FRONT_KEYS = ("title", "description", "author", "date", "image")


def front_matter(df: DataFrame, source: str = "text", keys: tuple[str, ...] = FRONT_KEYS) -> DataFrame:
    """`df` with `front`, a map of the listed keys, and `body`. The block ends at the next --- anywhere; without
    one the text stays as it is. The last of equal keys wins."""
    has = F.col(source).startswith("---") & (F.locate("---", F.col(source), 4) > 0)
    block = F.split(strip(F.expr(f"substring(`{source}`, 4, locate('---', `{source}`, 4) - 4)")), "\n")

    def pair(line: Column) -> Column:
        key = F.lower(strip(F.substring_index(line, ":", 1)))
        value = strip(F.substring(line, F.instr(line, ":") + 1, F.length(line)))
        quoted = F.length(value) >= 2
        same = (F.substring(value, 1, 1) == F.substring(value, -1, 1)) & F.substring(value, 1, 1).isin('"', "'")
        return F.struct(key.alias("k"), F.when(quoted & same, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value).alias("v"))

    pairs = F.filter(F.transform(F.filter(block, lambda x: x.contains(":")), pair), lambda p: p.k.isin(*keys) & (p.v != ""))
    df = df.withColumn("_pairs", pinned(F.when(has, pairs).otherwise(F.array().cast("array<struct<k: string, v: string>>"))))
    value = lambda k: F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.transform(F.filter("_pairs", lambda p: p.k == k), lambda p: p.v)), -1)
    entries = F.filter(F.array(*(F.struct(F.lit(k).alias("k"), value(k).alias("v")) for k in keys)), lambda p: p.v.isNotNull())
    body = F.when(has, strip(F.expr(f"substring(`{source}`, locate('---', `{source}`, 4) + 3)"))).otherwise(F.col(source))
    return df.withColumn("front", F.map_from_entries(entries)).withColumn("body", body).drop("_pairs")


def is_full_page(text: Column) -> Column:
    """Starts as an HTML page, or five of its first 20 filled lines have a link."""
    head = F.regexp_replace(F.substring(text, 1, 600), r"(?U)^[\s\x1c-\x1f]+", "")
    lines = F.slice(F.filter(F.split(text, "\n"), lambda x: ~blank(x)), 1, 20)
    return head.startswith("<!DOCTYPE") | head.startswith("<html") | (F.size(F.filter(lines, lambda x: x.rlike(LINK))) >= 5)


def heading_at(lines: Column, rules: RuleSet = NEWS) -> Column:
    """1-based place of the first heading with enough letters of the script, 0 if there is none."""
    return _first(F.transform(lines, lambda x: strip(x).startswith("# ") & (count_of(strip(x), rules.script) >= rules.least_heading)))


def end_at(lines: Column, rules: RuleSet = NEWS) -> Column:
    """1-based place of the first line with a strong marker, or a weak one in under 80 characters; 0 if none."""
    ends = lambda s: s.rlike(_contains(rules.strong)) | (s.rlike(_contains(rules.weak)) & (F.length(s) < 80))
    return _first(F.transform(lines, lambda x: ends(strip(x))))


BYLINE = r"(?U)^(\d{4}[/-]\d{2}[/-]\d{2}\s+\d{2}:\d{2})\s*(.*)"
REPORTER = r"(?U)記者\s*(.+?)\s*[／/]"


def article_body(df: DataFrame, source: str = "text", rules: RuleSet = NEWS) -> DataFrame:
    """`df` with `body`, `h1_title` and `byline_author`: the part of a full page between its heading (and byline) and end."""
    df = df.withColumn("_full", is_full_page(F.col(source))).withColumn("_all", pinned(F.split(source, "\n")))
    df = df.withColumn("_h1", F.when(F.col("_full"), heading_at(F.col("_all"), rules)).otherwise(0))
    df = df.withColumn("_rest", pinned(F.slice("_all", F.col("_h1") + 1, F.greatest(F.size("_all") - F.col("_h1"), F.lit(0)))))
    df = df.withColumn("_next", _first(F.transform(F.slice("_rest", 1, 5), lambda x: ~blank(x))))
    line = strip(F.coalesce(F.get("_rest", F.col("_next") - 1), F.lit("")))
    df = df.withColumn("_line", F.when(F.col("_h1") > 0, line).otherwise(""))
    by = F.col("_line").rlike(BYLINE)
    df = df.withColumn("_rest", pinned(F.when(by, F.slice("_rest", F.col("_next") + 1, F.size("_rest"))).otherwise(F.col("_rest"))))
    author = F.when(by, F.nullif(F.regexp_extract(F.regexp_extract("_line", BYLINE, 2), REPORTER, 1), F.lit("")))
    body = F.when(~F.col("_full"), F.col(source)).when(F.col("_h1") == 0, strip_html(F.col(source))).otherwise(strip(F.array_join(_before(F.col("_rest"), end_at(F.col("_rest"), rules)), "\n")))
    title = F.when(F.col("_h1") > 0, strip(F.substring(strip(F.get("_all", F.col("_h1") - 1)), 3, 100_000)))
    return df.withColumns({"body": body, "h1_title": title, "byline_author": author}).drop("_full", "_all", "_h1", "_rest", "_next", "_line")


def clean_article(df: DataFrame, rules: RuleSet = NEWS) -> DataFrame:
    """Rows (raw, title, url, summary, source, feed_category, published_at, extractor_title) as articles with `reason`;
    those whose reason is OK passed the gate."""
    df = article_body(front_matter(df, "raw").withColumn("_front_body", F.col("body")), "_front_body", rules)
    df = clean_content(df, "body", "content_markdown", rules)
    front = lambda k: F.col("front")[k]
    return df.select(
        F.sha2("url", 256).alias("article_id"), F.sha2("content_markdown", 256).alias("content_hash"),
        first_filled(F.col("title"), front("title"), F.col("h1_title"), F.col("extractor_title")).alias("title"),
        F.substring(first_filled(front("description"), F.col("summary"), F.substring("content_markdown", 1, 200)), 1, 500).alias("summary"),
        F.coalesce(F.nullif(front("author"), F.lit("")), F.col("byline_author")).alias("author"),
        "content_markdown", F.length("content_markdown").alias("char_count"), "source", F.col("url").alias("primary_url"), "published_at", "feed_category", quality_reason(F.col("content_markdown"), rules).alias("reason"),
    )
