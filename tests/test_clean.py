from pyspark.sql import functions as F

from siltstone.operators import clean


def flags(spark, rule, *lines):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, s string")
    return [r.f for r in rows.select("i", rule(F.col("s")).alias("f")).orderBy("i").collect()]


def cleaned(spark, text, rules=clean.NEWS):
    return clean.clean_content(spark.createDataFrame([(text,)], "text string"), rules=rules).first().content


def test_line_rules(spark):
    link = "[a](http://x)"
    assert flags(spark, clean.is_link_heavy, link * 3, link * 2, link * 3 + "x" * 19, link * 3 + "x" * 20) == [True, False, True, False]
    assert flags(spark, clean.is_tag_line, "[a](b)" + "中" * 9, "[a](b)" + "中" * 10, "plain") == [True, False, False]
    assert flags(spark, clean.is_short, "abc", "abcd", "ab.", "", "好") == [True, False, False, False, True]
    assert flags(spark, clean.is_template, "{{ x }}", "{{ x }}" + "y" * 112, "{{ x }}" + "y" * 113) == [True, True, False]
    assert flags(spark, clean.is_noise, "請繼續往下閱讀", "###### x", "More", "More text", "▼ pic", "") == [True, True, True, False, True, False]


def test_clean_order(spark):
    assert cleaned(spark, "\n\nfirst line\nMore\nsecond line\n延伸閱讀 rest\nafter") == "first line\n\nsecond line"
    assert cleaned(spark, "first line\n\n\n\nsecond line") == "first line\n\nsecond line"
    assert cleaned(spark, None) == ""
    assert cleaned(spark, "") == ""
    assert len(cleaned(spark, "x" * 50_001)) == 50_000
    assert cleaned(spark, "first line\n新聞授權\nsecond line") == "first line\n\nsecond line"  # the line rule goes before the late cut


def test_gate(spark):
    reason = lambda *xs: flags(spark, clean.quality_reason, *xs)
    body = "中" * 60 + "\n\n" + "文" * 60
    assert reason("", None, "中" * 99, "a" * 100, "中" * 19 + "a" * 100, "中" * 100, body) == ["Empty content", "Empty content", "Too short (99 < 100 chars)", "Insufficient Chinese (0 chars)", "Insufficient Chinese (19 chars)", "Too few paragraphs (1 < 2)", "OK"]


def test_full_page(spark):
    link = "[a](b)\n"
    assert flags(spark, clean.is_full_page, "  \n<!DOCTYPE html>", "<!doctype html>", link * 4, link * 5, "[a](b) " * 9, "x\n" * 20 + link * 5) == [True, False, False, True, False, False]


def test_body(spark):
    page = "<html>\nnav\n# 標題三字\n\n2026/03/08 10:00 記者王小明／台北報導\n內文一\n內文二\n延伸閱讀\nfoot"
    row = clean.article_body(spark.createDataFrame([(page,)], "text string")).first()
    assert (row.body, row.h1_title, row.byline_author) == ("內文一\n內文二", "標題三字", "王小明")
    plain = clean.article_body(spark.createDataFrame([("just text",), (None,)], "text string")).collect()
    assert [r.body for r in plain] == ["just text", None]


def test_end_markers(spark):
    at = lambda x: clean.end_at(F.split(x, "\n"))
    assert flags(spark, at, "a\n" + "x" * 100 + "上一則", "a\n" + "x" * 75 + "相關新聞", "a\n" + "x" * 76 + "相關新聞") == [2, 2, 0]


def test_gate_counts_letters_of_the_beginning_first(spark):
    """Enough letters in the beginning settle it; else all count, also those past it."""
    late = "." * 2000
    rows = spark.createDataFrame([(0, "a" * 20 + late), (1, late + "a" * 20), (2, late + "a" * 19), (3, "a" + late + "b" * 18)], "i int, c string")
    got = rows.select("i", clean.quality_reason(F.col("c"), clean.LATIN).alias("r"))
    assert [r.r.split(" (")[0] for r in got.orderBy("i").collect()] == ["Too few paragraphs", "Too few paragraphs", "Insufficient Latin", "Insufficient Latin"]
    assert "substring" in got._jdf.queryExecution().analyzed().toString()
