from pyspark.sql import functions as F

from siltstone.functions import text as T


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "x string").select(make(F.col("x")).alias("y")).first().y


def test_strip_takes_all_white_space(spark):
    assert one(spark, "　\x1c a b \n", T.strip) == "a b"


def test_html(spark):
    assert one(spark, "<p>a &amp; b</p> ", T.clean_html) == "a &amp; b"
    assert one(spark, "<!doctype html><STYLE>p{}</STYLE>x<script>var t='</p>';</script><b>y</b>", T.strip_html) == "xy"


def test_urls(spark):
    assert one(spark, "http://a/b?utm_x=1", T.canonical_url) == "http://a/b"
    assert one(spark, "http://a/b?q=1&utm_x=1", T.canonical_url) == "http://a/b?q=1&utm_x=1"
    assert one(spark, "/b", T.canonical_url) is None
    assert one(spark, "/b", lambda x: T.canonical_url(x, prefix="http://a")) == "http://a/b"
    assert one(spark, "http://www.storm.mg/123", T.canonical_url) == "http://www.storm.mg/article/123"
    assert one(spark, "HTTP://User@Host:80/x", T.domain_key) == "user@host:80"
    assert one(spark, None, T.domain_key) == ""


def test_title_hash_ignores_white_space(spark):
    assert one(spark, " a　b c ", T.title_hash) == one(spark, "abc", T.title_hash)


def test_category(spark):
    pick = lambda x: T.entry_category(x, F.lit("news"))
    assert [one(spark, v, pick) for v in ("tag", "", None, "x" * 21, "x" * 20)] == ["tag", "news", "news", "news", "x" * 20]


def test_first_filled(spark):
    row = spark.createDataFrame([("", None, "c")], "a string, b string, c string").select(T.first_filled(F.col("a"), F.col("b"), F.col("c")).alias("x"), T.first_filled(F.col("a"), F.col("b")).alias("y")).first()
    assert (row.x, row.y) == ("c", "")


def test_strip_looks_at_the_ends_only(spark):
    """Every white space, and no pattern, which would try every place of a text."""
    from siltstone.functions import text

    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"
    rows = spark.createDataFrame([(spaces + "a" + spaces + "​b" + spaces,), (spaces,), (None,)], "x string")
    assert [r.y for r in rows.select(text.strip(F.col("x")).alias("y")).collect()] == ["a" + spaces + "​b", "", None]
    assert "regexp" not in rows.select(text.strip(F.col("x")).alias("y"))._jdf.queryExecution().analyzed().toString()
