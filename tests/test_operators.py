import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import dedup, meta, schedule
from siltstone.plans import slate
from siltstone.sources import delivery


def test_keep_first_and_blank(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, ""), (4, "")], "pos int, h string")
    assert sorted(r.pos for r in dedup.keep_first(rows, ["h"], ["pos"], pass_blank=True).collect()) == [1, 3, 4]


def test_similarity_bands(spark):
    rows = spark.createDataFrame([(x,) for x in (0.4999, 0.5, 0.7999, 0.8, 0.9499, 0.95)], "s double")
    assert [r.k for r in rows.select(dedup.similarity_class(F.col("s")).alias("k")).collect()] == ["original", "different_angle", "different_angle", "rewrite", "rewrite", "duplicate"]


@pytest.mark.parametrize("block", [3, 100])
def test_pairs_and_components(spark, block):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(20, 4))
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = {(i, j) for i in range(20) for j in range(i + 1, 20) if n[i] @ n[j] >= 0.6}
    pairs = dedup.cosine_pairs(rows, "id", "v", 0.6, block)
    assert {(r.a, r.b) for r in pairs.collect()} == want
    label = list(range(20))
    for _ in range(20):
        for a, b in want:
            label[a] = label[b] = min(label[a], label[b])
    assert {r.id: r.component for r in dedup.components(rows.select("id"), pairs).collect()} == dict(enumerate(label))


def test_no_pairs(spark):
    none = spark.createDataFrame([], "id long, v array<double>")
    assert dedup.cosine_pairs(none, "id", "v").count() == 0
    assert dedup.components(none.select("id"), dedup.cosine_pairs(none, "id", "v")).count() == 0


def test_survivors_lose_or_keep_content(spark):
    rows = spark.createDataFrame([(1, "a", 1, False, 0.96), (2, "b", 1, False, 0.96), (3, "c", 1, True, 0.6)], "pos int, url string, component int, is_primary boolean, max_sim double")
    assert [r.url for r in dedup.survivors(rows).collect()] == ["c"]
    assert sorted(r.url for r in dedup.survivors(rows, mode="safe").collect()) == ["a", "c"]
    assert dedup.survivors(rows).first().duplicate_urls == ["a", "b"]


def test_breaker(spark):
    log = spark.createDataFrame([(i, "d", ok) for i, ok in enumerate([False, False, True, False, False, False, True, False])] + [(9, "e", True)], "pos int, domain string, ok boolean")
    assert sorted(r.pos for r in schedule.breaker(log).where("blocked").collect()) == [6, 7]


def test_fresh(spark):
    now = datetime.datetime(2026, 1, 2)
    rows = spark.createDataFrame([(1, now - datetime.timedelta(hours=6)), (2, now - datetime.timedelta(hours=6, seconds=1)), (3, None)], "i int, published_at timestamp")
    assert [(r.i, r.fresh_order) for r in meta.fresh(rows, F.lit(now)).orderBy("i").collect()] == [(1, 0), (3, 1)]


def test_topics_tie(spark):
    rows = spark.createDataFrame([([1.0, 1.0, 0.0],)], "logits array<double>")
    assert meta.topics(rows, labels=["x", "y", "z"], kept=["x"]).first().topic == "x"
    assert meta.topics(rows, labels=["x", "y", "z"], kept=["y"]).first().topic is None


def test_robots(spark):
    body = "User-agent: bot\nDisallow: /private\n\nUser-agent: *\nCrawl-delay: 4\n"
    rows = spark.createDataFrame([("http://h/private/a", 200, body), ("http://h/private/a", 404, None), ("http://h/x", 200, body)], "url string, status int, body string")
    assert [r.allowed for r in schedule.robots(rows, "bot").collect()] == [False, True, True]
    assert [r.allowed for r in schedule.robots(rows, "bot", any_agent=True).collect()] == [True, True, True]
    assert schedule.robots(rows, "bot").first().crawl_delay == 4.0


@pytest.mark.parametrize("n", [0, 50, 51])
def test_batches(spark, n):
    rows = spark.range(n).withColumnRenamed("id", "pos")
    got = delivery.batches(rows).collect()
    assert sorted((r.pos, r.batch) for r in got) == [(i, i // 50) for i in range(n)]


def test_deliver(spark):
    rows = delivery.batches(spark.range(60).withColumnRenamed("id", "pos"))
    totals = lambda df: tuple(df.agg(F.sum("accepted"), F.sum("rejected")).first())
    assert totals(delivery.deliver(rows, lambda b: (200, True), dry_run=True)) == (60, 0)
    assert totals(delivery.deliver(rows, lambda b: (200, True), key=None)) == (0, 60)
    assert totals(delivery.deliver(rows, lambda b: (500, False), key="k", first_wait=0.01)) == (0, 60)
    assert totals(delivery.deliver(rows, lambda b: (200, True), key="k")) == (60, 0)


def test_every_query_has_a_name_and_most_have_sql():
    assert len(slate.QUERIES) >= 50
    assert set(slate.ORACLE_SQL) <= set(slate.QUERIES)


def test_json_api_scans_all_pages_or_stops_early(spark, tmp_path):
    from siltstone.sources import feeds

    spark.range(1000).selectExpr("id as page_id", "concat('http://x/', id) url").write.parquet(str(tmp_path / "pages.parquet"))
    got = slate.QUERIES["json_api_scan_all"](spark, str(tmp_path)).collect()
    assert sorted(r.title for r in got) == list(range(1000))
    page = lambda n, end="false", status=200: (f'{{"page": {n}, "status": {status}, "end": {end}, "lists": [{{"title": "t{n}", "titleLink": "/{n}"}}]}}',)
    for name, rows, want in (("end", [page(0), page(1, "true"), page(2)], ["t0", "t1"]), ("bad", [page(0), page(1, status=500), page(2)], ["t0"])):
        spark.createDataFrame(rows, "value string").write.text(str(tmp_path / name))
        assert sorted(r.title for r in feeds.json_api(spark, str(tmp_path / name), "s", "news", "http://x").collect()) == want


def test_hashed_embedding_pairs_are_all_pairs(spark, tmp_path):
    """Of all classes from 0.50 up, as by brute force."""
    import itertools
    import zlib

    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list("abcdef "), 300)) for _ in range(3)] + ["".join(rng.choice(list("ghij "), 300)) for _ in range(2)]
    texts = [*base, base[0][:150] + base[3][:150], base[1][:220] + base[4][:80], base[2][:290] + base[3][:10], base[0] + "x", "short"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))

    def vector(t):
        v = np.zeros(256)
        for i in range(len(t) - 2):
            v[zlib.crc32(t[i : i + 3].encode()) % 256] += 1
        return v / np.linalg.norm(v)

    sims = {(a, b): vector(texts[a]) @ vector(texts[b]) for a, b in itertools.combinations(range(9), 2)}
    want = {k: round(x, 9) for k, x in sims.items() if x >= 0.5}
    assert min(want.values()) < 0.8 and max(want.values()) >= 0.98
    got = slate.QUERIES["hashed_embedding_pairs"](spark, str(tmp_path)).collect()
    assert {(r.a, r.b): round(r.sim, 9) for r in got} == want


def test_first_of_a_url_is_that_of_the_first_file(spark, tmp_path):
    """Spark reads large files first; the first file by name counts all the same."""
    from siltstone.sources import feeds

    item = lambda title, more: f"<item><title>{title}</title><link>http://x/1</link><description>{more}</description></item>"
    (tmp_path / "a.xml").write_text(f"<rss><channel>{item('first', 'a')}</channel></rss>")
    (tmp_path / "b.xml").write_text(f"<rss><channel>{item('second', 'b' * 20000)}{item('third', 'c')}</channel></rss>")
    assert [r.title for r in feeds.rss(spark, str(tmp_path), "s", "news").collect()] == ["first"]


def test_xml_feed_scan_keeps_the_least_page_of_a_url(spark, tmp_path):
    """Whatever documents its pages were landed in: 2 comes before 10, and below zero before both."""
    rows = [(n, f"http://x/{n % 500}") for n in (1001, 5001, 1002, 5002, -499, 10001, 7003)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    want = {}
    for n, url in sorted(rows):
        want.setdefault(url, n)
    assert {r.url: r.page_id for r in slate.QUERIES["xml_feed_scan"](spark, str(tmp_path)).collect()} == want


@pytest.mark.parametrize("block", [None, 3])
def test_links_say_what_pairs_say(spark, block):
    """Components and greatest similarities from links equal those from all pairs; links have a row an id and pair of blocks at most."""
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(size=(30, 4)), np.repeat(rng.normal(size=(1, 4)), 40, axis=0) + rng.normal(size=(40, 4)) / 1000])
    rows = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(rng.permutation(70), v, strict=True)] + [(99, None)], "id long, v array<float>").repartition(3)
    pairs, links = dedup.cosine_pairs(rows, "id", "v", 0.9, block), dedup.cosine_links(rows, "id", "v", 0.9, block)
    assert links.count() < (71 if block is None else 40 * 24)
    assert pairs.count() > 40 * 39 // 2
    got = [{tuple(r) for r in f.collect()} for f in (dedup.components(rows.select("id"), dedup.edges(links)), dedup.components(rows.select("id"), pairs))]
    assert got[0] == got[1] and len({c for _, c in got[0]}) > 2
    best = [{r.id: round(r.max_sim, 9) for r in dedup.max_similarity(rows.select("id"), f).collect()} for f in (links, pairs)]
    assert best[0] == best[1] and best[0][99] == 0


def test_vectors_are_sent_in_few_pieces(spark):
    """A block holds as many rows as fit its bytes, so vectors are sent as often as there are blocks, not once for each 2,048 rows."""
    rows = spark.range(60_000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    packed, blocks = dedup._packed(rows, "id", "v", None)
    assert blocks < 12 and packed.count() < 12 * 60
    assert dedup._packed(rows, "id", "v", 2048)[1] == 30


@pytest.mark.parametrize("name", ["dedup_survivors", "duplicate_urls"])
def test_near_copies_stay_in_the_report(spark, tmp_path, name):
    """The report's SQL has every row, those of near copies (0.95 or more) too."""
    import duckdb

    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(size=(6, 8)), np.repeat(rng.normal(size=(1, 8)), 4, axis=0) + rng.normal(size=(4, 8)) / 100])
    spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    spark.createDataFrame([(i, i % 8) for i in range(12)], "doc_id long, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    for t in ("embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.execute(slate.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(tuple(r) for r in slate.QUERIES[name](spark, str(tmp_path)).select(columns).collect()) == sorted(want.fetchall())
