from siltstone.streaming.live import live_articles, live_counts


def test_first_of_each_url(spark, tmp_path):
    rows = spark.createDataFrame([("a", "u1", "2026-01-01 10:00:00"), ("b", "u1", "2026-01-01 10:05:00"), ("c", "u2", "2026-01-01 10:10:00"), ("d", "u3", None)], "title string, url string, at string").selectExpr("title", "url", "timestamp(at) published_at", "'s' source")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    q = live_articles(stream).writeStream.format("memory").queryName("live").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.url for r in spark.sql("select url from live").collect()) == ["u1", "u2"]
    q = live_counts(stream).writeStream.outputMode("update").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(n) n from counts").first().n == 3
