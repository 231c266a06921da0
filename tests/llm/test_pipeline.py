"""The pipeline against its stages' brute force."""

import corpus_pipeline
from tests.llm.cases import corpus, frame
from tests.llm.test_operators import linked, rules


def test_stages(spark, tmp_path):
    docs, d = frame(spark, clash=False), str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    item = " ".join(corpus()[0][1].split()[:25])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    good = {r[0] for r in rules(corpus(), set(range(0, 40, 2))) if r[-1]}
    kept = corpus_pipeline.quality(spark, docs, d)
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == list(corpus_pipeline.COLUMNS)
    left = [r for r in corpus() if r[0] in good]
    one = {i for i, _, c in linked(left) if c in (i, None)}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, kept, d).collect()} == one
    out = corpus_pipeline.run(spark, d)
    ids = {r.doc_id for r in out.collect()}
    long = lambda t: {tuple(w[i : i + 13]) for w in [t.split()] for i in range(len(w) - 12)}
    assert ids == one - {r[0] for r in left if long(r[1]) & long(item)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "bpe"]
