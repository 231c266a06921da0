"""Quality rules in DataFrame operations only: fixed counts, and a hashed n-gram log-likelihood ratio.

The method compares two multinomials over hashed word unigrams and bigrams: that of a trusted target
(the documents that `labels` call good and never bad) and that of the raw corpus (all documents). A
bucket's weight is the log of its share in the target over its share in the corpus, drawn to 0 where it
is rare: ln((t + a * T/R) / (r + a) / (T/R)). A document's ratio is the sum of its n-grams' weights over
their number; it is kept if that is at least `least`. Weights are whole millionths, so sums are exact and
every verdict is the same whatever the partitions.

The tables are counts over all documents: 2 ** BITS rows whatever the corpus, which is also the proven
bound of what is sent to all tasks.

Defined cases: null text has no words; without words the ratio is 0 and base_failed is true; without a
trusted document every weight is 0 and the base alone decides; labels with null doc_id or quality are
ignored, repeated ones count once; repeated documents are each counted and answered; other columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.llm._base import BLANKS, pinned, settle, sized, words_of

BITS = 18
#: Pseudo-count of the corpus in every bucket.
SMOOTH = 10
#: Least kept log ratio per n-gram, in millionths.
LEAST = -250_000
#: Fixed value: the symbols of the contract.
SYMBOLS = r"[#*$%&|<>]"


def hashed(rows: DataFrame) -> DataFrame:
    """`rows` with `words` of its `text`, the hashes of unigrams `_h` and of bigrams `_p`."""
    out = rows.withColumn("words", pinned(words_of(F.col("text"))))
    out = out.withColumn("_h", pinned(F.transform("words", lambda w: F.xxhash64(w))))
    return out.withColumn("_p", pinned(_pairs(F.col("words"))))


def _pairs(items: Column) -> Column:
    """A hash of each element and its successor; one pass without an index. `items` must be a column: a lambda would make any other expression anew."""
    size = F.greatest(F.size(items) - 1, F.lit(0))
    return F.zip_with(F.slice(items, F.lit(1), size), F.slice(items, F.lit(2), size), lambda a, b: F.xxhash64(a, b))


def bucket(gram: Column) -> Column:
    """The bucket of a unigram's or bigram's hash: its first BITS bits."""
    return F.shiftrightunsigned(gram, 64 - BITS).cast("int")


def measured(docs: DataFrame) -> DataFrame:
    """`docs` with `words`, the hashes of unigrams `_h` and bigrams `_p`, and the base counts; a narrow stage. A window
    of three words is hashed as its two pairs."""
    text = F.coalesce("text", F.lit(""))
    out = hashed(docs).withColumn("_lines", pinned(F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")))
    out = out.withColumn("_windows", pinned(_pairs(F.col("_p"))))
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.withColumn("_ranked", pinned(F.when(again, F.sort_array(pairs)).otherwise(F.slice(pairs, 1, 0))))
    same = lambda x, k: F.coalesce(F.get("_ranked", k).h == x.h, F.lit(False))
    twins = F.filter("_ranked", lambda x, k: same(x, k - 1) | same(x, k + 1))
    repeats = F.size(F.array_distinct(F.flatten(F.transform(twins, lambda x: F.array(x.i, x.i + 1, x.i + 2)))))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.concat_ws("", "words")),
        "n_symbols": F.size(F.split(text, SYMBOLS, -1)) - 1,
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeats,
    }
    out = out.withColumns({k: v.cast("long") for k, v in counts.items()}).drop("_lines", "_windows", "_ranked")
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def weights(docs: DataFrame, labels: DataFrame, most_broadcast: int = 1_000_000) -> DataFrame:
    """(b, w): the weight of every bucket that occurs, in millionths."""
    trusted = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id", F.lit(1).alias("good"))
    rows = docs.select("doc_id", "text").join(sized(trusted, most_broadcast), "doc_id", "left").select(F.coalesce("good", F.lit(0)).alias("good"), "text")
    counts = settle(hashed(rows).select("good", F.explode(F.concat("_h", "_p")).alias("g")).select("good", bucket(F.col("g")).alias("b")).groupBy("b").agg(F.sum("good").alias("t"), F.count("*").alias("r")), "ngram-counts")
    t, r = counts.agg(F.sum("t"), F.sum("r")).first()
    if not t:
        return counts.select("b", F.lit(0).cast("long").alias("w"))
    share = t / r
    ratio = (F.col("t") + F.lit(SMOOTH * share)) / (F.col("r") + F.lit(SMOOTH)) / F.lit(share)
    return counts.select("b", F.round(1_000_000 * F.log(ratio)).cast("long").alias("w"))


def judge(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, least: int = LEAST) -> DataFrame:
    """One row for each of `docs`: doc_id, the text's hash, the base counts, llr (millionths per n-gram, rounded
    down) and kept. Counts come from `corpus`, by default `docs`. A text's n-grams are summed where they are
    made, before the shuffle, so that one row a document and task moves."""
    table = weights(corpus if corpus is not None else docs, labels)
    rows = measured(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))).withColumn("text_hash", F.xxhash64("text"))
    base = ["doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    each = rows.select("_row", *base, F.explode_outer(F.concat("_h", "_p")).alias("g")).withColumn("b", bucket(F.col("g")))
    hit = each.join(F.broadcast(table), "b", "left")  # at most 2 ** BITS rows
    out = hit.groupBy("_row", *base).agg(F.coalesce(F.sum("w"), F.lit(0)).alias("_sum"), F.greatest(F.count("b"), F.lit(1)).alias("_n"))
    kept = ~F.col("base_failed") & (F.col("_sum") >= F.lit(least) * F.col("_n"))
    return out.select(*base, F.floor(F.col("_sum") / F.col("_n")).cast("long").alias("llr"), kept.alias("kept"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, unchanged."""
    verdict = judge(docs, labels).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(verdict, docs.doc_id.eqNullSafe(F.col("_id")) & (F.xxhash64(docs.text) == F.col("_hash")), "left_semi")


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's digest."""
    return judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
