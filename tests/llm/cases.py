"""Documents with every awkward case, and small corpora, for the tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n: int = 60, seed: int = 1) -> list[tuple]:
    """Prose of a small vocabulary with copies, near copies, shared passages and awkward texts."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ta", "ri", "no", "shu", "el", "ka", "mo"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    rows = []
    for i in range(n):
        t = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        if i % 7 == 3 and rows:
            t = rows[-1][1].split()
        if i % 7 == 5 and rows:
            t = rows[-2][1].split()
            t[len(t) // 2] = "changed"
        if i % 5 == 0:
            t[10:10] = [words[k] for k in range(20)]
        text = " ".join(t)
        rows.append((i, text.replace(" ", "\n", 2) if i % 3 else text, "en" if i % 2 else "fr", "s", len(text)))
    extra = [None, "", " \t\n", "one", "one two three four five", "ONE two three four five", "été à Noël " * 30, "x" * 30_000, "a " * 5000]
    rows += [(n + i, t, None if i % 2 else "en", None, None) for i, t in enumerate(extra)]
    rows.append((n + len(extra), rows[0][1], "en", "s", 1))
    rows.append((None, "no id here at all but a text", None, None, None))
    return rows


def frame(spark, rows=None, clash: bool = True):
    df = spark.createDataFrame(corpus() if rows is None else rows, SCHEMA)
    if clash:  # columns with the names that operators use inside
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in ("text_hash", "score", "spans", "ids", "words", "t", "v", "h", "_row", "held_out", "items", "bucket", "kept")})
    return df.repartition(3)
