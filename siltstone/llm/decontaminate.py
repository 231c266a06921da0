"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Every word becomes its template token: a number, unit or name turns into a typed placeholder (its slot
keeps the value), any other word loses its outer punctuation and its case. Windows of WIDTH consecutive
tokens are hashed and joined with those of the benchmark. Windows that meet on one diagonal (the same
shift between document and item) form an alignment, and an alignment counts only if its slots are
consistent: each value of the item stands for one value of the document throughout. So a question with
other numbers or names is caught, and unrelated texts that share only a frame are not. A document is
contaminated by an item when its consistent alignments hold at least half of the item's windows, or
LONG windows (WIDTH + LONG - 1 words).

That is the rule of the query's SQL. What does not reach it is judged once more, by more windows: those of tokens in
which a capital makes no name, so that copies in capitals, title case or lower case meet their item; and of an alignment
that is not consistent throughout, its longest consistent run and the windows whose slots equal the item's. There is one
search: each hit says how many windows it has by the SQL's rule too, and the query's digest is made from those.

Items with fewer than WIDTH words are one window each, of all their tokens, and documents have
windows of each such length that the benchmark has (inside longer texts, not in the SQL's rule). Windows made of placeholders alone carry no text and are not used.

Defined cases: null or blank texts have no windows and are clean; null doc_id is kept and answered;
items with null item_id or blank text are ignored; of items of equal templates and slots the least
is reported; repeated rows are each answered; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.llm._base import pinned, settle, sized, words_of

WIDTH = 8
LONG = 6
#: Fixed values of this operator: spelled numbers and units that become placeholders.
NUMBER_WORDS = "one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen".split()
UNITS = "mm cm km kg mg lb lbs oz ml mph kmh ft yd inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms ton tons liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent degree degrees".split()


#: Fixed values of this operator: punctuation around a word, and marks that end a sentence or close after it.
EDGES = ".,;:!?\"'`()[]{}<>|*#$&_~=+/\\-"
CLOSERS = "\"')]"
ENDS = (".", "!", "?", ":", ";")
NUMBER = r"^[0-9][0-9.,:/%-]*$"
AMOUNT = r"^[0-9]+\p{L}{1,3}$"


def templated(rows: DataFrame) -> DataFrame:
    """`rows` with the array `t`, the template tokens of `text`, and `low`, the bare words in lower case that they stand for.
    Words of punctuation alone are left out; a capital makes a name inside a sentence only.

    One array a step, all as long as the words; a word's predecessor is looked up only for capitals. Placeholders
    are the only tokens that begin with a mark, as bare words have none at their ends."""
    out = rows.withColumn("_words", pinned(words_of(F.col("text"))))
    out = out.withColumn("_bare", pinned(F.transform("_words", lambda w: F.btrim(w, F.lit(EDGES)))))
    out = out.withColumn("_low", pinned(F.transform("_bare", F.lower)))

    def inside(i: Column) -> Column:
        before = F.get("_words", i - 1)
        return before.isNotNull() & ~F.substring(F.rtrim(before, F.lit(CLOSERS)), -1, 1).isin(*ENDS)

    def token(low: Column, i: Column) -> Column:
        bare, first = F.get("_bare", i), F.substring(F.get("_bare", i), 1, 1)
        digits = F.when(bare.rlike(NUMBER), "<n>").when(bare.rlike(AMOUNT), "<q>").otherwise(low)
        name = (bare != low) & (F.lower(first) != first) & inside(i)
        return F.when((low >= "0") & (low < ":"), digits).when(low.isin(NUMBER_WORDS), "<n>").when(low.isin(UNITS), "<u>").when(name, "<p>").otherwise(low)

    out = out.withColumn("t", pinned(F.filter(F.transform("_low", token), lambda x: x != "")))
    out = out.withColumn("low", pinned(F.filter("_low", lambda x: x != "")))
    return out.drop("_words", "_bare", "_low")


def _tail(array: str, by: int, size: Column) -> Column:
    return F.slice(array, F.lit(by + 1), F.greatest(size, F.lit(0)))


def _runs(rows: DataFrame, name: str, widths: list[int]) -> DataFrame:
    """`rows` with `{name}{w}`, the hash of every run of w elements of the hashes `{name}1`, for each of `widths`:
    that of the longest power of two, with the hash of the rest; so a window costs three steps, not one a token."""
    made = {1}
    out = rows

    def make(w: int) -> None:
        nonlocal out
        if w in made:
            return
        half = 1 << ((w - 1).bit_length() - 1)
        make(half)
        make(w - half)
        size = F.size(f"{name}1") - (w - 1)
        out = out.withColumn(f"{name}{w}", pinned(F.zip_with(_tail(f"{name}{half}", 0, size), _tail(f"{name}{w - half}", half, size), lambda a, b: F.xxhash64(a, b))))
        made.add(w)

    for w in widths:
        make(w)
    return out


def windows(rows: DataFrame, keep: list[str], short: list[int] | None = None) -> DataFrame:
    """One row for each window: `keep`, its place `at`, its `width`, its hash `h`, whether it is `folded` (a capital makes
    no name in it), and the text's arrays `t` and `low`. A text of fewer than WIDTH tokens is one window. Windows of the
    lengths `short` are added. Folded windows are those that have a name unfolded. The arrays stay by
    reference until a join has picked the rows; only what it picks is copied."""
    brief = list(range(1, WIDTH))
    out = rows.withColumns({"_n": F.size("t"), "_h1": pinned(F.transform("t", lambda x: F.xxhash64(x)))})
    fold = F.zip_with("t", "low", lambda t, low: F.xxhash64(F.when(t == "<p>", low).otherwise(t)))
    out = out.withColumn("_f1", pinned(F.when(F.array_contains("t", "<p>"), fold).otherwise(F.col("_h1"))))
    none = F.array().cast("array<bigint>")
    pieces = []
    for name, folded in (("_h", False), ("_f", True)):
        out = _runs(out, name, [WIDTH, *(short or [])])
        # a text shorter than a window is hashed whole, token by token in the order of _runs
        single = F.lit(None).cast("bigint")
        for w in reversed(brief):
            single = F.when(F.col("_n") == w, _whole_hash(name, w)).otherwise(single)
        out = out.withColumn(f"{name}w", pinned(F.when(F.col("_n") >= WIDTH, F.col(f"{name}{WIDTH}")).when(F.col("_n") > 0, F.array(single)).otherwise(none)))
        pieces.append((name, "w", folded, F.least(F.col("_n"), F.lit(WIDTH))))
        pieces += [(name, str(w), folded, F.lit(w)) for w in short or []]
    listed = []
    for name, suffix, folded, width in pieces:
        made = F.transform(f"{name}{suffix}", lambda h, i: F.struct(h.alias("h"), i.alias("at"), width.cast("int").alias("width"), F.lit(folded).alias("folded")))
        if folded:
            made = F.filter(made, lambda x: x.h != F.get(f"_h{suffix}", x.at))
        if suffix != "w":
            made = F.when(F.col("_n") > width, made).otherwise(F.slice(made, 1, 0))
        listed.append(made)
    out = out.withColumn("_windows", pinned(F.concat(*listed)))
    return out.select(*keep, "t", "low", F.explode("_windows").alias("x")).select(*keep, "t", "low", "x.*")


def _whole_hash(name: str, w: int) -> Column:
    """The hash of the first w elements as _runs makes it."""

    def of(start: int, w: int) -> Column:
        if w == 1:
            return F.get(f"{name}1", F.lit(start))
        half = 1 << ((w - 1).bit_length() - 1)
        return F.xxhash64(of(start, half), of(start + half, w - half))

    return of(0, w)


def _cut(rows: DataFrame) -> DataFrame:
    """`rows` of windows with their tokens `wt`, the values of their slots `v` in order and the places `s` of those; `t` and `low`
    go. Windows made of placeholders alone are dropped."""
    part = lambda name: F.slice(name, F.col("at") + 1, F.col("width"))
    slot = lambda x: F.startswith(x.t, F.lit("<")) & ~(F.col("folded") & (x.t == "<p>"))
    tokens = F.transform(F.arrays_zip(part("t").alias("t"), part("low").alias("low")), lambda x, i: F.struct(x.t.alias("t"), x.low.alias("low"), (i + F.col("at")).alias("p")))
    out = rows.withColumn("_w", pinned(tokens))  # else the filter below would move before the join that picks the rows
    out = out.withColumn("wt", F.transform("_w", lambda x: F.when(slot(x), x.t).otherwise(x.low))).withColumn("_s", F.filter("_w", slot))
    out = out.where(F.size("_s") < F.col("width"))
    return out.withColumns({"v": F.col("_s.low"), "s": F.col("_s.p")}).drop("t", "low", "_w", "_s")


def _longest(places: Column, slots: Column) -> tuple[Column, Column]:
    """Where slots (place p, item's value b, document's value d) clash with an earlier one q, which is to be named `_clashes`;
    and the places of the longest run of windows without a clash inside."""
    before = lambda x: F.array_max(F.transform(F.filter(slots, lambda y: (y.b == x.b) & (y.d != x.d) & (y.p < x.p)), lambda y: y.p))
    clashes = F.filter(F.transform(slots, lambda x: F.struct(x.p.alias("p"), before(x).alias("q"))), lambda x: x.q.isNotNull())

    def run(i: Column) -> Column:
        least = F.coalesce(F.array_max(F.transform(F.filter("_clashes", lambda c: c.p < i + WIDTH), lambda c: c.q + 1)), F.lit(0))
        return F.filter(places, lambda k: (k >= least) & (k <= i))

    return clashes, F.aggregate(F.transform(places, run), F.array().cast("array<int>"), lambda best, x: F.when(F.size(x) > F.size(best), x).otherwise(best))


def hits(docs: DataFrame, benchmark: DataFrame, most_broadcast: int = 200_000) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, n_plain) of every contaminating item; item_id is the least of equal items, n_plain
    the number of windows by the rule of the SQL, null where that does not reach."""
    items = templated(benchmark.select("item_id", "text").where("item_id is not null")).groupBy("t", "low").agg(F.min("item_id").alias("item_id"))
    items = settle(items, "benchmark-items")
    short = sorted(r.n for r in items.select(F.size("t").alias("n")).where(f"n > 0 and n < {WIDTH}").distinct().collect())
    made = _cut(windows(items, ["item_id"]))
    of = made.groupBy("item_id").agg(F.count_if(~F.col("folded")).cast("int").alias("of"), F.countDistinct("at").cast("int").alias("of_all"))
    known = made.join(of, "item_id").select("item_id", "of", "of_all", F.col("at").alias("b_at"), "h", F.col("wt").alias("b_wt"), F.col("v").alias("b_v"), F.col("s").alias("b_s"), F.col("folded").alias("b_folded"))
    known = settle(known, "benchmark-windows")
    rows = windows(templated(docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))), ["doc_id", "text_hash"], short)
    some = rows.join(sized(known.select("h").distinct(), 10 * most_broadcast), "h", "left_semi")  # hashes alone, before tokens are cut
    some = some.withColumn("inner", F.col("width") < F.least(F.size("t"), F.lit(WIDTH)))  # a short window inside a longer text
    met = _cut(some).drop("s").join(sized(known, most_broadcast), "h").where(F.col("wt") == F.col("b_wt"))
    plain = ~F.col("folded") & ~F.col("b_folded") & ~F.col("inner")
    pairs = F.arrays_zip(F.col("b_v").alias("b"), F.col("v").alias("d"))
    by = ["doc_id", "text_hash", "item_id", "of", "of_all", (F.col("at") - F.col("b_at")).alias("shift")]
    made = [F.collect_set(F.when(plain, F.col("b_at"))).alias("places"), F.array_distinct(F.flatten(F.collect_set(F.when(plain, pairs)))).alias("slots")]
    spots = F.arrays_zip(F.col("b_s").alias("p"), F.col("b_v").alias("b"), F.col("v").alias("d"))
    made += [F.sort_array(F.collect_set("b_at")).alias("all_places"), F.array_distinct(F.flatten(F.collect_set(spots))).alias("all_slots"), F.collect_set(F.when(F.col("b_v") == F.col("v"), F.col("b_at"))).alias("equal")]
    line = met.groupBy(*by).agg(*made)
    same = F.size("slots") == F.size(F.array_distinct(F.col("slots.b")))
    count = lambda name: F.size(F.array_distinct(F.flatten(F.collect_list(name))))
    enough = lambda n, of: (F.col(n) > 0) & ((2 * F.col(n) >= F.col(of)) | (F.col(n) >= LONG))
    clashes, longest = _longest(F.col("all_places"), F.col("all_slots"))
    line = line.withColumn("places", F.when(same, F.col("places")).otherwise(F.array().cast("array<int>"))).withColumn("_clashes", pinned(clashes))
    line = line.withColumn("all_places", F.when(F.size("_clashes") == 0, F.col("all_places")).otherwise(F.concat("equal", "places", longest)))
    found = line.groupBy("doc_id", "text_hash", "item_id", "of", "of_all").agg(count("places").alias("n"), count("all_places").alias("n_all"))
    found = found.withColumn("n_plain", F.when(enough("n", "of"), F.col("n")))
    found = found.withColumn("n_windows", F.coalesce("n_plain", F.when(enough("n_all", "of_all"), F.col("n_all"))))
    return found.where("n_windows is not null").select("doc_id", "text_hash", "item_id", "n_windows", "n_plain")


def flagged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, contaminated, and the items that contaminate it, in order."""
    return _digest(docs, hits(docs, benchmark))


def _digest(docs: DataFrame, found: DataFrame) -> DataFrame:
    by_doc = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.sort_array(F.collect_list("item_id")).alias("items"), F.max("n_windows").alias("n_windows"))
    each = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    out = each.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return out.select("doc_id", F.col("_hash").isNotNull().alias("contaminated"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"), F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that no item contaminates, unchanged."""
    bad = hits(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(bad, docs.doc_id.eqNullSafe(F.col("_id")) & (F.xxhash64(docs.text) == F.col("_hash")), "left_anti")


def op9(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query's digest: of all hits, those that reach by the rule of its SQL."""
    found = hits(docs, benchmark).where("n_plain is not null")
    return _digest(docs, found.select("doc_id", "text_hash", "item_id", F.col("n_plain").alias("n_windows")))


def _sql_windows(table: str, key: str) -> str:
    """Windows of the rows (rid, key, i, t, v) of `table`."""
    return f"""SELECT rid, {key}, i AS at, wt, list_filter(wv, lambda x: x IS NOT NULL) AS wv FROM (
      SELECT rid, {key}, i, string_agg(t, ' ') OVER w AS wt, list(v) OVER w AS wv, count(*) OVER w AS size, count(*) OVER (PARTITION BY rid) AS n
      FROM {table} WINDOW w AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {WIDTH - 1} FOLLOWING)) WHERE size = least(n, {WIDTH}) AND len(list_filter(wv, lambda x: x IS NOT NULL)) < size"""


def _sql_tokens(table: str, key: str) -> str:
    edge, closers = EDGES.replace("'", "''"), CLOSERS.replace("'", "''")
    listed = lambda xs: ", ".join(f"'{x}'" for x in xs)
    return rf"""SELECT rid, {key}, row_number() OVER (PARTITION BY rid ORDER BY i) AS i, coalesce(kind, lower(b)) AS t, CASE WHEN kind IS NOT NULL THEN lower(b) END AS v FROM (
        SELECT *, CASE WHEN b[1] BETWEEN '0' AND '9' THEN CASE WHEN regexp_matches(b, '{NUMBER}') THEN '<n>' WHEN regexp_matches(b, '{AMOUNT}') THEN '<q>' END
          WHEN lower(b) IN ({listed(NUMBER_WORDS)}) THEN '<n>' WHEN lower(b) IN ({listed(UNITS)}) THEN '<u>'
          WHEN lower(b[1]) <> b[1] AND prev IS NOT NULL AND right(rtrim(prev, '{closers}'), 1) NOT IN ({listed(ENDS)}) THEN '<p>' END AS kind FROM (
          SELECT rid, {key}, i, trim(w, '{edge}') AS b, lag(w) OVER (PARTITION BY rid ORDER BY i) AS prev FROM (
            SELECT rid, {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT rid, {key}, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM {table}))) WHERE b <> '')"""


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
bm AS (SELECT row_number() OVER () AS rid, item_id, text FROM benchmark),
dt AS ({_sql_tokens("d", "doc_id")}),
bt AS ({_sql_tokens("bm", "item_id")}),
it AS (SELECT min(item_id) AS item_id FROM (SELECT rid, item_id, list(t ORDER BY i) AS t, list(v ORDER BY i) AS v FROM bt GROUP BY rid, item_id) GROUP BY t, v),
bw AS (SELECT * FROM ({_sql_windows("bt", "item_id")}) WHERE item_id IN (SELECT item_id FROM it)),
n AS (SELECT item_id, count(*) AS size FROM bw GROUP BY item_id),
dw AS ({_sql_windows("dt", "doc_id")}),
met AS (SELECT dw.rid, bw.item_id, dw.at - bw.at AS shift, bw.at AS b_at, bw.wv AS bv, dw.wv AS dv FROM dw JOIN bw ON dw.wt = bw.wt),
slot AS (SELECT rid, item_id, shift, count(DISTINCT (b, v)) AS pairs, count(DISTINCT b) AS vals FROM (SELECT rid, item_id, shift, unnest(bv) AS b, unnest(dv) AS v FROM met) GROUP BY ALL),
good AS (SELECT met.* FROM met LEFT JOIN slot USING (rid, item_id, shift) WHERE slot.rid IS NULL OR pairs = vals),
hit AS (SELECT rid, item_id, count(DISTINCT b_at) AS k FROM good GROUP BY rid, item_id),
bad AS (SELECT rid, item_id, k FROM hit JOIN n USING (item_id) WHERE 2 * k >= size OR k >= {LONG}),
agg AS (SELECT rid, count(*) AS c, max(k) AS k, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items FROM bad GROUP BY rid)
SELECT doc_id, agg.rid IS NOT NULL AS contaminated, coalesce(c, 0)::BIGINT AS n_items, coalesce(k, 0)::BIGINT AS n_windows, coalesce(items, '') AS items FROM d LEFT JOIN agg USING (rid)
"""
