"""Keep-first dedups, exact groups, cosine pairs, components, primaries and survivors."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Least similarity of each class of pair.
DUPLICATE, REWRITE, ANGLE = 0.95, 0.80, 0.50


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the folder that all executors share and read again, which cuts lineage; the Spark checkpoint
    folder if it is set, else the warehouse."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_first(df: DataFrame, keys: list[str], order: list[str], pass_blank: bool = False) -> DataFrame:
    """The first row of each key; with `pass_blank`, rows with an empty key are all kept."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    keep = F.col("_rank") == 1
    if pass_blank:
        keep = keep | (F.col(keys[0]) == "")
    return df.withColumn("_rank", rank).where(keep).drop("_rank")


def exact_groups(df: DataFrame, hash_col: str = "content_hash", size: str = "char_count", pos: str = "pos") -> DataFrame:
    """The longest, then first row of each content hash, with `group_size` and the group's first place."""
    by = Window.partitionBy(F.coalesce(hash_col, F.lit("")))
    rank = F.row_number().over(by.orderBy(F.desc(size), pos))
    return df.withColumns({"_rank": rank, "group_size": F.count("*").over(by), "group_pos": F.min(pos).over(by)}).where("_rank = 1").drop("_rank")


def similarity_class(sim: Column) -> Column:
    """On the unrounded score; bounds belong to the higher class."""
    return F.when(sim >= DUPLICATE, "duplicate").when(sim >= REWRITE, "rewrite").when(sim >= ANGLE, "different_angle").otherwise("original")


#: Bytes of one block of vectors at most (as doubles), rows of a block at least, and of a tile of products.
_BLOCK, _LEAST_ROWS, _TILE = 32 << 20, 1024, 1024


def _packed(df: DataFrame, id_col: str, vector: str, block: int | None) -> tuple[DataFrame, int]:
    """(own, ids, data) of the rows with a vector: pieces of blocks, `data` the vectors' numbers one after the other; and the
    number of blocks. There are as many as give each core some pairs of blocks, more only if `block` rows or _BLOCK bytes ask for it,
    so a vector is sent a few times, not once for each few thousand rows."""
    spark = df.sparkSession
    kind = "float" if df.schema[vector].dataType.elementType.typeName() == "float" else "double"
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).cast(f"array<{kind}>").alias("v")).where("id is not null and v is not null")
    n, dims = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    wide = math.isqrt(16 * spark.sparkContext.defaultParallelism) + 1
    most = block or max(1, _BLOCK // (8 * max(dims or 1, 1)))
    blocks = max(1, -(-n // most), min(-(-n // _LEAST_ROWS), wide))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(2).to_numpy()
            order = np.argsort(at, kind="stable")
            there, first = np.unique(at[order], return_index=True)
            offsets = np.append(first, len(at)).astype(np.int32)
            numbers = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float32 if kind == "float" else np.float64).reshape(len(at), -1)
            data = [numbers[order[x:y]].tobytes() for x, y in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), batch.column(0).take(pa.array(order))), pa.array(data, pa.binary())], names=["own", "ids", "data"])

    return rows.select("id", "v", own.alias("own")).mapInArrow(pack, f"own int, ids array<{rows.schema['id'].dataType.simpleString()}>, data binary"), blocks


def _by_blocks(df: DataFrame, id_col: str, vector: str, least: float, block: int | None, answer: Callable, schema: str) -> DataFrame:
    """What `answer` makes of each pair of blocks, from their ids, the place where the second block's begin, and an iterator of
    (places, places, sims) of all pairs with sim >= `least`, each once. A task holds two blocks and one tile of their products,
    whatever the number of rows; the products are all made, so their number is quadratic."""
    packed, blocks = _packed(df, id_col, vector, block)
    double = np.float32 if df.schema[vector].dataType.elementType.typeName() == "float" else np.float64
    sent = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    sent = sent.select((i * blocks - F.floor(i * (i - 1) / 2) + j - i).cast("int").alias("pair"), (i == j).alias("within"), (F.col("own") != i).alias("second"), "ids", "data")

    def tiles(left: np.ndarray, right: np.ndarray | None, base: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        other = left if right is None else right
        for x in range(0, len(left), _TILE):
            for y in range(x if right is None else 0, len(other), _TILE):
                sims = left[x : x + _TILE] @ other[y : y + _TILE].T
                at = np.flatnonzero(sims.reshape(-1) >= least)
                if not len(at):
                    continue
                a, b, found = at // sims.shape[1] + x, at % sims.shape[1] + y, sims.reshape(-1)[at]
                if right is None:
                    keep = a < b
                    a, b, found = a[keep], b[keep], found[keep]
                yield a, b + base, found

    def products(pieces: list[tuple[bool, pa.Array, bytes]]) -> Iterator[pa.RecordBatch]:
        sides, names = [], []
        for second in (False, True):
            mine = [p for p in pieces if p[0] == second]
            if mine:
                ids = pa.concat_arrays([p[1] for p in mine])
                numbers = np.frombuffer(b"".join(p[2] for p in mine), double).astype(np.float64).reshape(len(ids), -1)
                numbers /= np.maximum(np.linalg.norm(numbers, axis=1, keepdims=True), 1e-300)
                sides.append(numbers)
                names.append(ids)
        return answer(pa.concat_arrays(names).to_numpy(zero_copy_only=False), len(names[0]), tiles(sides[0], sides[1] if len(sides) > 1 else None, len(names[0]) if len(sides) > 1 else 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, within = [], False  # a partition is a pair
        for batch in batches:
            within = within or batch.column(0)[0].as_py()
            held += [(second.as_py(), ids.values, data.as_py()) for second, ids, data in zip(*batch.columns[1:], strict=True)]
        if held and (within or len({p[0] for p in held}) == 2):
            yield from products(held)

    return sent.repartitionById(blocks * (blocks + 1) // 2, F.col("pair")).drop("pair").mapInArrow(run, schema)


def _kind(df: DataFrame, id_col: str) -> str:
    return df.schema[id_col].dataType.simpleString()


def cosine_pairs(df: DataFrame, id_col: str, vector: str, least: float = ANGLE, block: int | None = None) -> DataFrame:
    """(a, b, sim) for a < b with sim >= `least`, exact: each pair of blocks is one task of matrix products."""

    def answer(ids: np.ndarray, second: int, found: Iterator) -> Iterator[pa.RecordBatch]:
        for a, b, sims in found:
            x, y = ids[a], ids[b]
            keep = x != y
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)[keep]), pa.array(np.maximum(x, y)[keep]), pa.array(sims[keep])], names=["a", "b", "sim"])

    kind = _kind(df, id_col)
    return _by_blocks(df, id_col, vector, least, block, answer, f"a {kind}, b {kind}, sim double")


def cosine_links(df: DataFrame, id_col: str, vector: str, least: float = ANGLE, block: int | None = None) -> DataFrame:
    """What components and greatest similarities need of the same pairs: (id, hub, sim), for each pair of blocks one row of every
    id that has a pair there, with the least id that the pairs there lead to and its greatest similarity. So rows grow with the ids
    and blocks, not with the pairs."""

    def answer(ids: np.ndarray, second: int, found: Iterator) -> Iterator[pa.RecordBatch]:
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ids[order][1:] != ids[order][:-1])])  # rows of one id are one node
        least_of, best = np.arange(len(ids)), np.full(len(ids), -np.inf)
        for a, b, sims in found:
            a, b = rank[a], rank[b]
            keep = a != b
            a, b, sims = a[keep], b[keep], sims[keep]
            np.maximum.at(best, a, sims)
            np.maximum.at(best, b, sims)
            x, y = least_of[a], least_of[b]
            while len(apart := np.flatnonzero(x != y)):  # labels only fall, and each label is a node that is its own or points lower
                x, y = x[apart], y[apart]
                np.minimum.at(least_of, np.maximum(x, y), np.minimum(x, y))
                while not np.array_equal(least_of, low := least_of[least_of]):
                    least_of = low
                x, y = least_of[x], least_of[y]
        has = np.flatnonzero(best > -np.inf)
        name = np.empty(len(ids), ids.dtype)
        name[rank] = ids
        yield pa.RecordBatch.from_arrays([pa.array(name[has]), pa.array(name[least_of[has]]), pa.array(best[has])], names=["id", "hub", "sim"])

    kind = _kind(df, id_col)
    return _by_blocks(df, id_col, vector, least, block, answer, f"id {kind}, hub {kind}, sim double")


def edges(links: DataFrame) -> DataFrame:
    """(a, b) that connect what the pairs behind cosine_links() connect."""
    return links.where("id != hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))


def max_similarity(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, max_sim) of every node; 0 without a pair. Takes pairs (a, b, sim), or cosine_links()."""
    ends = pairs.select("id", "sim") if "hub" in pairs.columns else pairs.select(F.col("a").alias("id"), "sim").union(pairs.select(F.col("b").alias("id"), "sim"))
    return nodes.join(ends.groupBy("id").agg(F.max("sim").alias("max_sim")), "id", "left").select("id", F.coalesce("max_sim", F.lit(0.0)).alias("max_sim"))


def components(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, component) of every node, the smallest id that pairs lead to; lone nodes are their own."""
    links = _kept(pairs.select("a", "b").union(pairs.select("b", "a")).distinct(), "links")
    labels = _kept(nodes.select("id", F.col("id").alias("component")).distinct(), "labels")
    while True:
        near = links.join(labels, links.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
        new = labels.join(near, "id", "left").join(jump, "component").withColumn("new", F.least("near", "far", "component"))
        new = _kept(new.select("id", F.col("new").alias("component"), (F.col("new") < F.col("component")).alias("moved")), "labels")
        labels = new.select("id", "component")
        if not new.where("moved").limit(1).count():
            return labels


def primaries(clustered: DataFrame, size: str = "char_count", order: str = "pos") -> DataFrame:
    """`clustered` with is_primary: the longest, then first of each component."""
    rank = F.row_number().over(Window.partitionBy("component").orderBy(F.desc(size), order))
    return clustered.withColumn("is_primary", rank == 1)


def survivors(marked: DataFrame, removed: int | Column = 0, mode: str = "reference") -> DataFrame:
    """Rows (pos, url, component, is_primary, max_sim, ...) that stay, with their metadata. In mode `reference`
    a duplicate goes unless it is the primary; `safe` also keeps the first of duplicates without one left; `all` keeps every row."""
    kind = similarity_class(F.col("max_sim"))
    by = Window.partitionBy("component")
    out = marked.withColumn("article_type", kind)
    drop = (F.col("article_type") == "duplicate") & ~F.col("is_primary") & F.lit(mode != "all")
    if mode == "safe":
        left = F.sum(F.when((F.col("article_type") == "duplicate") & F.col("is_primary"), 1).otherwise(0)).over(by)
        first = F.row_number().over(Window.partitionBy("component", "article_type").orderBy("pos"))
        drop = drop & ~((left == 0) & (first == 1))
    members = out.groupBy("component").agg(F.count("*").alias("cluster_size"), F.sort_array(F.collect_list(F.struct("pos", "url"))).alias("members"))
    kept = out.withColumn("_drop", drop).where("not _drop").drop("_drop").join(members, "component")
    others = F.transform(F.filter("members", lambda m: m.pos != F.col("pos")), lambda m: m.url)
    return kept.withColumns({"duplicate_urls": others, "max_similarity": F.round("max_sim", 4), "layer1_exact_removed": removed if isinstance(removed, Column) else F.lit(removed)}).drop("members")


def hashed_embedder(df: DataFrame, text: str = "text", dims: int = 256, least_chars: int = 200, most_chars: int = 2000) -> DataFrame:
    """`df` with `vector`, the offline default of the embedder slot: hashed counts of character trigrams, normalised;
    null under `least_chars`. Any transform with the same columns may stand in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            vectors = []
            for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                if t is None or len(t) < least_chars:
                    vectors.append(None)
                    continue
                v = np.zeros(dims)
                for i in range(min(len(t), most_chars) - 2):
                    v[zlib.crc32(t[i : i + 3].encode()) % dims] += 1
                vectors.append((v / np.linalg.norm(v)).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vectors, pa.list_(pa.float64()))], names=[*batch.schema.names, "vector"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, vector array<double>")
