"""Shared scratch tables, fold arithmetic and array plumbing of the subpackage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_OWN_DIR: list[str] = []
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a temporary one only where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="siltstone-"))
    return f"file://{_OWN_DIR[0]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: lineage ends there, so a lost executor
    never recomputes what came before, and later jobs do not repeat the work."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, min(int(before), 1000) if int(before) > 0 else 1000)  # texts and packed rows are large: small batches to and from Python
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a settled table that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shared(df: DataFrame) -> DataFrame:
    """`df` for several jobs: what it shuffles is shuffled once and read by each of them, where every plan made from `df` itself would
    shuffle it anew and keep the files of all. Nothing is stored besides; if an executor is lost, its part is shuffled again."""
    spark = df.sparkSession
    rows = df._jdf.queryExecution().toRdd()
    return type(df)(spark._jsparkSession.internalCreateDataFrame(rows, df._jdf.schema(), False), spark)


def sweep(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that are no longer held: Spark deletes them once the driver's garbage is collected, so
    until then a job of several steps keeps the files of all of them. Plans that are still held keep theirs."""
    for _ in range(2):  # Spark's listeners may still hold the last plan the first time
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def fold(doc_id: Column, k: int) -> Column:
    """crc32(doc_id as text) mod k; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % k


def in_bytes(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of `column` (or one row), so that the numpy
    temporaries of an operator stay bounded whatever the Arrow batch size is. A text is never cut."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = offsets_of(batch.column(column))[1][1:]
        at, base = 0, 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(at, to - at)
            base, at = int(ends[to - 1]), to


def offsets_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the n + 1 offsets into them; nulls are empty."""
    if array.null_count:
        array = array.fill_null("" if not pa.types.is_binary(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offs, data = array.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


#: Bytes that part words: space and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of all texts, and the n + 1 offsets of each text's words."""
    inside = ~SPACE[raw]
    first, last = inside.copy(), inside.copy()
    if len(raw):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[heads] = inside[heads]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_ROOM = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) mod 2 ** 64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, _ROOM), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span, from prefix sums of a polynomial hash; equal bytes, equal hash."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[raw] * _powers(_BASE, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts]
    return mix(h + np.uint64(seed) + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_hashes(items: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of k consecutive items (n - k + 1 of them)."""
    n = len(items) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, seed, np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + items[i : i + n]
        h ^= h >> np.uint64(29)
    return mix(h)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start .. start + length - 1 of every span, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


def sum_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[i]:offsets[i + 1]], 0 for empty spans."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def dealt(packed: DataFrame, buckets: int, by: str = "bucket") -> DataFrame:
    """`packed` rows dealt out by their bucket, each bucket's rows together: a task takes one bucket after the other
    from a sorted shuffle, which spills by itself, and never holds its whole partition."""
    return packed.repartition(buckets, by).sortWithinPartitions(by)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows (without the bucket, their first column) of one bucket after the other."""
    at, held = None, []
    for batch in batches:
        for k, *row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if k != at:
                if held:
                    yield at, held
                at, held = k, []
            held.append(tuple(row))
    if held:
        yield at, held


def bucket_count(spark: SparkSession, size: int, target: int) -> int:
    """Buckets of about `target` for data of `size` (both in the same unit); at least one a shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // target), 1)


def in_buckets(bucket: np.ndarray, *columns) -> Iterator[tuple[int, list[bytes]]]:
    """The rows of each bucket: the bucket, and what each column's function makes of the rows' places."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    there, first = np.unique(bucket[order], return_index=True)
    for k, a, b in zip(there.tolist(), first, np.append(first[1:], len(order)), strict=True):
        yield k, [f(order[a:b]) for f in columns]


_WIDTHS = (np.uint8, np.uint16, np.uint32, np.uint64)


def shrink(x: np.ndarray) -> bytes:
    """Whole numbers as offsets from the least, in as few bytes each as hold the largest."""
    if not len(x):
        return b""
    x = x.astype(np.int64, copy=False)
    low = int(x.min())
    span = int(x.max()) - low
    kind = next(i for i, t in enumerate(_WIDTHS) if span <= np.iinfo(t).max)
    rest = (x.view(np.uint64) - np.uint64(low % (1 << 64))).astype(_WIDTHS[kind])
    return bytes([kind]) + low.to_bytes(8, "little", signed=True) + rest.tobytes()


def grow(packed: bytes) -> np.ndarray:
    """What shrink() packed."""
    if not packed:
        return np.zeros(0, np.int64)
    low = int.from_bytes(packed[1:9], "little", signed=True)
    return (np.frombuffer(packed, _WIDTHS[packed[0]], offset=9).astype(np.uint64) + np.uint64(low % (1 << 64))).view(np.int64)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges (a, b), and the least node that each is connected with."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y, label[x], label[y]):
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, label):
            return ids, ids[label]
        label = new


def sized(small: DataFrame, most: int) -> DataFrame:
    """`small`, marked for broadcast only if it was counted to have at most `most` rows; else joins shuffle."""
    return F.broadcast(small) if small.limit(most + 1).count() <= most else small


def shuffled(df: DataFrame) -> DataFrame:
    """`df`, marked for a join that shuffles: the optimizer judges a table by its compressed files, and so would
    send tables that grow with the corpus through the driver as long as their files are small."""
    return df.hint("merge")


#: Bits of a bitmap of keys: so many a key, within these bounds; in pieces, each made by one group.
_SPARE, _LEAST, _MOST, _PIECE = 32, 1 << 21, 1 << 26, 1 << 15


def among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """`rows` without most of those whose `key` is not in `keys`, so that a join with `keys` shuffles few texts in vain. All rows that
    join stay; of the others about one in 32 does, more once `keys` has over 2^21 rows. Tasks get a bitmap of 8 MB at most, however many
    the keys are."""
    bits = min(max(_LEAST, 1 << (_SPARE * keys.count()).bit_length()), _MOST)
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    marks = keys.select(F.floor(place / _PIECE).alias("piece"), (place % _PIECE).alias("bit")).repartition("piece")
    bitmap = np.zeros((bits // _PIECE, _PIECE // 8), np.uint8)
    for r in marks.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        bitmap[r.piece] = np.frombuffer(r.bits, np.uint8)
    sent = rows.sparkSession.sparkContext.broadcast(bitmap.reshape(-1))

    @F.pandas_udf("boolean")
    def marked(at: pd.Series) -> pd.Series:
        at = at.to_numpy()
        return pd.Series((sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0)

    return rows.where(marked(place))


#: The contract's white space, for SQL: space and \\x09-\\x0D.
BLANKS = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def pinned(value: Column) -> Column:
    """`value`, made once for each row: the optimizer moves a column's making into the lambda that reads it,
    where it would run for every element, unless it is marked as not deterministic, as here."""
    return F.when(F.monotonically_increasing_id() >= 0, value)
