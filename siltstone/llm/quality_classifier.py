"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Each text becomes STATISTICS numbers, transformed to be roughly Gaussian within a class. A class has a
mean and a covariance, shrunk towards the pooled one and that towards a multiple of the identity; their
Cholesky factors are computed once. A score is the logistic of the difference of the two log densities
(from Mahalanobis distances) and of the log priors.

Class moments are sums over all labelled rows that may be learned from; a task sends one matrix a class.

Defined cases: null text counts as empty; an empty text has a score like any other; rows of `labels`
with null doc_id or quality teach nothing, repeated ones count as often as they come; with one class or
none to learn, every score is the smoothed share of label 1 (0.5 without labels); a null doc_id is never
learned from and is not held out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltstone.llm._base import LOWER, fold, in_bytes, mix, offsets_of, run_hashes, settle, span_hashes, sum_by, word_spans

STATISTICS = ("words", "word_mean", "word_spread", "upper", "digits", "symbols", "marks", "stops", "wide", "distinct", "commonest", "trigrams", "lines_again", "line_mean", "line_ends", "short", "entropy")


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars.encode())] = 1
    return out


_UPPER, _DIGIT = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789")
_SYMBOL, _MARK, _STOP = _table("#*$%&|<>@^~=+_{}[]\\"), _table("!?;:"), _table(".,")
_LEAD = (np.arange(256) & 0xC0) != 0x80
_WIDE = (np.arange(256) >= 0xC0).astype(np.uint8)


def _logit(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def _distinct(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each text and the largest number of equal ones."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    _, first, count = np.unique(mix(keys + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, row[first], count)
    return np.bincount(row[first], minlength=n), most


def statistics(array: pa.Array) -> np.ndarray:
    """The transformed statistics of each text, one row each, from whole texts."""
    raw, offsets = offsets_of(array)
    n = len(array)
    starts, ends, words = word_spans(raw, offsets)
    n_words = np.diff(words)
    per = lambda table: sum_by(table[raw], offsets)
    lead = np.concatenate([[0], np.cumsum(_LEAD[raw], dtype=np.int64)])
    chars, length = lead[offsets[1:]] - lead[offsets[:-1]], lead[ends] - lead[starts]
    mean = sum_by(length, words) / np.maximum(n_words, 1)
    spread = np.sqrt(np.maximum(sum_by(length**2, words) / np.maximum(n_words, 1) - mean**2, 0))
    hashes = span_hashes(LOWER[raw], starts, ends)
    distinct, commonest = _distinct(hashes, words)
    grams = run_hashes(hashes, 3)
    inside = words[:-1], np.maximum(words[1:] - 2, words[:-1])
    keep = np.zeros(len(grams) + 1, np.int64)
    np.add.at(keep, inside[0][inside[1] > inside[0]], 1)
    np.add.at(keep, inside[1][inside[1] > inside[0]], -1)
    kept = np.cumsum(keep)[:-1] > 0 if len(grams) else np.zeros(0, bool)
    windows = np.concatenate([[0], np.cumsum(inside[1] - inside[0])])
    new, _ = _distinct(grams[kept], windows)
    newline = raw == 10
    line_start = np.zeros(len(raw), bool)
    line_start[offsets[:-1][offsets[:-1] < len(raw)]] = True
    line_start[1:] |= newline[:-1]
    first = np.flatnonzero(line_start & ~newline)
    stop = np.append(np.flatnonzero(newline), len(raw))
    last = np.minimum(stop[np.searchsorted(stop, first)], offsets[np.searchsorted(offsets, first, "right")]) if len(first) else first
    lines = np.searchsorted(first, offsets)
    n_lines = np.diff(lines)
    line_new, _ = _distinct(span_hashes(raw, first, last), lines)
    closed = sum_by(np.isin(raw[last - 1], list(b".!?")).astype(np.int64) if len(first) else np.zeros(0, np.int64), lines)
    letters = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * 256 + LOWER[raw], minlength=n * 256).reshape(n, 256)
    share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    return np.column_stack([
        np.log1p(n_words), np.log1p(mean), np.log1p(spread), _logit(per(_UPPER), chars), _logit(per(_DIGIT), chars), _logit(per(_SYMBOL), chars), _logit(per(_MARK), chars), _logit(per(_STOP), chars), _logit(per(_WIDE), chars),
        _logit(n_words - distinct, n_words), _logit(commonest, n_words), _logit(windows[1:] - windows[:-1] - new, np.diff(windows)), _logit(n_lines - line_new, n_lines), np.log1p(chars / np.maximum(n_lines, 1)), _logit(closed, n_lines), _logit(sum_by(length <= 3, words), n_words), entropy,
    ])


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` columns of every row and its statistics as an array."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches):
            values = pa.FixedSizeListArray.from_arrays(pa.array(statistics(batch.column("text")).reshape(-1)), len(STATISTICS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), values], names=[*keep, "stats"])

    frame = docs.select(*dict.fromkeys([*keep, "text"]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name in keep)
    return frame.mapInArrow(measure, f"{kinds}, stats array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Centre and scale of the statistics, and of each class its mean, inverse Cholesky factor and log weight."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    flat: float | None = None

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(stats), self.flat)
        z = (stats - self.centre) / self.scale
        log = [w - 0.5 * (((z - m) @ root.T) ** 2).sum(axis=1) for m, root, w in zip(self.means, self.roots, self.weights, strict=True)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(rows: DataFrame, pooled: float = 0.1, ridge: float = 0.02) -> Discriminant:
    """From rows (stats, quality). `pooled` and `ridge` are the shares of the pooled covariance and of the identity."""
    d = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.array(batch.column("stats").flatten()).reshape(-1, d)
            y = np.array(batch.column("quality"))
            for k in (0, 1):
                z = x[y == k]
                total[k] += np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).reshape(-1)])
        yield pa.RecordBatch.from_pydict({"moments": pa.array([total.reshape(-1).tolist()], pa.list_(pa.float64()))})

    parts = rows.select("stats", "quality").where("quality in (0, 1)").mapInArrow(moments, "moments array<double>")
    sums = parts.select(F.posexplode("moments").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    total = np.array([r.v for r in sums] or np.zeros(2 * (1 + d + d * d))).reshape(2, -1)
    n = total[:, 0]
    if min(n) < 2:
        return Discriminant(*[np.zeros(0)] * 5, flat=float((n[1] + 1) / (n.sum() + 2)))
    means = total[:, 1 : 1 + d] / n[:, None]
    covs = total[:, 1 + d :].reshape(2, d, d) / n[:, None, None] - means[:, :, None] * means[:, None, :]
    within = (covs * (n / n.sum())[:, None, None]).sum(axis=0)
    centre, scale = means[1], np.sqrt(np.maximum(np.diag(within), 1e-6))
    covs, within = covs / np.outer(scale, scale), within / np.outer(scale, scale)
    roots, weights = [], []
    for k in (0, 1):
        cov = (1 - pooled) * covs[k] + pooled * within
        cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        chol = np.linalg.cholesky(cov)
        roots.append(np.linalg.inv(chol))
        weights.append(np.log(n[k] / n.sum()) - np.log(np.diag(chol)).sum())
    return Discriminant(centre, scale, (means - centre) / scale, np.array(roots), np.array(weights))


def apply(rows: DataFrame, model: Discriminant, keep: list[str]) -> DataFrame:
    """`keep` columns and the score of rows that have `stats`."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("stats").flatten()).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(model.score(x))], names=[*keep, "score"])

    frame = rows.select(*keep, "stats")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name in keep)
    return frame.mapInArrow(scored, f"{kinds}, score double")


def op1(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The query's digest: learn from labels whose crc32(doc_id) mod 5 is not 0, score every row."""
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    rows = settle(with_statistics(docs.select("doc_id", held.alias("held_out"), "text"), ["doc_id", "held_out"]), "op1-statistics")
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null")
    model = fit(rows.where("not held_out and doc_id is not null").join(known, "doc_id"))
    return apply(rows, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
