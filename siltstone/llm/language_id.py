"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram's vector binds
(multiplies) its letters' vectors, each permuted (rotated) by its place; a text's vector bundles (adds)
those of its n-grams, a language's prototype those of its training texts. The answer is the language
whose prototype has the largest cosine with the text's vector.

Sums are of whole numbers, so results depend neither on batches nor on the order of rows.

Defined cases: a null text or one without a letter is `und` with score 0, as is every text if nothing
could be learned; ties go to the first language in code-point order; rows with null language or text
teach nothing; repeated rows count as often as they come; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltstone.llm._base import fold, in_bytes, mix

UNKNOWN = "und"


def letter_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: the distinct trigrams around letters, as three code points each (0 where there is no
    letter), which of them each letter has, and the n + 1 offsets of each text's letters."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le", "replace"), np.uint32)
    offsets = np.cumsum([1, *(len(t) + 1 for t in low)])
    letter = _letters()[points]
    at = np.flatnonzero(letter)
    there = np.zeros(0x110000, bool)
    there[points[at]] = True
    alphabet = np.concatenate([[0], np.flatnonzero(there)])
    size = len(alphabet)
    rank = np.zeros(0x110000, np.int32)
    rank[alphabet] = np.arange(size)
    marks = np.where(letter, rank[points], 0)
    keys = (marks[at - 1].astype(np.int64) * size + marks[at]) * size + marks[at + 1]
    if size**3 <= max(1 << 20, 4 * len(keys)):  # a table is faster than sorting while it is small
        seen = np.zeros(size**3, bool)
        seen[keys] = True
        known = np.flatnonzero(seen)
        place = np.zeros(size**3, np.int32)
        place[known] = np.arange(len(known))
        which = place[keys]
    else:
        known, which = np.unique(keys, return_inverse=True)
    grams = alphabet[np.stack([known // (size * size), known // size % size, known % size], axis=1)]
    return grams, which, np.searchsorted(at, offsets)


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _signs(points: np.ndarray, dims: int) -> np.ndarray:
    """The letters' vectors, one row each."""
    blocks = np.arange(dims // 64, dtype=np.uint64) + np.uint64(1)
    bits = mix(mix(points.astype(np.uint64) + np.uint64(77))[:, None] + blocks[None, :] * np.uint64(0xD1342543DE82EF95))
    return np.unpackbits(bits.view(np.uint8).reshape(len(points), dims // 8), axis=1).astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, dims: int) -> np.ndarray:
    """One bound vector for each row of code points."""
    out = np.ones((len(grams), dims), np.int8)
    for place in range(3):
        points, which = np.unique(grams[:, place], return_inverse=True)
        out *= np.roll(_signs(points, dims), 2 - place, axis=1)[which]
    return out


#: Letters of the texts that are bundled at once, and trigrams whose vectors are held at once.
_PIECE, _HELD = 1 << 17, 1 << 13


def _counts(group: np.ndarray, groups: int, which: np.ndarray, n: int) -> np.ndarray:
    """How often each of n trigrams is in each group."""
    return np.bincount(group * n + which, minlength=groups * n).reshape(groups, n)


def _added(grams: np.ndarray, which: np.ndarray, offsets: np.ndarray, dims: int) -> np.ndarray:
    """The sum of the vectors of each text's trigrams; memory is bounded by pieces whatever the number of texts and trigrams.
    Counts by text and trigram are multiplied where that table is well filled, else vectors are added up letter by letter."""
    n, out = len(offsets) - 1, np.zeros((len(offsets) - 1, dims))
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _PIECE, "right")) - 1)
        mine = which[offsets[a] : offsets[b]]
        row = np.repeat(np.arange(b - a), np.diff(offsets[a : b + 1]))
        known, inner = np.unique(mine, return_inverse=True)
        if (b - a) * len(known) <= 64 * len(mine):
            for k in range(0, len(known), _HELD):
                some = (inner >= k) & (inner < k + _HELD)
                size = min(_HELD, len(known) - k)
                out[a:b] += _counts(row[some], b - a, inner[some] - k, size).astype(np.float32) @ gram_vectors(grams[known[k : k + size]], dims).astype(np.float32)
        else:
            for k in range(0, len(mine), _HELD):
                rows = row[k : k + _HELD]
                first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                out[a + rows[first]] += np.add.reduceat(gram_vectors(grams[mine[k : k + _HELD]], dims), first, axis=0, dtype=np.int32)
        a = b
    return out


def bundle(texts: list[str | None], dims: int) -> np.ndarray:
    """The vector of each text."""
    return _added(*letter_grams(texts), dims)


def learn(docs: DataFrame, dims: int = 512) -> dict[str, np.ndarray]:
    """Prototypes by language, from every row with a text and a language: each task sends one vector a language."""
    if dims % 64:
        raise ValueError("dims must be a multiple of 64")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in in_bytes(batches, most=1 << 19):
            langs = batch.column("lang").to_pylist()
            grams, which, offsets = letter_grams(batch.column("text").to_pylist())
            names = sorted(set(langs))
            group = np.repeat([names.index(x) for x in langs], np.diff(offsets)).astype(np.int64)
            for k in range(0, len(grams), _HELD):
                some = (which >= k) & (which < k + _HELD)
                size = min(_HELD, len(grams) - k)
                sums_of = _counts(group[some], len(names), which[some] - k, size).astype(np.float64) @ gram_vectors(grams[k : k + size], dims)
                for name, vector in zip(names, sums_of, strict=True):
                    total[name] = total.get(name, 0) + vector
        if total:
            yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "vector": pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))})

    rows = docs.select("text", "lang").where("text is not null and lang is not null").mapInArrow(sums, "lang string, vector array<double>")
    flat = rows.select("lang", F.posexplode("vector").alias("at", "v")).groupBy("lang", "at").agg(F.sum("v").alias("v"))
    found = flat.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("vector")).orderBy("lang").collect()
    return {r.lang: np.array([x.v for x in r.vector]) for r in found}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: list[str]) -> DataFrame:
    """`keep` columns of every row, with lang_pred and score (the cosine, negative ones as 0)."""
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] / (np.linalg.norm(prototypes[n]) or 1) for n in names])
    dims = matrix.shape[1] if names else 64

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, most=1 << 19):
            grams, which, offsets = letter_grams(batch.column("text").to_pylist())
            vectors = _added(grams, which, offsets, dims)
            norms = np.linalg.norm(vectors, axis=1)
            some = (np.diff(offsets) > 0) & bool(names)  # a letter; vectors that add up to nothing are as far from all
            if names:
                cosines = np.round(vectors @ matrix.T / np.where(norms > 0, norms, 1)[:, None], 9)
                best, score = cosines.argmax(axis=1), np.clip(cosines.max(axis=1), 0, 1)
            else:
                best = score = np.zeros(batch.num_rows, int)
            label = pa.array([names[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), label, pa.array(np.where(some, score, 0.0).astype(np.float64))], names=[*keep, "lang_pred", "score"])

    frame = docs.select(*dict.fromkeys([*keep, "text"]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name in keep)
    return frame.mapInArrow(predict, f"{kinds}, lang_pred string, score double")


def op4(docs: DataFrame, dims: int = 512) -> DataFrame:
    """The query's digest: learn where crc32(doc_id) mod 4 is not 2, answer for every row."""
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    prototypes = learn(docs.where(~held & F.col("doc_id").isNotNull()), dims)
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), prototypes, ["doc_id", "held_out"])
