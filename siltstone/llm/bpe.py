"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of its last ROLL bytes has its low `bits` bits zero (512 bytes a chunk on average, some dozens of
words), wherever that falls in a word, so equal passages are cut alike wherever they stand. Each distinct chunk is encoded once
and kept by its hash in the worker's memo, which all documents of its tasks share; so are the words that new chunks consist of. Memos are
bounded, and what falls out is encoded again.

Joins are repaired: of a join inside a word, the word's two pieces and the whole word are encoded; where the pieces' ids, which the
chunks end and begin with, are not the whole word's, they give way to those. Words are what lies between white space, as the tokenizer
parts no word there and leaves no trace of it (probed when it is loaded). A chunk without white space is joined with the one before.
With a tokenizer that keeps white space, whole chunks are encoded together, and where the ids differ the join is dissolved and the merged
chunk encoded anew, until all joins agree.

Decoding is the library's for tokenizers without a decoder: the tokens' strings, joined by one space.

Defined cases: null text counts as empty; an empty text has no ids and decodes to the empty string;
white space alone has no ids; a text of any length is encoded whole (the cache is bounded, not the
text); repeated rows are each answered; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm._base import SPACE, in_bytes, offsets_of, ragged, span_hashes, word_spans

_LOADED: dict[str, Codec] = {}
#: Bytes that the rolling hash sees.
ROLL = 16


class Memo:
    """Ids by hash, in sorted arrays: of 64-bit hashes, where their ids begin, how many there are, and all ids in a row."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.hashes, self.starts, self.sizes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each hash, where it is and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def room(self, new: int) -> bool:
        """Whether `new` more ids fit; if not, the memo is emptied."""
        if len(self.ids) + new <= self.most or not len(self.ids):
            return True
        self.clear()
        return False

    def add(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """New, sorted, distinct hashes with their ids in a row."""
        at = np.searchsorted(self.hashes, hashes)
        self.starts = np.insert(self.starts, at, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes, self.hashes = np.insert(self.sizes, at, sizes), np.insert(self.hashes, at, hashes)
        self.ids = np.concatenate([self.ids, ids])


class Codec:
    """A tokenizer file with its chunk cache; one for each Python worker and file."""

    def __init__(self, path: str, bits: int = 9, cached: int = 6 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.mask = np.uint64((1 << bits) - 1)
        self.chunks, self.words = Memo(cached), Memo(cached)
        #: Chunks met and encoded, joins inside a word, and those repaired; for tests and figures.
        self.counts = dict.fromkeys(("chunks", "encoded", "joins", "repaired"), 0)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        tokens = [(self.tokenizer.id_to_token(i) or "").encode() + b" " for i in range(size)]
        self.token_ends = np.cumsum([len(t) for t in tokens])
        self.token_starts = self.token_ends - [len(t) for t in tokens]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.drops_space = self._drops_space()

    def _drops_space(self) -> bool:
        """Whether white space splits words and leaves no trace, for every byte that a cut can stand at."""
        one = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        probes = ("a", "Zq9", "'s", "́x", "Σ", "!?", "<|endoftext|>", "été", "7", "中")
        return all(one(a + gap + b) == one(a) + one(b) for a in probes for b in probes for gap in (" ", "\t", "\n", "\x0b", "\x0c", "\r", " \n ")) and not one(" ")

    def encode_all(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all `chunks` in a row, encoded now, and how many each has."""
        made = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        return np.fromiter((i for ids in made for i in ids), np.uint32, int(sizes.sum())), sizes

    def _word_ids(self, raw: np.ndarray, data: bytes, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids among which are those of all spans, each distinct one encoded once; where each span's begin and how many there are."""
        hashes, first, which = np.unique(span_hashes(raw, a, b), return_index=True, return_inverse=True)
        at, there = self.words.find(hashes)
        new = np.flatnonzero(~there)
        if len(new):
            if not self.words.room(8 * len(new)):
                new = np.arange(len(hashes))
            ids, sizes = self.encode_all([data[x:y] for x, y in zip(a[first[new]].tolist(), b[first[new]].tolist(), strict=True)])
            self.words.add(hashes[new], sizes, ids)
            at, _ = self.words.find(hashes)
        return self.words.ids, self.words.starts[at][which], self.words.sizes[at][which]

    def _chunk_ids(self, raw: np.ndarray, data: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of chunks, which lie side by side."""
        hashes, first, which = np.unique(span_hashes(raw, begin, end), return_index=True, return_inverse=True)
        at, there = self.chunks.find(hashes)
        new = np.flatnonzero(~there)
        if len(new):
            if not self.chunks.room(len(raw) // 2):
                new = np.arange(len(hashes))
            a, b, of = word_spans(raw, np.append(begin, len(raw)))
            many = np.diff(of)[first[new]]
            words = ragged(of[:-1][first[new]], many)
            ids, base, size = self._word_ids(raw, data, a[words], b[words])
            total = np.concatenate([[0], np.cumsum(size)])
            edges = np.concatenate([[0], np.cumsum(many)])
            self.chunks.add(hashes[new], np.diff(total[edges]), ids[ragged(base, size)])
            self.counts["encoded"] += len(new)
            at, _ = self.chunks.find(hashes)
        self.counts["chunks"] += len(begin)
        return self.chunks.ids, self.chunks.starts[at][which], self.chunks.sizes[at][which]

    def _cuts(self, raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        """Where chunks begin, texts' starts included; `gaps` are the places of white space."""
        n = len(raw)
        at = np.arange(ROLL, n)
        hashes = span_hashes(raw, at - ROLL, at)
        at = at[((hashes & self.mask) == 0) & ((raw[ROLL:] & 0xC0) != 0x80)]
        text = np.searchsorted(offsets, at, "right") - 1
        at = at[at - ROLL >= offsets[text]]  # the window lies within the text
        starts = offsets[:-1][offsets[:-1] < offsets[1:]]
        while True:
            cuts = np.union1d(starts, at)
            spaces = np.searchsorted(gaps, np.append(cuts[1:], n)) - np.searchsorted(gaps, cuts)
            inner = np.isin(cuts, at) & np.isin(np.append(cuts[1:], n), at)
            bare = cuts[inner & (spaces == 0)]
            if not len(bare):
                return cuts
            at = np.setdiff1d(at, bare)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the n + 1 offsets of each text's ids."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        gaps = np.flatnonzero(SPACE[raw])
        begin = self._cuts(raw, offsets, gaps)
        end = np.append(begin[1:], len(raw))
        per_text = np.searchsorted(begin, offsets)
        if not self.drops_space:
            return self._repaired(raw, offsets, begin, per_text)
        data = raw.tobytes()

        flat, base, size = self._chunk_ids(raw, data, begin, end)
        # a join lies inside a word if no white space is on either side of it
        join = np.flatnonzero(~np.isin(begin, offsets) & ~SPACE[raw[begin]] & ~SPACE[raw[begin - 1]])
        self.counts["joins"] += len(join)
        place = begin[join]
        text = np.searchsorted(offsets, place, "right") - 1
        at = np.searchsorted(gaps, place)
        left = np.maximum(np.append(-1, gaps)[at] + 1, offsets[text])
        right = np.minimum(np.append(gaps, len(raw))[at], offsets[text + 1])
        ids, bases, sizes = self._word_ids(raw, data, np.concatenate([left, place, left]), np.concatenate([place, right, right]))
        (head_base, tail_base, word_base), (head, tail, word) = np.split(bases, 3), np.split(sizes, 3)
        apart = head + tail != word
        same = np.flatnonzero(~apart)
        rows = np.repeat(same, word[same])
        inside = ragged(np.zeros(len(same), np.int64), word[same])
        source = np.where(inside < head[rows], head_base[rows] + inside, tail_base[rows] + inside - head[rows])
        differs = ids[source] != ids[word_base[rows] + inside]
        apart[np.unique(rows[differs])] = True
        fixed = np.flatnonzero(apart)
        self.counts["repaired"] += len(fixed)
        first, count = base.copy(), size.copy()
        first[join[fixed]] += tail[fixed]
        count[join[fixed]] -= tail[fixed]
        count[join[fixed] - 1] -= head[fixed]
        # chunks and repaired words in their order: the repaired word of a join stands before the chunk
        starts = np.stack([np.zeros(len(begin), np.int64), first], axis=1)
        lengths = np.stack([np.zeros(len(begin), np.int64), count], axis=1)
        starts[join[fixed], 0] = len(flat) + word_base[fixed]
        lengths[join[fixed], 0] = word[fixed]
        out = np.concatenate([flat, ids])[ragged(starts.reshape(-1), lengths.reshape(-1))]
        return out, np.concatenate([[0], np.cumsum(lengths.sum(axis=1))])[per_text]

    def _repaired(self, raw: np.ndarray, offsets: np.ndarray, cuts: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For tokenizers that keep white space: chunks reach to the next one's start, and every join is checked."""
        data, out, sizes = raw.tobytes(), [], [0]
        one = functools.lru_cache(4096)(lambda c: self.encode_all([c])[0])
        for i in range(len(offsets) - 1):
            edges = [int(offsets[i]), *(int(x) for x in cuts[per_text[i] : per_text[i + 1]][1:]), int(offsets[i + 1])]
            chunks = [data[x:y] for x, y in zip(edges, edges[1:], strict=False) if y > x]
            agreed = False
            while not agreed:
                agreed, merged = True, chunks[:1]
                for c in chunks[1:]:
                    if np.array_equal(one(merged[-1] + c), np.concatenate([one(merged[-1]), one(c)])):
                        merged.append(c)
                    else:
                        merged[-1] += c
                        agreed = False
                chunks = merged
            ids = np.concatenate([one(c) for c in chunks]) if chunks else np.zeros(0, np.uint32)
            out.append(ids)
            sizes.append(sizes[-1] + len(ids))
        return np.concatenate(out) if out else np.zeros(0, np.uint32), np.array(sizes)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The decoded UTF-8 bytes of each text."""
        if self.tokenizer.decoder is not None:
            return [self.tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False).encode() for a, b in zip(offsets, offsets[1:], strict=False)]
        lengths = (self.token_ends - self.token_starts)[ids]
        text = self.token_bytes[ragged(self.token_starts[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[offsets].tolist()
        return [text[a : max(a, b - 1)] for a, b in zip(ends, ends[1:], strict=False)]


def codec(path: str, bits: int = 9) -> Codec:
    """The worker's codec of a tokenizer file."""
    key = f"{path}:{bits}"
    if key not in _LOADED:
        _LOADED[key] = Codec(path, bits)
    return _LOADED[key]


def encode_texts(docs: DataFrame, path: str, keep: list[str], bits: int = 9) -> DataFrame:
    """`keep` columns of every row, its `ids` and its `decoded` text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, bits)
        for batch in in_bytes(batches):
            ids, offsets = coder.encode(*offsets_of(batch.column("text")))
            decoded = [x.decode() for x in coder.decode(ids, offsets)]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists, pa.array(decoded, pa.string())], names=[*keep, "ids", "decoded"])

    frame = docs.select(*dict.fromkeys([*keep, "text"]))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema if f.name in keep)
    return frame.mapInArrow(run, f"{kinds}ids array<int>, decoded string")


def op7(docs: DataFrame, path: str, bits: int = 9) -> DataFrame:
    """The query's digest: the number of ids and the digests of ids and decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, bits)
        for batch in in_bytes(batches):
            ids, offsets = coder.encode(*offsets_of(batch.column("text")))
            raw, edges = ids.astype("<u4").tobytes(), offsets.tolist()
            sha = lambda parts: pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), sha(raw[4 * a : 4 * b] for a, b in zip(edges, edges[1:], strict=False)), sha(coder.decode(ids, offsets))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    frame = docs.select("doc_id", "text")
    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
