"""LM scoring: logistic context mixing over the bits of a text.

A text is its words, lower-cased, and an end mark. A frequent word is one symbol of a prefix code over the corpus's frequent
words; another is an escape and its bytes, each by a fixed prefix code. Every bit of a code is predicted from three hashed contexts:
  low      the bit's place in the code (for spelled bytes, with the two bytes before);
  high     that with the word before (the four bytes before): counts of zeros and ones in a slot of a table;
  match    the continuation that the whole corpus has for the last three words: exact, and as large as the corpus is.
The predictions, as log odds, are added with weights that a gate chooses from the kind of symbol, from how often the high
context was seen and from how long the match has held; the sum is refined by an adaptive table from (gate, probability) to the
observed share of ones. A text's score is the sum of the log10 probabilities of its bits.

Counts are sums over all training texts, and so are matches: each place after three words whose hash has its last bits zero is an anchor
with the SPAN tokens that follow. What follows an anchor seen twice or more is its most frequent continuation; anchors stay dealt
out by hash, grow with the corpus, and meet the documents that hold them there. So passages and documents that occur
twice are told apart at any size.

Weights and refining table are learned from all training texts, each predicted from counts without its own: one step of Newton's
method for the coding cost, gate by gate, and the shares of ones. Both are sums of whole numbers, so scores depend on the data
alone, not on partitions. The step starts where online learning from the SAMPLE training documents of least hash of their id ends.

Fixed bounds: tables of 2 ** 20 and 2 ** 22 slots, words with at least one in 2 ** 20 of all tokens (so at most 2 ** 20), anchors with at least one
in 2 ** 16 of all anchors (at most 2 ** 16) are sent to all tasks; the step starts from SAMPLE whole texts.
The counts of other words stay dealt out by hash and meet the tokens that ask for them there, packed.

Defined cases: null text counts as empty and is one end mark; without training texts every count is 0 and every bit
has the same probability; a null doc_id is never learned from and is not held out; repeated rows each count and
are each answered; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from siltstone.llm._base import LOWER, bucket_count, by_bucket, dealt, discard, fold, grow, in_buckets, in_bytes, mix, offsets_of, ragged, run_hashes, settle, shared, shrink, span_hashes, sum_by, sweep, word_spans

#: Slots of the two tables, as powers of two: a low context is one of at most 2 ** 20 words' places or of pairs of bytes.
BITS = (20, 22)
#: Hashed tables, and predictors in all.
TABLES, PREDICTORS = 2, 3
#: Words of an anchor's context, one anchor in so many places, and tokens kept after it.
CONTEXT, EVERY, SPAN = 3, 8, 12
#: Training documents from whose weights the step over all training texts starts.
SAMPLE = 400
#: Gates: spelled or not, how often the high context was seen, how long the match has held (0: no match).
SEEN, HELD = 4, 5
GATES = 2 * SEEN * HELD
STEPS = 33
#: Steps of the tables that stand for the logistic and the logarithm.
FINE = 4096
#: Log odds of a matched bit before its weight.
MATCHED = 4.0
_ADD = 0.4
#: Counts in a block that travels, and tasks whose counts are summed at once.
WIDTH, TOGETHER = 1 << 17, 64
#: Fixed value: bytes in a rough order of frequency; codes get longer along it.
_COMMON = bytes([32, *b"eatonirshdlcumpgfybvwk.,jxqz", 0, 0xC3, *b"-'|!0123456789\":;?#*%&$()[]=_/@+<>"])
_END_HASH = np.uint64(0xE7037ED1A0B428DB)


def prefix_code(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and codes of a Huffman code for the weights, in the order of (length, place); one symbol has one bit."""
    n = len(weights)
    if n == 1:
        return np.ones(1, np.int64), np.zeros(1, np.uint32)
    heap = [(float(w), k) for k, w in enumerate(weights.tolist())]
    heapq.heapify(heap)
    parent = np.zeros(2 * n - 1, np.int64)
    for node in range(n, 2 * n - 1):
        (x, a), (y, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a] = parent[b] = node
        heapq.heappush(heap, (x + y, node))
    depth = np.zeros(2 * n - 1, np.int64)
    for node in range(2 * n - 3, -1, -1):
        depth[node] = depth[parent[node]] + 1
    lengths = depth[:n]
    codes, code, last = np.zeros(n, np.uint32), 0, 0
    for k in np.lexsort((np.arange(n), lengths)).tolist():
        code <<= int(lengths[k]) - last
        last = int(lengths[k])
        codes[k] = code
        code += 1
    return lengths, codes


def _byte_code() -> tuple[np.ndarray, np.ndarray]:
    ranked = list(dict.fromkeys([*_COMMON, *range(0xA0, 0xC0), *range(256)]))
    weights = np.zeros(256)
    weights[ranked] = 1 / (np.arange(256) + 2) ** 1.1
    return prefix_code(weights)


BYTE_LENGTHS, BYTE_CODES = _byte_code()


def _short(hashes: np.ndarray) -> np.ndarray:
    """32 bits of token hashes, never 0."""
    return hashes.astype(np.uint32) | np.uint32(1)


class Sorted(NamedTuple):
    """Sorted hashes, and where those with each value of their leading bits begin: so the place of one is found in a step or two."""

    hashes: np.ndarray
    begin: np.ndarray
    shift: int

    @classmethod
    def of(cls, hashes: np.ndarray) -> Sorted:
        width = hashes.dtype.itemsize * 8
        bits = max(1, len(hashes).bit_length())
        heads = np.arange(1 << bits, dtype=hashes.dtype) << hashes.dtype.type(width - bits)
        return cls(hashes, np.searchsorted(hashes, heads).astype(np.int32), width - bits)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each hash, its first place and whether it is there; a place within bounds if it is not."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        last = len(self.hashes) - 1
        at = np.minimum(np.take(self.begin, hashes >> hashes.dtype.type(self.shift)), last).astype(np.int64)
        there = np.take(self.hashes, at)
        rest = np.flatnonzero(there < hashes)
        while len(rest):
            on = np.minimum(at[rest] + 1, last)
            moved = on > at[rest]
            at[rest], there[rest] = on, self.hashes[on]
            rest = rest[moved & (there[rest] < hashes[rest])]
        return at, there == hashes


class Words(NamedTuple):
    """The frequent words: sorted hashes, each one's count and rank; of each rank, then of the end mark and the escape, length and code;
    and the hashes cut to 32 bits, sorted, with the ranks of those."""

    hashes: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray
    lengths: np.ndarray
    codes: np.ndarray
    small: Sorted
    small_ranks: np.ndarray
    sorted: Sorted

    @classmethod
    def of(cls, hashes: np.ndarray, counts: np.ndarray, others: int, floor: float) -> Words:
        """From the frequent words, which may hold the end mark, and the number of tokens that are none of them."""
        order = np.lexsort((hashes, -counts))
        hashes, counts = hashes[order], counts[order]
        plain = hashes != _END_HASH
        ends = counts[~plain].sum()
        lengths, codes = prefix_code(np.concatenate([counts[plain], [max(ends, floor, 1), max(others, floor, 1)]]))
        rank = np.where(plain, np.cumsum(plain) - 1, plain.sum())
        by_hash, small = np.argsort(hashes), _short(hashes)
        by_small = np.argsort(small, kind="stable")
        return cls(hashes[by_hash], counts[by_hash], rank[by_hash], lengths, codes, Sorted.of(small[by_small]), rank[by_small], Sorted.of(hashes[by_hash]))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each hash, where it is and whether it is there."""
        return self.sorted.find(hashes)


class Tokens(NamedTuple):
    """Of texts: lower-cased bytes, starts and ends of words, each text's offsets in those; hashes of all tokens (words, and the
    end mark of each text) and each text's offsets in them."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray


def tokens(column: pa.Array) -> Tokens:
    raw, offsets = offsets_of(column)
    raw = LOWER[raw]
    starts, ends, words = word_spans(raw, offsets)
    n = len(words) - 1
    edges = words + np.arange(n + 1)
    hashes = np.full(int(edges[-1]), _END_HASH)
    hashes[np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(words))] = span_hashes(raw, starts, ends)
    return Tokens(raw, starts, ends, words, hashes, edges)


def some(t: Tokens, pick: np.ndarray) -> Tokens:
    """The same of some of the texts."""
    words, hashes = np.repeat(pick, np.diff(t.words)), np.repeat(pick, np.diff(t.offsets))
    edges = lambda x: np.concatenate([[0], np.cumsum(np.diff(x)[pick])])
    return Tokens(t.raw, t.starts[words], t.ends[words], edges(t.words), t.hashes[hashes], edges(t.offsets))


def anchors(t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of tokens that follow an anchor, its context's hash, and the text that it is in."""
    runs = run_hashes(t.hashes, CONTEXT)
    at = np.flatnonzero(runs % np.uint64(EVERY) == 0) + CONTEXT
    at = at[at < len(t.hashes)]
    doc = np.searchsorted(t.offsets, at, "right") - 1
    inside = at - CONTEXT >= t.offsets[doc]
    at, doc = at[inside], doc[inside]
    return at, runs[at - CONTEXT], doc


def following(t: Tokens, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The SPAN tokens from each place, as 32 bits of their hashes; 0 beyond the text."""
    places = at[:, None] + np.arange(SPAN)
    inside = places < t.offsets[doc + 1][:, None]
    return np.where(inside, _short(t.hashes[np.minimum(places, len(t.hashes) - 1)]), np.uint32(0))


def _hash32(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint32)
    for part in parts:
        h = (h ^ part.astype(np.uint32)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        h ^= h >> np.uint32(13)
    return h


class Bits(NamedTuple):
    """Of every bit: its slot in each table, value, gate without the level, and what the match says (-1, 0, 1); of
    every symbol, where its bits begin, and its text; of every token, where it is among the frequent words, and whether it is."""

    slots: list[np.ndarray]
    bits: np.ndarray
    gates: np.ndarray
    match: np.ndarray
    first: np.ndarray
    docs: np.ndarray
    at: np.ndarray
    known: np.ndarray


def bits(t: Tokens, words: Words, guess: np.ndarray | None = None) -> Bits:
    """The bits of all texts; `guess` has 32 bits of a predicted token's hash at each token, 0 for none."""
    at, known = words.find(t.hashes)
    n_words = len(words.lengths) - 2
    symbol = np.where(known, words.ranks[at] if len(words.ranks) else 0, n_words + 1)
    symbol[t.offsets[1:] - 1] = n_words
    doc = np.repeat(np.arange(len(t.offsets) - 1), np.diff(t.offsets))
    before = np.concatenate([[np.uint64(0)], t.hashes[:-1]])
    before[t.offsets[:-1]] = 0
    length, code = words.lengths[symbol], words.codes[symbol]
    held, valid, told_size, expected = (np.zeros(len(symbol), kind) for kind in (np.int64, np.int64, np.int64, np.uint32))
    if guess is not None and guess.any():
        asked = np.flatnonzero(guess)
        where, there = words.small.find(guess[asked])
        told = np.where(there, words.small_ranks[where] if len(words.small_ranks) else 0, n_words + 1)
        told_length, told_code = words.lengths[told], words.codes[told]
        apart = (code[asked].astype(np.int64) << (31 - length[asked])) ^ (told_code.astype(np.int64) << (31 - told_length))
        common = 31 - np.frexp(apart.astype(np.float64))[1]
        valid[asked] = np.minimum(common + 1, np.minimum(length[asked], told_length))
        expected[asked], told_size[asked] = told_code, told_length
        right = (guess != 0) & (guess == _short(t.hashes))
        held[asked] = 1 + np.digitize(_streak(right, t.offsets)[asked], (1, 4, 16))
    low, high = np.zeros(len(symbol), np.uint32), _hash32(before, before >> np.uint64(32))

    spelled = np.flatnonzero(~known[: len(t.hashes)])
    spelled = spelled[symbol[spelled] == n_words + 1]
    which = spelled - doc[spelled]  # words before it are its number less one end mark a text
    size = t.ends[which] - t.starts[which] + 1
    total = size + 4
    begin = np.cumsum(total) - total
    chars = np.zeros(int(total.sum()), np.uint8)
    chars[ragged(begin + 4, size - 1)] = t.raw[ragged(t.starts[which], size - 1)]
    chars[begin + total - 1] = 32
    spot = ragged(begin + 4, size)
    one, two, three, four = (chars[spot - k].astype(np.uint32) for k in (1, 2, 3, 4))
    here = chars[spot]
    m = len(spot)
    length = np.concatenate([length, BYTE_LENGTHS[here]])
    code = np.concatenate([code, BYTE_CODES[here]])
    doc = np.concatenate([doc, np.repeat(doc[spelled], size)])
    low = np.concatenate([low, _hash32(one, two + np.uint32(1 << 9))])
    high = np.concatenate([high, _hash32(one, two, three, four + np.uint32(1 << 10))])
    pad = np.zeros(m, np.int64)
    held, valid, expected, told_size = np.concatenate([held, pad]), np.concatenate([valid, pad]), np.concatenate([expected, pad.astype(np.uint32)]), np.concatenate([told_size, pad])

    end = np.cumsum(length)
    first = end - length
    each = lambda x: np.repeat(x.astype(np.uint32), length)
    total, plain = int(length.sum()), int(length[: len(symbol)].sum())
    rest = each(end)
    rest -= np.arange(total, dtype=np.uint32)
    node = each(code | np.left_shift(np.uint32(1), length.astype(np.uint32)))  # a one, then the bits so far
    bit = (node >> (rest - np.uint32(1))).astype(np.uint8) & np.uint8(1)
    node >>= rest
    node *= np.uint32(0x9E3779B1)
    node ^= node >> np.uint32(15)
    node *= np.uint32(0xC2B2AE35)
    node[plain:] ^= np.uint32(0x5BD1E995)
    slots = []
    for context, size in zip((low, high), BITS, strict=True):
        slot = each(context)
        slot ^= node
        slot >>= np.uint32(32 - size)
        slots.append(slot)
    say, gate = np.zeros(total, np.int8), np.zeros(total, np.uint8)
    gate[plain:] = HELD * SEEN
    told = np.flatnonzero(valid)
    if len(told):
        n = valid[told]
        place = ragged(np.zeros(len(told), np.int64), n)
        where = np.repeat(first[told], n) + place
        down = (np.repeat(told_size[told] - 1, n) - place).astype(np.uint32)
        say[where] = ((np.repeat(expected[told], n) >> down) & np.uint32(1)).astype(np.int8) * 2 - 1
        gate[where] += np.repeat((held[told] * SEEN).astype(np.uint8), n)
    return Bits(slots, bit, gate, say, first, doc, at, known)


def _streak(right: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many tokens just before each one were guessed right, within its text."""
    place = np.arange(len(right))
    wrong = np.where(~right, place, -1)
    wrong = np.maximum(np.concatenate([[-1], np.maximum.accumulate(wrong)[:-1]]), np.repeat(offsets[:-1], np.diff(offsets)) - 1)
    return place - 1 - wrong


def guesses(t: Tokens, at: np.ndarray, span: np.ndarray) -> np.ndarray:
    """The predicted token at each place, from anchors' places and what follows them; the nearest anchor counts."""
    out = np.zeros(len(t.hashes) + SPAN, np.uint32)
    end = t.offsets[np.searchsorted(t.offsets, at, "right")] if len(at) else at
    for k in range(SPAN - 1, -1, -1):
        there = (span[:, k] != 0) & (at + k < end)
        out[at[there] + k] = span[there, k]
    return out[: len(t.hashes)]


_LEVELS = (1, 4, 32)
#: Steps of one unit of log odds, and the most log odds, in 14 bits.
FINER, _MOST = 400, 20
_ODDS = np.arange(FINE) * 24 / (FINE - 1) - 12
_LOGISTIC = (1 / (1 + np.exp(-_ODDS))).astype(np.float32)


#: Parts of one in which slopes and curvatures are summed, the pairs of predictors, and what holds a weight of few bits in place.
_GRAIN, _HOLD = 1 << 12, 200.0
_PAIRS = [(i, j) for i in range(PREDICTORS) for j in range(i + 1)]


def without_own(counts: list[np.ndarray], b: Bits) -> list[np.ndarray]:
    """Each table's counts at every bit, without what the bit's own text added. `counts` change meanwhile and are put back."""
    edges = np.append(b.first, len(b.bits))
    heads = np.flatnonzero(np.concatenate([np.ones(min(len(b.docs), 1), bool), b.docs[1:] != b.docs[:-1]]))
    runs: dict[int, list[slice]] = {}  # a text's bits: those of its symbols, and those of the words it spells
    for doc, x, y in zip(b.docs[heads].tolist(), edges[heads].tolist(), edges[np.append(heads[1:], len(b.docs))].tolist(), strict=True):
        runs.setdefault(doc, []).append(slice(x, y))
    ones, out = np.ones(len(b.bits), np.float32), []
    for table, slots in zip(counts, b.slots, strict=True):
        flat, pairs, low = table.reshape(-1), table.view(np.uint64).reshape(-1), slots.astype(np.intp)
        own, found = low * 2 + b.bits, np.empty(len(low), np.uint64)  # both counts of a slot at once
        for mine in runs.values():
            kept = [pairs[low[x]] for x in mine]
            for x in mine:
                np.subtract.at(flat, own[x], ones[x])
            for x in mine:
                found[x] = pairs[low[x]]
            for x, counted in zip(mine, kept, strict=True):
                pairs[low[x]] = counted
        back = found.view(np.float32).reshape(-1, 2)
        out.append(np.maximum(back, 0, out=back))
    return out


class Mixer:
    """Log odds of low contexts; of high ones, log odds in steps of 1 / FINER and the level in the last two bits; weights by gate, and
    the refining table."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high
        self.weights = np.full((GATES, PREDICTORS), 0.4, np.float32)
        self.seen = np.zeros((GATES, STEPS, 2))
        self.logs = np.zeros(0, np.float32)

    @classmethod
    def of(cls, counts: list[np.ndarray]) -> Mixer:
        """From each table's counts by (slot, bit)."""
        low, high = (np.log(c[:, 1] + np.float32(_ADD)) - np.log(c[:, 0] + np.float32(_ADD)) for c in counts)
        high += np.float32(_MOST)
        high *= np.float32(FINER)
        steps = np.clip(np.rint(high, out=high), 0, 2 * _MOST * FINER, out=high).astype(np.uint16)
        steps <<= np.uint16(2)
        seen = counts[1][:, 0] + counts[1][:, 1]
        for least in _LEVELS:
            steps += seen >= least
        return cls(low.astype(np.float16), steps)

    def inputs(self, b: Bits) -> tuple[np.ndarray, np.ndarray]:
        """Log odds by predictor, and the gate, of every bit."""
        odds = np.empty((PREDICTORS, len(b.bits)), np.float32)
        odds[0] = self.low[b.slots[0]]
        high = self.high[b.slots[1]]
        np.multiply(high >> np.uint16(2), np.float32(1 / FINER), out=odds[1])
        odds[1] -= np.float32(_MOST)
        np.multiply(b.match, np.float32(MATCHED), out=odds[TABLES])
        return odds, b.gates + (high & np.uint16(3)).astype(np.intp)

    def mixed(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = np.zeros(odds.shape[1], np.float32)
        for k in range(len(odds)):
            total += odds[k] * np.take(np.ascontiguousarray(self.weights[:, k]), gate)
        return np.clip(total, -12, 12, out=total)

    def learn(self, odds: np.ndarray, gate: np.ndarray, bit: np.ndarray, rate: float = 0.3) -> None:
        """One online step on a text: gradient descent of the coding cost, gate by gate, then the refining counts."""
        mixed = self.mixed(odds, gate)
        error = bit - np.take(_LOGISTIC, np.rint((mixed + 12) * ((FINE - 1) / 24)).astype(np.int32))
        n = np.bincount(gate, minlength=GATES)
        for k in range(len(odds)):
            self.weights[:, k] += (rate * np.bincount(gate, weights=error * odds[k], minlength=GATES) / np.maximum(n, 200)).astype(np.float32)
        cell = gate * STEPS + np.rint((mixed + 12) * ((STEPS - 1) / 24)).astype(np.int32)
        both = np.bincount(cell * 2 + bit, minlength=GATES * STEPS * 2).reshape(GATES, STEPS, 2)
        self.seen[..., 0] += both.sum(axis=2)
        self.seen[..., 1] += both[..., 1]

    def surveyed(self, odds: np.ndarray, gate: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """What step() reads of some bits: by gate the slope and the curvature of the coding cost, and the refining counts. Each bit
        adds whole numbers, so sums are the same in any order."""
        mixed = self.mixed(odds, gate)
        p = np.take(_LOGISTIC, np.rint((mixed + 12) * ((FINE - 1) / 24)).astype(np.intp))
        error, bend = bit - p, p * (1 - p)
        cell = gate * STEPS + np.rint((mixed + 12) * ((STEPS - 1) / 24)).astype(np.intp)
        small = gate.astype(np.uint8)
        order = np.argsort(small, kind="stable")
        edges = np.searchsorted(small[order], np.arange(GATES + 1))
        here = np.flatnonzero(np.diff(edges))
        odds, error, bend = np.take(odds, order, axis=1), error[order], bend[order]

        def whole(x: np.ndarray) -> np.ndarray:
            out = np.zeros(GATES)
            x *= np.float32(_GRAIN)
            out[here] = np.add.reduceat(np.rint(x, out=x), edges[here], dtype=np.float64) if len(here) else 0
            return out

        parts = [whole(error * x) for x in odds] + [whole(bend * odds[i] * odds[j]) for i, j in _PAIRS]
        return np.concatenate([*parts, np.bincount(cell * 2 + bit, minlength=GATES * STEPS * 2)]).astype(np.int64)

    def step(self, sums: np.ndarray) -> None:
        """Newton's step of the weights, and the refining counts, from the sums of surveyed() over all texts."""
        first = GATES * (PREDICTORS + len(_PAIRS))
        slopes, bends = np.split(sums[:first] / _GRAIN, [GATES * PREDICTORS])
        bend = np.zeros((GATES, PREDICTORS, PREDICTORS))
        for (i, j), x in zip(_PAIRS, bends.reshape(-1, GATES), strict=True):
            bend[:, i, j] = bend[:, j, i] = x
        move = np.linalg.solve(bend + _HOLD * np.eye(PREDICTORS), slopes.reshape(PREDICTORS, GATES).T[..., None])[..., 0]
        self.weights = (self.weights + np.clip(move, -0.5, 0.5)).astype(np.float32)
        both = sums[first:].reshape(GATES, STEPS, 2).astype(np.float64)
        self.seen = np.stack([both.sum(axis=2), both[..., 1]], axis=-1)

    def settle(self) -> Mixer:
        """Ready to score: refined log10 probabilities become a table."""
        prior = 1 / (1 + np.exp(-(np.arange(STEPS) * 24 / (STEPS - 1) - 12)))
        better = (self.seen[..., 1] + 50 * prior) / (self.seen[..., 0] + 50)
        step = np.rint((_ODDS + 12) * ((STEPS - 1) / 24)).astype(np.int64)
        p = np.clip((_LOGISTIC.astype(np.float64)[None] + better[:, step]) / 2, 1e-7, 1 - 1e-7)
        self.logs = np.log10(np.stack([1 - p, p], axis=-1)).astype(np.float32).reshape(-1)
        return self

    def costs(self, odds: np.ndarray, gate: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """log10 of the probability of every bit."""
        mixed = self.mixed(odds, gate)
        mixed += np.float32(12)
        mixed *= np.float32((FINE - 1) / 24)
        at = np.rint(mixed, out=mixed).astype(np.intp)
        at += gate * FINE
        at *= 2
        at += bit
        return np.take(self.logs, at)


_PACKED = "bucket long, kind int, a binary, b binary, c binary"
_WORDS, _ANCHORS, _ASKED, _TABLE = range(4)
#: Where the tables part in one row of all counts, and its blocks.
_EDGES = np.cumsum([2 << b for b in BITS])[:-1]
_BLOCKS = sum(2 << b for b in BITS) // WIDTH


def _batch(kind: int, rows: list[tuple[int, list[bytes]]]) -> pa.RecordBatch:
    cells = [pa.array([c[i] if i < len(c) else b"" for _, c in rows], pa.binary()) for i in range(3)]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([kind] * len(rows), pa.int32()), *cells], names=["bucket", "kind", "a", "b", "c"])


def _of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(buckets)).astype(np.int64)


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    known, which = np.unique(np.concatenate(keys), return_inverse=True)
    return known, np.bincount(which, weights=np.concatenate(times), minlength=len(known)).astype(np.int64)


def _spans(context: np.ndarray, span: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (context, continuation) pairs as one, in order of context."""
    name = _hash_rows(span)
    order = np.lexsort((name, context))
    context, span, name, times = context[order], span[order], name[order], times[order]
    new = np.ones(len(context), bool)
    new[1:] = (context[1:] != context[:-1]) | (name[1:] != name[:-1])
    first = np.flatnonzero(new)
    return context[first], span[first], np.add.reduceat(times, first) if len(first) else times


def _hash_rows(span: np.ndarray) -> np.ndarray:
    h = np.zeros(len(span), np.uint64)
    for k in range(span.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + span[:, k])
    return h


def gather(batches: Iterator[pa.RecordBatch], buckets: int, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """What one task has of words and of anchors with what follows; beyond `most` distinct ones, those so far are sent on at once."""
    words: tuple[list, list] = ([], [])
    held: list[tuple] = []

    def send_words() -> pa.RecordBatch:
        known, n = _summed(*words)
        return _batch(_WORDS, list(in_buckets(_of(known, buckets), lambda r: known[r].tobytes(), lambda r: shrink(n[r]))))

    def send_anchors() -> pa.RecordBatch:
        context, span, n = _spans(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return _batch(_ANCHORS, list(in_buckets(_of(context, buckets), lambda r: context[r].tobytes(), lambda r: span[r].tobytes(), lambda r: shrink(n[r]))))

    for batch in in_bytes(batches, most=1 << 18):
        t = tokens(batch.column("text"))
        known, n = np.unique(t.hashes, return_counts=True)
        words[0].append(known)
        words[1].append(n)
        if sum(map(len, words[0])) > 2 * most:
            known, n = _summed(*words)
            if len(known) > most:
                yield send_words()
                words = ([], [])
            else:
                words = ([known], [n])
        at, context, doc = anchors(t)
        held.append((context, following(t, at, doc), np.ones(len(at), np.int64)))
        if sum(len(x[0]) for x in held) > most // 4:
            yield send_anchors()
            held = []
    if words[0]:
        yield send_words()
    if held:
        yield send_anchors()


def collect(training: DataFrame, buckets: int) -> DataFrame:
    """Packed by bucket, over all training texts: words and their counts; anchors seen twice or more, what most often follows
    them, and how often they were seen."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, rows in by_bucket(batches):
            mine = [r for r in rows if r[0] == _WORDS]
            if mine:
                known, n = _summed([np.frombuffer(r[1], np.uint64) for r in mine], [grow(r[2]) for r in mine])
                yield _batch(_WORDS, [(b, [known.tobytes(), shrink(n)])])
            mine = [r for r in rows if r[0] == _ANCHORS]
            if mine:
                context = np.concatenate([np.frombuffer(r[1], np.uint64) for r in mine])
                span = np.frombuffer(b"".join(r[2] for r in mine), np.uint32).reshape(-1, SPAN)
                context, span, n = _spans(context, span, np.concatenate([grow(r[3]) for r in mine]))
                order = np.lexsort((-n, context))  # ties stay in the order of the continuation's hash
                context, span, n = context[order], span[order], n[order]
                first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
                seen = np.add.reduceat(n, first) if len(first) else n
                first, seen, every = first[seen > 1], seen[seen > 1], int(n.sum())
                yield _batch(_ANCHORS, [(b, [context[first].tobytes(), span[first].tobytes(), shrink(np.append(seen, every))])])

    return dealt(training.select("text").mapInArrow(lambda batches: gather(batches, buckets), _PACKED), buckets).mapInArrow(total, _PACKED)


def _planes(counts: np.ndarray) -> bytes:
    """Whole numbers as their low bytes, then the next ones, while there are any."""
    most = int(counts.max()) if len(counts) else 0
    return b"".join(((counts >> np.array(8 * k, counts.dtype)) & np.array(255, counts.dtype)).astype(np.uint8).tobytes() for k in range(max(1, (most.bit_length() + 7) // 8)))


def _unplaned(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(-1, n)
    return sum(p.astype(np.int64) << (8 * k) for k, p in enumerate(planes))


def packed(counts: list[np.ndarray]) -> list[bytes]:
    """Each table's counts by (slot, bit) as blocks that travel."""
    return [_planes(x.astype(np.int64)) for c in counts for x in c.reshape(-1, WIDTH)]


def unpacked(blocks: list[bytes]) -> list[np.ndarray]:
    """What packed() made blocks of, in memory of its own: an array that comes pickled lies in pages so small that reading it at random takes
    several times as long."""
    flat = np.empty(len(blocks) * WIDTH, np.float32)
    for k, block in enumerate(blocks):
        flat[k * WIDTH : (k + 1) * WIDTH] = _unplaned(block, WIDTH)
    return [x.reshape(-1, 2) for x in np.split(flat, _EDGES)]


def context_counts(sent: DataFrame, tasks: int) -> list[np.ndarray]:
    """Each table's counts by (slot, bit): blocks of TOGETHER tasks at a time are summed as they arrive, then those sums."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, np.zeros(0, np.int64)
        for batch in batches:
            for k, a in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([_planes(sums)], pa.binary())], names=["bucket", "a"])
                    at, sums = k, np.zeros(WIDTH, np.int64)
                sums += _unplaned(a, WIDTH)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([_planes(sums)], pa.binary())], names=["bucket", "a"])

    parts = sent.select("bucket", "a")
    n = _BLOCKS
    if tasks > TOGETHER:
        parts = dealt(parts, -(-tasks // TOGETHER) * n).mapInArrow(add, "bucket long, a binary")
    parts = dealt(parts.withColumn("bucket", F.col("bucket") % n), n).mapInArrow(add, "bucket long, a binary")
    blocks = [_planes(np.zeros(WIDTH, np.int64))] * n
    for row in parts.collect():  # so many slots, whatever the corpus: one row a block
        blocks[row.bucket] = row.a
    return unpacked(blocks)


def op10(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The query's digest: learn where crc32(doc_id) mod 5 is not 1, score every row."""
    spark = docs.sparkSession
    context = spark.sparkContext
    held = F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), F.xxhash64("doc_id", "text").alias("key"), (~held & F.col("doc_id").isNotNull()).alias("learn"), "text")
    buckets = bucket_count(spark, docs.select(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0, 16 << 20)
    corpus = settle(collect(rows.where("learn"), buckets), "lm-corpus")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, c in zip(batch.column("kind").to_pylist(), zip(batch.column("b").to_pylist(), batch.column("c").to_pylist(), strict=True), strict=True):
                n = grow(c[0]) if kind == _WORDS else grow(c[1])[-1:]
                yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "n": pa.array([int(n.sum())], pa.int64()), "v": pa.array([len(n)], pa.int64())})

    sums = {r.kind: (int(r.n), int(r.v)) for r in corpus.select("kind", "b", "c").mapInArrow(read, "kind int, n long, v long").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()}
    n_all, n_kinds = sums.get(_WORDS, (0, 0))
    floor, hot_floor = max(n_all / (1 << 20), 2), max(sums.get(_ANCHORS, (0, 0))[0] / (1 << 16), 2)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, a, b, c in zip(*(batch.column(k).to_pylist() for k in ("kind", "a", "b", "c")), strict=True):
                h, n = np.frombuffer(a, np.uint64), grow(b) if kind == _WORDS else grow(c)[:-1]
                pick = np.flatnonzero(n >= (floor if kind == _WORDS else hot_floor))
                more = n[pick].tobytes() if kind == _WORDS else np.frombuffer(b, np.uint32).reshape(-1, SPAN)[pick].tobytes()
                yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "a": pa.array([h[pick].tobytes()], pa.binary()), "b": pa.array([more], pa.binary())})

    top = corpus.select("kind", "a", "b", "c").mapInArrow(frequent, "kind int, a binary, b binary").collect()  # at most 2 ** 20 words and 2 ** 16 anchors
    joined = lambda kind, name, of: np.frombuffer(b"".join(r[name] for r in top if r.kind == kind), of)
    word_counts = joined(_WORDS, "b", np.int64)
    words = Words.of(joined(_WORDS, "a", np.uint64), word_counts, n_all - int(word_counts.sum()), floor)
    hot, hot_span = joined(_ANCHORS, "a", np.uint64), joined(_ANCHORS, "b", np.uint32).reshape(-1, SPAN)
    order = np.argsort(hot)
    common = context.broadcast((words, hot[order], hot_span[order]))
    sweep(spark)

    def hot_of(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = common.value[1]
        if not len(known):
            return np.zeros(len(found), np.int64), np.zeros(len(found), bool)
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        return at, known[at] == found

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors of all texts that ask what follows, and the task's counts of contexts over its training texts."""
        counts, learned = np.zeros(_BLOCKS * WIDTH, np.uint32), False
        tables = np.split(counts, _EDGES)
        for batch in in_bytes(batches, most=1 << 17):
            keys = batch.column("key").to_numpy().astype(np.int64)
            t = tokens(batch.column("text"))
            at, found, doc = anchors(t)
            ask = ~hot_of(found)[1]
            at, found, doc = at[ask], found[ask], doc[ask]
            if len(found):
                place = at - t.offsets[doc]
                yield _batch(_ASKED, list(in_buckets(_of(found, buckets), lambda r, f=found: f[r].tobytes(), lambda r, k=keys[doc]: k[r].tobytes(), lambda r, p=place: shrink(p[r]))))
            use = batch.column("learn").to_numpy(zero_copy_only=False).astype(bool)
            if use.any():
                b = bits(some(t, use), common.value[0])
                one = np.ones(len(b.bits), np.uint32)
                for k in range(TABLES):
                    np.add.at(tables[k], b.slots[k] * np.uint32(2) + b.bits, one)
                learned = True
        if learned:
            group = TaskContext.get().partitionId() // TOGETHER * _BLOCKS
            for k in range(0, _BLOCKS, 8):  # a few blocks at a time, so that no large batch travels
                yield _batch(_TABLE, [(group + j, [_planes(counts[j * WIDTH : (j + 1) * WIDTH])]) for j in range(k, k + 8)])

    sending = rows.select("key", "learn", "text").mapInArrow(send, _PACKED)
    sent = settle(sending, "lm-contexts")
    counts = context_counts(sent.where(F.col("kind") == _TABLE), sending.rdd.getNumPartitions())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mine in by_bucket(batches):
            known, span = (b"".join(r[k] for r in mine if r[0] == _ANCHORS) for k in (1, 2))
            known, span = np.frombuffer(known, np.uint64), np.frombuffer(span, np.uint32).reshape(-1, SPAN)
            asked = [r for r in mine if r[0] == _ASKED]
            if not len(known) or not asked:
                continue
            found, keys = (np.frombuffer(b"".join(r[k] for r in asked), t) for k, t in ((1, np.uint64), (2, np.int64)))
            place = np.concatenate([grow(r[3]) for r in asked])
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            hit = np.flatnonzero(known[at] == found)
            if len(hit):
                yield _batch(_ASKED, list(in_buckets(_of(keys[hit].view(np.uint64), buckets), lambda r, h=hit, k=keys: k[h[r]].tobytes(), lambda r, h=hit, p=place: shrink(p[h[r]]), lambda r, h=hit, a=at, s=span: s[a[h[r]]].tobytes())))

    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mine in by_bucket(batches):
            keys, place = np.concatenate([np.frombuffer(r[1], np.int64) for r in mine]), np.concatenate([grow(r[2]) for r in mine])
            span = np.frombuffer(b"".join(r[3] for r in mine), np.uint32).reshape(-1, SPAN)
            order = np.lexsort((place, keys))
            keys, place, span = keys[order], place[order].astype(np.uint32), span[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            ends = np.append(first[1:], len(keys))
            cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(keys[first]), cut(place), cut(span)], names=["key", "places", "spans"])

    both = sent.where(F.col("kind") == _ASKED).unionByName(corpus.where(F.col("kind") == _ANCHORS))
    answers = dealt(dealt(both, buckets).mapInArrow(answer, _PACKED), buckets).mapInArrow(regroup, "key long, places binary, spans binary")
    answers = settle(answers, "lm-matches")
    discard(sent)
    del both
    sweep(spark)
    asked = shared(rows.join(answers, "key", "left"))  # texts travel here, once for all that read them

    def read_bits(batch: pa.RecordBatch) -> tuple[Tokens, Bits]:
        t = tokens(batch.column("text"))
        at, found, _ = anchors(t)
        where, there = hot_of(found)
        places, spans = [at[there]], [common.value[2][where[there]]]
        for i, (p, s) in enumerate(zip(batch.column("places").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
            if p:
                places.append(np.frombuffer(p, np.uint32).astype(np.int64) + t.offsets[i])
                spans.append(np.frombuffer(s, np.uint32).reshape(-1, SPAN))
        return t, bits(t, common.value[0], guesses(t, np.concatenate(places), np.concatenate(spans)))

    name = F.xxhash64("doc_id", F.lit(10))
    bound = rows.where("learn").select(name.alias("h")).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = [] if bound is None else asked.where("learn").where(name <= bound).dropDuplicates(["key"]).orderBy(name, "key").select("text", "places", "spans").collect()
    texts = [pa.RecordBatch.from_pydict({"text": pa.array([r.text], pa.string()), "places": pa.array([r.places and bytes(r.places)], pa.binary()), "spans": pa.array([r.spans and bytes(r.spans)], pa.binary())}) for r in chosen]
    own = [read_bits(x)[1] for x in texts]
    without = [c.copy() for c in counts]
    for b in own:
        for k in range(TABLES):
            np.subtract.at(without[k].reshape(-1), b.slots[k].astype(np.int64) * 2 + b.bits, np.float32(1))
    learner = Mixer.of([np.maximum(c, 0) for c in without])
    del without
    for b in own:
        learner.learn(*learner.inputs(b), b.bits)
    start, all_counts = learner.weights, context.broadcast(packed(counts))

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, tables = None, None
        for batch in in_bytes(batches, most=1 << 17):
            tables = unpacked(all_counts.value) if tables is None else tables
            b = read_bits(batch)[1]
            alone = Mixer.of(without_own(tables, b))
            alone.weights = start
            part = alone.surveyed(*alone.inputs(b._replace(slots=[slice(None)] * TABLES)), b.bits)  # a row of counts a bit
            sums = part if sums is None else sums + part
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [sum(np.frombuffer(x, np.int64) for x in batch.column("sums").to_pylist()) for batch in batches if batch.num_rows]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([sum(parts).tobytes()], pa.binary())], names=["sums"])

    learning = asked.where("learn").select("text", "places", "spans").mapInArrow(survey, "sums binary").repartition(min(TOGETHER, -(-asked.rdd.getNumPartitions() // TOGETHER) or 1)).mapInArrow(together, "sums binary")
    mixer = Mixer.of(counts)
    del counts
    mixer.weights = start
    parts = [np.frombuffer(r.sums, np.int64) for r in learning.collect()]  # at most TOGETHER rows of fixed size
    if parts:
        mixer.step(sum(parts))
    all_counts.destroy()
    mixing = context.broadcast(mixer.settle())
    log_of = lambda c: np.log10((c + 0.5) / (n_all + 0.5 * (n_kinds + 1)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, words = mixing.value, common.value[0]
        for batch in in_bytes(batches, most=1 << 17):
            t, b = read_bits(batch)
            logs = mixer.costs(*mixer.inputs(b), b.bits)
            n = batch.num_rows
            total = np.bincount(b.docs, weights=np.add.reduceat(logs, b.first, dtype=np.float64), minlength=n)
            at, hit = b.at, b.known
            value = np.where(hit, log_of(words.counts[at]) if len(words.counts) else 0.0, 0.0)
            last = t.offsets[1:] - 1  # the end mark is asked for here: a count of none is a count
            value[last] = np.where(hit[last], value[last], log_of(0))
            rest = ~hit
            rest[last] = False
            doc = np.repeat(np.arange(n), np.diff(t.offsets))
            edges = np.concatenate([[0], np.cumsum(np.bincount(doc[rest], minlength=n))])
            open_ = t.hashes[rest]
            asks = [open_[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            size = sum_by(t.ends - t.starts + 1, t.words) + 1
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(t.offsets)), pa.array(sum_by(hit.astype(np.int64), t.offsets)), pa.array(sum_by(value, t.offsets)),
                pa.array(np.round(total, 6)), pa.array(-total * math.log2(10) / size), pa.array(asks, pa.binary()),
            ], names=["doc_id", "held_out", "n_tokens", "known", "logs", "score", "bits_per_byte", "asked"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = asked.select("doc_id", "held_out", "text", "places", "spans").mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, known long, logs double, score double, bits_per_byte double, asked binary")
    scored = settle(made.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    discard(answers)
    del asked, learning, made
    sweep(spark)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "asked", most=4 << 20):
            raw, offsets = offsets_of(batch.column("asked"))
            h, row = np.frombuffer(raw.tobytes(), np.uint64), np.repeat(batch.column("row").to_numpy().astype(np.int64), np.diff(offsets) // 8)
            if len(h):
                yield _batch(_ASKED, list(in_buckets(_of(h, buckets), lambda r, h=h: h[r].tobytes(), lambda r, x=row: shrink(x[r]))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mine in by_bucket(batches):
            pairs, asks = [r for r in mine if r[0] == _WORDS], [r for r in mine if r[0] == _ASKED]
            if not asks:
                continue
            known, times = np.frombuffer(b"".join(r[1] for r in pairs), np.uint64), np.concatenate([np.zeros(0, np.int64), *(grow(r[2]) for r in pairs)])
            h, row = np.frombuffer(b"".join(r[1] for r in asks), np.uint64), np.concatenate([grow(r[2]) for r in asks])
            at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
            c = np.where(known[at] == h, times[at], 0) if len(known) else np.zeros(len(h), np.int64)
            order = np.lexsort((c, row))
            row, c = row[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (c[1:] != c[:-1])]))
            one, seen, many = row[first], c[first], np.diff(np.append(first, len(row)))
            yield _batch(_ASKED, list(in_buckets(_of(one.view(np.uint64), buckets), lambda r: shrink(one[r]), lambda r: shrink(seen[r]), lambda r: shrink(many[r]))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mine in by_bucket(batches):
            row, c, many = (np.concatenate([grow(r[k]) for r in mine]) for k in (1, 2, 3))
            order = np.lexsort((c, row))  # a fixed order, so that sums of parts agree to the last digit
            row, c, many = row[order], c[order], many[order]
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(row[first]), pa.array(np.add.reduceat(log_of(c) * many, first)), pa.array(np.add.reduceat(many * (c > 0), first))], names=["row", "more", "seen"])

    requests = scored.select("row", "asked").mapInArrow(ask, _PACKED).unionByName(corpus.where(F.col("kind") == _WORDS))
    replies = dealt(dealt(requests, buckets).mapInArrow(count, _PACKED), buckets).mapInArrow(add, "row long, more double, seen long")
    out = scored.drop("asked").join(replies, "row", "left")
    base = F.col("logs") + F.coalesce("more", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"), "score", "bits_per_byte")
