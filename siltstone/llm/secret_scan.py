"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The field tags each word of a text as Begin, Inside or Outside of a secret from its shape, its
neighbours and features of the whole text; the best tagging is found by Viterbi. It is trained here, by
maximum likelihood, on a bounded sample of texts: `most` that the patterns mark and `most` others, at most CHAINS chains of
CHAIN words from each, cut from anywhere in texts of any length. Of a marked text it sees the values that the patterns find, as they stand
and again in layouts that no pattern matches (other keywords, other marks, none at all); of the others, the words most like a
value, all Outside, but for those that may be secrets; in both, invented secrets set in at any place. So it learns values and neighbours, not the patterns' verdict.

Viterbi is exact and cheap: a word is settled as Outside when no neighbours could make Begin or Inside
pay (swapping it to Outside improves every path); only the runs between such words are decoded, each
with Outside on both sides.

Positions are code points, ends exclusive. Defined cases: null text counts as empty; an empty text has no
span; with no pattern match in the sample the field is untrained and adds nothing; repeated rows are
each answered; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltstone.llm._base import LOWER, in_bytes, offsets_of, settle, span_hashes, sum_by, word_spans

#: Kinds in their order, patterns and least lengths of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "crf")
#: Words that announce a secret, for the field's neighbour features.
ANNOUNCE = ("password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "key", "credential", "credentials", "auth", "bearer", "authorization", "access_key", "secret_key", "private_key")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of every match of the patterns, in order."""
    out: list[Span] = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


_CLASS = {name: np.isin(np.arange(256), np.frombuffer(chars.encode(), np.uint8)) for name, chars in {"digit": "0123456789", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": "abcdefghijklmnopqrstuvwxyz", "hexes": "0123456789abcdef", "join": "=:", "extra": "+/_-=", "quote": "\"'`", "at": "@"}.items()}
_CLASS["wide"] = np.arange(256) >= 128
FEATURES = 27
#: Words of a training chain, and most chains of one text.
CHAIN, CHAINS = 12, 4
#: Layouts of a value that no pattern matches; the value stands for {}.
LAYOUTS = ("pwd {}", "passphrase is {}", "credentials -> {}", "Authorization Bearer {}", "key {}", "auth={}", "login with {} today", "({})", "\"{}\"", "{},")


def _announcers() -> np.ndarray:
    joined = "".join(ANNOUNCE).encode()
    ends = np.cumsum([len(w) for w in ANNOUNCE])
    return np.unique(span_hashes(np.frombuffer(joined, np.uint8), ends - [len(w) for w in ANNOUNCE], ends))


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, each text's offsets into them, and a row of features for each word."""
    starts, ends, words = word_spans(raw, offsets)
    n = len(starts)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(words))
    length = ends - starts
    has = {k: _span_sum(v[raw], starts, ends) for k, v in _CLASS.items()}
    letters = has["upper"] + has["lower"]
    plain = letters + has["digit"]
    kind = np.zeros(len(raw), np.int8)
    kind[_CLASS["digit"][raw]] = 1
    kind[_CLASS["upper"][raw] | _CLASS["lower"][raw]] = 2
    turns = np.zeros(len(raw), bool)
    turns[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    mixes = _span_sum(turns, np.minimum(starts + 1, ends), ends)
    mixed = (has["digit"] > 0) & (letters > 0)
    tail = raw[ends - 1] if n else np.zeros(0, np.uint8)
    bare = np.where(_CLASS["join"][tail] | _CLASS["quote"][tail], ends - 1, ends)
    head = np.where(_CLASS["quote"][raw[starts]], starts + 1, starts) if n else starts
    cue = np.isin(span_hashes(LOWER[raw], head, np.maximum(bare, head)), _announcers())
    joins, ends_join = has["join"] > 0, _CLASS["join"][tail]
    inner = joins & ~ends_join & (length >= 8)
    dense = sum_by(has["digit"], words) / np.maximum(sum_by(length, words), 1)
    coded = sum_by(joins.astype(np.int64), words) / np.maximum(np.diff(words), 1)

    def shift(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n, x.dtype)
        if 0 < abs(by) < n:
            same = doc[abs(by) :] == doc[: -abs(by)]
            if by > 0:
                out[by:] = np.where(same, x[:-by], 0)
            else:
                out[:by] = np.where(same, x[-by:], 0)
        return out

    rich = mixed & (length >= 12) & (mixes >= 2)
    columns = [
        np.ones(n, bool), length <= 4, (length > 4) & (length < 8), (length >= 8) & (length < 16), (length >= 16) & (length < 32), length >= 32,
        mixed, mixed & (mixes >= 3), rich, mixed & (has["digit"] * 5 > length), (has["hexes"] >= 16) & (has["hexes"] + 12 >= plain) & mixed,
        (has["upper"] >= 8) & (has["digit"] >= 1) & (has["lower"] == 0) & (length >= 16), has["wide"] > 0, letters == length, has["digit"] == length,
        inner, inner & mixed, has["quote"] > 0, cue, shift(cue, 1), shift(cue & ends_join, 1) & (length >= 8), shift(cue, 2) & shift(ends_join, 1), shift(cue, 2) & shift(ends_join, 1) & mixed,
        shift(ends_join, -1) & cue, shift(rich, 1), np.repeat((dense > 0.05) | (coded > 0.05), np.diff(words)), has["at"] > 0,
    ]
    return starts, ends, words, np.column_stack(columns).astype(np.float32) if n else np.zeros((0, FEATURES), np.float32)


def _span_sum(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=sums[1:], dtype=np.int32)
    return sums[ends] - sums[starts]


@dataclass(frozen=True)
class Field:
    """Emission weights (features by states O, B, I) and transition scores (from, to)."""

    weights: np.ndarray
    moves: np.ndarray

    def slack(self) -> np.ndarray:
        """Of B and I, the most that a neighbourhood can gain over Outside."""
        t = self.moves
        via = t[:, 1:, None] + t[None, 1:, :].transpose(0, 1, 2)
        return (via - (t[:, :1, None] + t[None, :1, :])).max(axis=(0, 2))

    def tag(self, x: np.ndarray, words: np.ndarray) -> np.ndarray:
        """State of each word: exact Viterbi over each text's chain, from and to Outside."""
        scores = x @ self.weights.astype(np.float32)
        scores = scores.astype(np.float64)
        alive = ((scores[:, 1:] - scores[:, :1] + self.slack()) >= 0).any(axis=1)
        states = np.zeros(len(x), np.int8)
        if not alive.any():
            return states
        first = alive.copy()
        first[1:] &= ~alive[:-1]
        heads = words[:-1][words[:-1] < words[1:]]
        first[heads] = alive[heads]
        begin = np.flatnonzero(first)
        at = np.flatnonzero(alive)
        size = np.diff(np.append(np.searchsorted(at, begin), len(at)))
        for longest in sorted({1 << int(k).bit_length() for k in size}):
            pick = (size < longest) & (size >= longest // 2)
            self._decode(scores, begin[pick], size[pick], states)
        return states

    def _decode(self, scores: np.ndarray, begin: np.ndarray, size: np.ndarray, states: np.ndarray) -> None:
        most, n = int(size.max()), len(begin)
        rows = np.minimum(begin[:, None] + np.arange(most), len(scores) - 1)
        e = scores[rows]
        best = np.tile(np.array([0.0, -1e30, -1e30]), (n, 1))
        back = np.zeros((most, n, 3), np.int8)
        final = np.zeros((n, 3))
        for t in range(most):
            through = best[:, :, None] + self.moves[None]
            back[t] = through.argmax(axis=1)
            best = through.max(axis=1) + e[:, t]
            ended = size == t + 1
            final[ended] = best[ended]
        state = (final + self.moves[:, 0]).argmax(axis=1)
        for t in range(most - 1, -1, -1):
            live = t < size
            states[rows[live, t]] = state[live]
            state = np.where(live, back[t, np.arange(n), state], state)


def _chains(text: str, secret: list[tuple[int, int]] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and states of chains of a text: around the spans `secret`, or, if None, around the words most like a value."""
    raw, offsets = offsets_of(pa.array([text], pa.string()))
    starts, ends, _, x = features(raw, offsets)
    y = np.zeros(len(x), np.int64)
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    begin, stop = lead[starts], lead[ends]
    for a, b in secret or ():
        hit = np.flatnonzero((begin < b) & (stop > a))
        y[hit] = np.where(np.arange(len(hit)) == 0, 1, 2)
    unknown = (x[:, 8] > 0) & (x[:, 26] == 0) & (y == 0)  # rich words that no pattern finds may be secrets: they teach nothing
    likely = x[:, 6] + x[:, 8] + x[:, 10] + x[:, 11] + x[:, 15] + x[:, 16] + x[:, 18] + x[:, 5]
    middles = np.flatnonzero(y == 1)[:CHAINS] if secret is not None else np.argsort(-likely * ~unknown, kind="stable")[: CHAINS - 1]
    for i in dict.fromkeys([*(max(0, int(i) - CHAIN // 2) for i in middles), len(x) // 2 // CHAIN * CHAIN]):
        part = slice(i, i + CHAIN)
        if secret is None and unknown[part].any():
            continue
        short = CHAIN - len(x[part])
        yield np.pad(x[part], ((0, short), (0, 0))), np.pad(y[part], (0, short))


def values(text: str) -> list[tuple[int, int]]:
    """Where the values of the patterns' matches are: what is assigned, or the whole match."""
    found = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    return sorted({*found, *((s, e) for s, k, e in base_spans(text) if k)})


def invented(seed: int) -> str:
    """A made-up secret: letters and digits, or hex too short for the patterns, some with a prefix."""
    rng = random.Random(seed)
    kind = rng.choice(("mixed", "mixed", "lower", "hex"))
    chars = {"mixed": string.ascii_letters + string.digits, "lower": string.ascii_lowercase + string.digits, "hex": "0123456789abcdef"}[kind]
    size = rng.randint(12, 31) if kind == "hex" else rng.randint(12, 44)
    return rng.choice(("", "", "", "sk_", "ghp_", "key-")) + "".join(rng.choice(chars) for _ in range(size))


def examples(text: str, at: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training chains of a text; `at`, any number, picks the layouts and places in which its values and an invented one are shown."""
    found = values(text)
    out = list(_chains(text, found or None))

    def show(before: str, value: str, after: str, layout: str) -> None:
        place = len(before) + layout.index("{}")
        out.append(next(_chains(before + layout.replace("{}", value) + after, [(place, place + len(value))])))

    for k, (s, e) in enumerate(found[:CHAINS]):
        whole = next(((a, b) for a, _, b in base_spans(text) if a <= s and e <= b), (s, e))
        show(text[: whole[0]], text[s:e], text[whole[1] :], LAYOUTS[(at + k) % len(LAYOUTS)])
    rng = random.Random(at)
    spaces = [m.start() for m in re.finditer(" ", text)]
    for k in range(2):
        i = rng.choice(spaces) if spaces else len(text)
        show(text[:i] + " ", invented(at * 2 + k), text[i:], rng.choice(LAYOUTS))
    return out


def train(sample: list[str], rounds: int = 120) -> Field | None:
    """The field of a list of texts, for use without a cluster."""
    made = [c for k, text in enumerate(sample) for c in examples(text, k)]
    return fit([x for x, _ in made], [y for _, y in made], rounds)


def fit(xs: list[np.ndarray], ys: list[np.ndarray], rounds: int = 120) -> Field | None:
    """Maximum likelihood with an L2 prior by full-batch Adam; None if no chain has a secret."""
    if not xs or not any((y == 1).any() for y in ys):
        return None
    x, y = np.array(xs, np.float64), np.array(ys)
    n, length, d = x.shape
    weights, moves = np.zeros((d, 3)), np.zeros((3, 3))
    hot = np.eye(3)[y]
    steps = np.stack([hot[:, :-1, :, None] * hot[:, 1:, None, :]], 0)[0].sum(axis=(0, 1))
    memory = [np.zeros_like(p) for p in (weights, weights, moves, moves)]
    for r in range(1, rounds + 1):
        e = x @ weights
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0] + moves[0]
        for t in range(1, length):
            forward[:, t] = _logsum(forward[:, t - 1, :, None] + moves, 1) + e[:, t]
        for t in range(length - 2, -1, -1):
            backward[:, t] = _logsum((backward[:, t + 1] + e[:, t + 1])[:, None, :] + moves, 2)
        z = _logsum(forward[:, -1], 1)
        p = np.exp(forward + backward - z[:, None, None])
        pairs = np.exp(forward[:, :-1, :, None] + moves + (e + backward)[:, 1:, None, :] - z[:, None, None, None]).sum(axis=(0, 1))
        for k, (value, slope) in enumerate(((weights, np.einsum("ntd,nts->ds", x, p - hot) / n + 1e-3 * weights), (moves, (pairs - steps) / n + 1e-3 * moves))):
            m, v = memory[2 * k], memory[2 * k + 1]
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            value -= 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return Field(np.round(weights, 6), np.round(moves, 6))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def find(texts: pa.Array, field: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """For each text, the patterns' spans and all spans, as (start, kind, end)."""
    raw, offsets = offsets_of(texts)
    starts, ends, words, x = features(raw, offsets)
    states = field.tag(x, words) if field is not None else np.zeros(len(starts), np.int8)
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    origin = lead[offsets[:-1]]
    marked = np.flatnonzero(states)
    per_text = np.searchsorted(marked, words)
    out = []
    for i, text in enumerate(texts.to_pylist()):
        base = base_spans(text) if text else []
        more: list[list[int]] = []
        for w in marked[per_text[i] : per_text[i + 1]]:
            a, b = int(lead[starts[w]] - origin[i]), int(lead[ends[w]] - origin[i])
            if more and states[w] == 2 and more[-1][2] == w - 1:
                more[-1][1:] = [b, w]
            else:
                more.append([a, b, w])
        extra = [(a, 3, b) for a, b, _ in more if not any(a < e and s < b for s, _, e in base)]
        out.append((base, sorted(base + extra)))
    return out


def learned(docs: DataFrame, most: int = 1000) -> Field | None:
    """The field of `docs`: of the distinct texts, the `most` of least hash that the patterns mark and as many others, the documented
    bound of what it is fitted on. One scan ranks hashes, one fetches; tasks send chains, not texts."""
    marked = F.col("text").rlike(r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{8}|AKIA[A-Z0-9]{12}|[0-9a-f]{32}")
    ranked = settle(docs.where("length(text) > 0").select(F.xxhash64("text").alias("h"), marked.alias("marked")), "secret-ranks")
    chosen = [r.h for flag in (True, False) for r in ranked.where(F.col("marked") == flag).select("h").distinct().orderBy("h").limit(most).collect()]
    if not chosen:
        return None
    wanted = F.broadcast(docs.sparkSession.createDataFrame([(h,) for h in chosen], "h long"))  # at most 2 * most rows
    texts = docs.select("text", F.xxhash64("text").alias("h")).join(wanted, "h", "left_semi").dropDuplicates(["h"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches):
            for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist(), strict=True):
                made = examples(text, h % (1 << 32))
                x, y = np.array([x for x, _ in made], np.float32), np.array([y for _, y in made], np.int8)
                yield pa.RecordBatch.from_pydict({"h": pa.array([h], pa.int64()), "x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

    rows = sorted(texts.mapInArrow(cut, "h long, x binary, y binary").collect())
    xs = [x for r in rows for x in np.frombuffer(r.x, np.float32).reshape(-1, CHAIN, FEATURES)]
    return fit(xs, [y for r in rows for y in np.frombuffer(r.y, np.int8).reshape(-1, CHAIN).astype(np.int64)])


def scan(docs: DataFrame, field: Field | None, keep: list[str]) -> DataFrame:
    """`keep` columns of every row, base and spans as arrays of (start, kind, end), and redacted text."""
    shape = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches):
            found = find(batch.column("text"), field)
            lists = [pa.array([[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in spans] for spans in side], shape) for side in zip(*found, strict=True)]
            clean = pa.array([redact(t, spans) for t, (_, spans) in zip(batch.column("text").to_pylist(), found, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *lists, clean], names=[*keep, "base", "spans", "redacted"])

    frame = docs.select(*dict.fromkeys([*keep, "text"]))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema if f.name in keep)
    span = "array<struct<start: bigint, kind: string, end: bigint>>"
    return frame.mapInArrow(run, f"{kinds}base {span}, spans {span}, redacted string")


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans go together."""
    if not spans or text is None:
        return text
    out, at = [], 0
    for s, k, e in spans:
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], f"<{KINDS[k]}>"]
        at = e
    return "".join([*out, text[at:]])


def op5(docs: DataFrame, most: int = 1000) -> DataFrame:
    """The query's digest: counts of each pattern, the digest of their spans, and all spans."""
    field = learned(docs, most)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches):
            found = find(batch.column("text"), field)
            write = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
            counts = [pa.array([sum(k == kind for _, k, _ in base) for base, _ in found], pa.int64()) for kind in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array([hashlib.sha256(write(b).encode()).hexdigest() for b, _ in found]), pa.array([write(s) for _, s in found])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    frame = docs.select("doc_id", "text")
    return frame.mapInArrow(digest, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
