"""N-gram Jaccard join: documents whose sets of 5-word shingles have a Jaccard similarity of 0.75 or more.

Universe partition and pigeonhole. Sizes fall into bands, each 4/3 of the last, so a partner is in the
same band or a neighbouring one. A band's scheme hashes shingles into m segments. Two sets of similarity
0.75 differ in at most H = (|r| + |s|) / 7 shingles, so among any H + 1 segments one is identical: of a
document with H + 1 segments that no other document has, no partner exists, and it is settled. This
allocation by cost (segments nobody shares are free) settles all but copies and near-copies. A document
with fewer than H + 1 segments in use also indexes the one-deletion neighbourhood of every segment and
meets others of its kind there; if even twice its segments are too few, each of its shingles is indexed.

The rest are grouped by equal sets; one of each group stays. Families (connected by shared segments) are
searched exactly, breadth first against what is not yet reached, so a family's links are never listed as
pairs. A family beyond BLOCK documents is searched as pairs of blocks, and its edges are joined after.

Signatures travel packed, one binary row a slice and bucket; no group is gathered but a family's block.

Defined cases: null, empty and blank texts have no shingles and link with nothing; fewer than five words
are one shingle; equal sets are linked, also of repeated rows; a null doc_id has a null component and
links with nothing; rows of one doc_id are one node and share its component; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from siltstone.llm._base import LOWER, among, bucket_count, by_bucket, dealt, discard, forest, grow, in_buckets, in_bytes, mix, offsets_of, ragged, run_hashes, settle, shrink, shuffled, span_hashes, word_spans, words_of

SHINGLE = 5
#: Bytes of sets in a block of a family that one task compares at once.
BLOCK = 4 << 20
#: Shingles whose signatures make a bucket.
BUCKET = 4_000_000
#: Groups of equal sets with more than this part of all rows are known to all tasks.
COPIES = 1 << 16
_SALT = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, one text after the other, and n + 1 offsets."""
    raw, offsets = offsets_of(texts)
    low = LOWER[raw]
    starts, ends, words = word_spans(low, offsets)
    hashes = span_hashes(low, starts, ends)
    count = np.diff(words)
    size = np.where(count >= SHINGLE, count - SHINGLE + 1, (count > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), size)
    full = run_hashes(hashes, SHINGLE)
    out = np.zeros(len(doc), np.uint64)
    long = count >= SHINGLE
    long_rows = np.repeat(long, size)
    out[long_rows] = full[ragged(words[:-1][long], size[long])]
    for i in np.flatnonzero((count > 0) & ~long):
        out[np.searchsorted(doc, i)] = run_hashes(hashes[words[i] : words[i + 1]], int(count[i]), seed=int(count[i]))[0]
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[keep], np.searchsorted(doc[keep], np.arange(len(texts) + 1))


_EDGES = [1]
while _EDGES[-1] < 1 << 40:
    _EDGES.append(max(_EDGES[-1] + 1, -(-4 * _EDGES[-1] // 3)))
EDGES = np.array(_EDGES)


def _schemes(sets: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For both schemes of sets of n shingles: each set's scheme, whether it is used, the most shingles by which a partner
    differs and the number of segments; each shingle's set, hash and segment."""
    band = np.searchsorted(EDGES, n, "right") - 1
    for below in (0, 1):
        scheme = band - below
        used = (n > 0) & (scheme >= 0)
        top = EDGES[np.maximum(scheme, 0) + 1]
        partner = np.minimum(top - 1, n) if below else 4 * n // 3
        differ = (n + partner) // 7
        segments = np.where(top > 4, (2 * top + 4) // 5 + 1, 1)
        doc = np.repeat(np.arange(len(n)), np.where(used, n, 0))
        x = sets[np.repeat(used, n)]
        yield scheme, used, differ, segments, doc, x, (mix(x) % segments[doc].astype(np.uint64)).astype(np.int64)


def signatures(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of all sets, the set and the scheme of each (0: own band, 1: the one below; 2 more
    for what only sets with too few segments in use have), and for each set and
    scheme the most shingles, H, by which a partner differs."""
    n = np.diff(offsets)
    sigs, owners, belows, differs = [], [], [], []
    for below, (scheme, used, differ, segments, doc, x, at) in enumerate(_schemes(sets, n)):
        order = np.lexsort((at, doc))
        doc, at, x = doc[order], at[order], mix(x[order] ^ _SALT)
        first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])])) if len(doc) else np.zeros(0, np.int64)
        total = np.add.reduceat(x, first) if len(first) else np.zeros(0, np.uint64)
        place = mix((scheme[doc[first]].astype(np.uint64) << np.uint64(40)) + at[first].astype(np.uint64) + np.uint64(1))
        sigs.append(mix(total + place))
        owners.append(doc[first])
        filled = np.bincount(doc[first], minlength=len(n))
        short = used & (filled <= differ)
        belows.append(np.full(len(first), below))
        differs.append(np.where(used, differ, -1))
        for i in np.flatnonzero(short):
            a, b = np.searchsorted(doc, [i, i + 1])
            seg, inv = np.arange(segments[i]), np.searchsorted(first, np.arange(a, b), "right") - 1
            whole = np.zeros(segments[i], np.uint64)
            mine = first[(first >= a) & (first < b)]
            whole[at[mine]] = total[np.searchsorted(first, mine)]
            name = mix((np.uint64(int(scheme[i])) << np.uint64(40)) + seg.astype(np.uint64) + np.uint64(1 << 60))
            more = [mix(whole + name), mix(total[inv] - x[a:b] + name[at[a:b]])]
            if 2 * filled[i] <= differ[i]:
                more.append(mix(x[a:b] + np.uint64(int(scheme[i]) + (1 << 50))))
            sigs.extend(more)
            owners.extend(np.full(len(m), i) for m in more)
            belows.extend(np.full(len(m), below + 2) for m in more)
    return np.concatenate(sigs), np.concatenate(owners), np.concatenate(belows), np.stack(differs, axis=1)


def needs(owner: np.ndarray, below: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """For each set, the least number of shared signatures that leaves a partner: those in use less H, 1 where
    they are too few, and never where it has none."""
    plain = below < 2
    filled = np.bincount(owner[plain] * 2 + below[plain], minlength=2 * len(differ)).reshape(-1, 2)
    left = np.where(differ < 0, 1 << 30, np.maximum(filled - differ, 1))
    return left.min(axis=1)


def least_needs(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """needs() of all sets, without making their signatures."""
    left = []
    for _, used, differ, segments, doc, _, at in _schemes(sets, np.diff(offsets)):
        begin = np.concatenate([[0], np.cumsum(segments)])
        taken = np.zeros(begin[-1] + 1, np.int64)
        taken[begin[doc] + at + 1] = 1
        taken = np.cumsum(taken)
        left.append(np.where(used, np.maximum(taken[begin[1:]] - taken[begin[:-1]] - differ, 1), 1 << 30))
    return np.minimum(*left)


def _prints(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set."""
    out = []
    for salt in (3, 5):
        sums = np.zeros(len(sets) + 1, np.uint64)
        np.cumsum(mix(sets + np.uint64(salt)), out=sums[1:])
        out.append((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def _ids(batch: pa.RecordBatch, name: str = "doc_id") -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_bytes(batches):
        sets, offsets = shingle_sets(batch.column("text"))
        a, b = _prints(sets, offsets)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (np.diff(offsets), a, b, least_needs(sets, offsets)))], names=["doc_id", "n_shingles", "f1", "f2", "need"])


def _rows(bucket: np.ndarray, *columns) -> pa.RecordBatch:
    """One row a bucket, each column's bytes made from the places of the bucket's rows."""
    rows = list(in_buckets(bucket, *columns))
    parts = [pa.array([cells[i] for _, cells in rows], pa.binary()) for i in range(len(columns))]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), *parts], names=["bucket", *(f"c{i}" for i in range(len(columns)))])


_TWO, _THREE = "bucket long, c0 binary, c1 binary", "bucket long, c0 binary, c1 binary, c2 binary"


def _modulo(x: np.ndarray, buckets: int) -> np.ndarray:
    return (x % np.uint64(buckets)).astype(np.int64)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys starts, and its size."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(new)))


def _classes(known: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(known), pa.array([c.tobytes() for c in counts], pa.binary())], names=["key", "classes"])


def _times(known: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(known), pa.array(counts[:, 0], pa.int64())], names=["doc_id", "times"])


def _tally(made: DataFrame, buckets: int, finish: Callable[[np.ndarray, np.ndarray], pa.RecordBatch], kind: str) -> DataFrame:
    """What `finish` makes of the keys of packed rows (keys, small classes) and each key's count of every class."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            key = np.concatenate([grow(k) for k, _ in rows])
            small = np.frombuffer(b"".join(c for _, c in rows), np.uint8).astype(np.int64)
            known, which = np.unique(key, return_inverse=True)
            width = int(small.max()) + 1
            yield finish(known, np.bincount(which * width + small, minlength=len(known) * width).astype("<u4").reshape(-1, width))

    return dealt(made, buckets).mapInArrow(whole, kind)


def shared(rows: DataFrame, buckets: int, sent: Broadcast) -> DataFrame:
    """(doc_id, times): documents with signatures that others have too, and how many. Of the sets in `sent` (two prints
    and the document that stands for them) only that document takes part. Signatures travel as 32 bits beside their bucket:
    two that agree by chance only make a document look shared."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies = sent.value
        for batch in in_bytes(batches, most=2 << 20):
            ids, (sets, offsets) = _ids(batch), shingle_sets(batch.column("text"))
            if len(copies[0]):
                a, b = _prints(sets, offsets)
                at = np.minimum(np.searchsorted(copies[0], a), len(copies[0]) - 1)
                out = (copies[0][at] == a) & (copies[1][at] == b) & (copies[2][at] != ids)
                size = np.where(out, 0, np.diff(offsets))
                sets, offsets = sets[ragged(offsets[:-1], size)], np.concatenate([[0], np.cumsum(size)])
            sig, owner, _, _ = signatures(sets, offsets)
            short, doc = (sig >> np.uint64(32)).astype(np.uint32), ids[owner]
            yield _rows(_modulo(sig, buckets), lambda r, s=short: s[r].tobytes(), lambda r, d=doc: shrink(d[r]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            sig = np.frombuffer(b"".join(s for s, _ in rows), np.uint32)
            doc = np.concatenate([grow(d) for _, d in rows])
            order = np.argsort(sig, kind="stable")
            _, size = _groups(sig[order])
            doc = doc[order][np.repeat(size > 1, size)]
            if len(doc):
                yield _rows(_modulo(mix(doc.view(np.uint64)), buckets), lambda r, d=doc: shrink(d[r]), lambda r: bytes(len(r)))

    packed = rows.where("doc_id is not null").select("doc_id", "text").mapInArrow(pack, _TWO)
    return _tally(dealt(packed, buckets).mapInArrow(count, _TWO), buckets, _times, "doc_id long, times long")


#: Classes of how many families share a signature: at most 1, 2, 4 and so on.
_COSTS = 40
#: Least-hash values of a sketch, those in a band, and how many of them two sets must share to be taken together at once.
_SKETCH, _BAND, _ALIKE = 12, 2, 7


def _set_signatures(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw, offsets = offsets_of(batch.column("items"))
    return signatures(np.frombuffer(raw.tobytes(), np.uint64), offsets // 8)


def sketched(sets: DataFrame, buckets: int) -> DataFrame:
    """(id, component): first families, of sets whose sketches of least hashes agree with that of the first set of a band. At most
    one edge a set and band. What it misses is found by segments, what it takes too much is parted by the search; it only keeps
    the segments of copies from being paired again and again."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "items", most=4 << 20):
            raw, offsets = offsets_of(batch.column("items"))
            items, node = np.frombuffer(raw.tobytes(), np.uint64), _ids(batch, "node")
            least = np.stack([np.minimum.reduceat(mix(items + np.uint64(0x9E37 * (k + 1))), offsets[:-1] // 8) for k in range(_SKETCH)], axis=1)
            keys = np.concatenate([mix(least[:, k] ^ mix(least[:, k + 1] + np.uint64(k))) for k in range(0, _SKETCH, _BAND)])
            who = np.tile(np.arange(len(node)), _SKETCH // _BAND)
            small = (least >> np.uint64(32)).astype(np.uint32)
            yield _rows(_modulo(keys, buckets), lambda r, k=keys: k[r].tobytes(), lambda r, w=who, n=node: shrink(n[w[r]]), lambda r, w=who, s=small: s[w[r]].tobytes())

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            key = np.frombuffer(b"".join(r[0] for r in rows), np.uint64)
            node = np.concatenate([grow(r[1]) for r in rows])
            sketch = np.frombuffer(b"".join(r[2] for r in rows), np.uint32).reshape(-1, _SKETCH)
            order = np.lexsort((node, key))
            key, node, sketch = key[order], node[order], sketch[order]
            first, size = _groups(key)
            lead = np.repeat(first, size)
            alike = ((sketch == sketch[lead]).sum(axis=1) >= _ALIKE) & (node != node[lead])
            ids, root = forest(node[lead][alike], node[alike])
            yield pa.RecordBatch.from_arrays([pa.array(root[ids != root]), pa.array(ids[ids != root])], names=["a", "b"])

    packed = sets.select("node", "items").where("length(items) > 0").mapInArrow(pack, _THREE)
    return components(dealt(packed, buckets).mapInArrow(near, "a long, b long"))


def families(sets: DataFrame, buckets: int) -> DataFrame:
    """(node, family) of all sets: sets of one sketched family, or that share a signature which one of them needs, are
    in one family. A document whose rows have several texts has several sets, each with its own costs and need.

    Allocation by cost: a document needs H + 1 of its segments in each scheme and takes those that the fewest families
    share, so a passage that many documents have joins only documents that consist of such, and segments that only its own
    family has cost nothing. Costs travel as one byte for each segment that another family has."""
    named = sketched(sets, buckets).select(F.col("id").alias("node"), F.col("component").alias("label"))
    sets = settle(sets.select("node", "items").join(shuffled(named), "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled-sets")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "items", most=4 << 20):
            sig, owner, below, _ = _set_signatures(batch)
            sig, owner, below = sig[below < 2], owner[below < 2], below[below < 2]
            node, label = _ids(batch, "node")[owner] * 2 + below, _ids(batch, "label")[owner]
            yield _rows(_modulo(sig, buckets), lambda r, s=sig: s[r].tobytes(), lambda r, n=node: shrink(n[r]), lambda r, x=label: shrink(x[r]))

    def opened(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted signatures, nodes, labels, the starts of groups, and each row's cost."""
        sig = np.frombuffer(b"".join(r[0] for r in rows), np.uint64)
        node, label = (np.concatenate([grow(r[k]) for r in rows]) for k in (1, 2))
        order = np.lexsort((label, sig))
        sig, node, label = sig[order], node[order], label[order]
        first, size = _groups(sig)
        kinds = np.zeros(len(sig), np.int64)
        kinds[_groups(sig, label)[0]] = 1
        many = np.add.reduceat(kinds, first) if len(first) else kinds
        return sig, node, label, first, np.repeat(np.ceil(np.log2(np.maximum(many, 1))).astype(np.int64), size)

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            _, node, _, _, cost = opened(rows)
            node, cost = node[cost > 0], cost[cost > 0].astype(np.uint8)
            if len(node):
                yield _rows(_modulo(mix((node >> 1).view(np.uint64)), buckets), lambda r, n=node: shrink(n[r]), lambda r, c=cost: c[r].tobytes())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "items", most=4 << 20):
            sig, owner, below, differ = _set_signatures(batch)
            filled = np.stack([np.bincount(owner[below == k], minlength=batch.num_rows) for k in (0, 1)], axis=1)
            limit = np.zeros((batch.num_rows, 2), np.int64)
            for k, name in enumerate(("k0", "k1")):
                spent = [np.frombuffer(c or b"", "<u4").astype(np.int64) for c in batch.column(name).to_pylist()]
                hist = np.zeros((batch.num_rows, _COSTS), np.int64)
                for i, c in enumerate(spent):
                    hist[i, : len(c)] = c
                hist[:, 0] = filled[:, k] - hist.sum(axis=1)
                enough = np.cumsum(hist, axis=1) >= differ[:, [k]] + 1
                limit[:, k] = np.where(enough.any(axis=1), enough.argmax(axis=1), _COSTS)
            live = (limit.max(axis=1) > 0)[owner]
            sig, owner, below = sig[live], owner[live], below[live]
            label, want = _ids(batch, "label")[owner], limit[owner, below & 1]
            if len(sig):
                yield _rows(_modulo(sig, buckets), lambda r, s=sig: s[r].tobytes(), lambda r, w=want: shrink(w[r]), lambda r, x=label: shrink(x[r]))

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            _, limit, label, first, cost = opened(rows)
            if not len(first):
                continue
            size = np.diff(np.append(first, len(label)))
            wanted = np.repeat(np.maximum.reduceat(limit, first), size) >= cost
            low = np.repeat(label[first], size)  # sorted, so the least
            ids, root = forest(low[wanted & (low != label)], label[wanted & (low != label)])
            ids, root = ids[ids != root], root[ids != root]
            if len(ids):
                yield _rows(_modulo(mix(ids.view(np.uint64)), buckets), lambda r, x=root: shrink(x[r]), lambda r, x=ids: shrink(x[r]))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            ids, root = forest(*(np.concatenate([grow(r[k]) for r in rows]) for k in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(root[ids != root]), pa.array(ids[ids != root])], names=["a", "b"])

    spent = _tally(dealt(sets.mapInArrow(pack, _THREE), buckets).mapInArrow(costs, _TWO), buckets, _classes, "key long, classes binary")
    spent = spent.groupBy(F.shiftright("key", 1).alias("node")).agg(F.max(F.when(F.col("key") % 2 == 0, F.col("classes"))).alias("k0"), F.max(F.when(F.col("key") % 2 != 0, F.col("classes"))).alias("k1"))
    asked = sets.join(shuffled(spent), "node", "left").select("node", "items", "label", "k0", "k1").mapInArrow(send, _THREE)
    edges = dealt(dealt(asked, buckets).mapInArrow(stars, _TWO), buckets).mapInArrow(joined, "a long, b long")
    more = components(edges).select(F.col("id").alias("label"), "component")
    return settle(sets.select("node", "label").join(shuffled(more), "label", "left").select("node", F.coalesce("component", "label").alias("family")), "families")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of `edges` (a, b): the smallest node that edges lead to. Each round
    takes the least label of all neighbours and of the label itself, so rounds grow with the logarithm
    of a chain's length on most inputs; every round is a written table."""
    links = settle(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = settle(links.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = links.join(shuffled(labels), links.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
        new = labels.join(shuffled(near), "id").join(shuffled(jump), "component").select("id", F.least("near", "far", "component").alias("new"), (F.least("near", "far") < F.col("component")).alias("moved"))
        new = settle(new, "labels")
        moved = new.where("moved").limit(1).count()
        discard(labels)
        labels = new.select("id", F.col("new").alias("component"))
        if not moved:
            return labels


def search(items: list[np.ndarray]) -> np.ndarray:
    """For each set, the set whose search along links reached it (itself for roots)."""
    n = len(items)
    size = np.array([len(x) for x in items])
    flat = np.concatenate(items) if n else np.zeros(0, np.uint64)
    _, token = np.unique(flat, return_inverse=True)
    start = np.concatenate([[0], np.cumsum(size)])
    root, open_ = np.arange(n), np.ones(n, bool)

    def index(alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(n), size)
        keep = alive[rows]
        order = np.argsort(token[keep], kind="stable")
        return rows[keep][order], np.searchsorted(token[keep][order], np.arange(token.max() + 2 if len(token) else 1))

    posting, edge = index(open_)
    indexed = n
    for seed in range(n):
        if not open_[seed]:
            continue
        open_[seed] = False
        queue = [seed]
        while queue:
            i = queue.pop()
            mine = token[start[i] : start[i + 1]]
            near = posting[ragged(edge[mine], edge[mine + 1] - edge[mine])]
            near = near[open_[near]]
            if not len(near):
                continue
            common = np.bincount(near, minlength=n)
            at = np.flatnonzero(common)
            linked = at[100 * common[at] >= 75 * (size[i] + size[at] - common[at])]
            root[linked] = seed
            open_[linked] = False
            queue += linked.tolist()
            left = int(open_.sum())
            if left < indexed // 2:
                posting, edge = index(open_)
                indexed = left
    return root


def met(small: DataFrame, name: str) -> DataFrame:
    """`small`, written once, for a join: known to all tasks if it was counted to have at most COPIES rows, else shuffled."""
    small = settle(small, name)
    return F.broadcast(small) if small.limit(COPIES + 1).count() <= COPIES else shuffled(small)


def linked(sets: DataFrame, grouped: DataFrame) -> DataFrame:
    """Edges (a, b) of documents that connect each family as its links do. A family beyond BLOCK bytes is cut into blocks by
    hash; each is searched together with the first, which joins nearly all of a family of near copies. Only documents
    outside its largest component are then compared with every block, so work grows with the family, not its square."""
    heavy = grouped.join(shuffled(sets.select("node", "doc_id", F.length("items").alias("size"))), "node")
    total = heavy.groupBy("family").agg(F.count("*").alias("n"), F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks")).where("n > 1").drop("n")
    placed = heavy.join(met(total, "large-totals"), "family").select("family", "node", "doc_id", "size", "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
    placed = settle(placed, "placed-sets")
    with_items = lambda rows, of: rows.join(shuffled(among(sets.select("node", "items"), of, "node")), "node")
    first = (F.col("block") == 0) & (F.col("blocks") > 1)
    turns = F.when(first, F.sequence(F.lit(1), F.greatest(F.col("blocks") - 1, F.lit(1)))).otherwise(F.array("block"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "node"], ignore_index=True)
        root = search([np.frombuffer(x, np.uint64) for x in pdf["items"]])
        ids = pdf["doc_id"].to_numpy()
        return pd.DataFrame({"a": ids[root], "b": ids})[root != np.arange(len(ids))]

    rows = with_items(placed.select("family", "node", "doc_id", F.explode(turns).alias("turn")), placed)
    edges = settle(rows.groupBy("family", "turn").applyInPandas(run, "a long, b long"), "links")
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return edges
    labels = components(edges).select(F.col("id").alias("doc_id"), "component")
    large = large.join(shuffled(labels), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    large = settle(large, "large-families")
    most = large.groupBy("family", "component").agg(F.count("*").alias("n")).groupBy("family").agg(F.max_by("component", F.struct("n", "component")).alias("most"))
    rest = large.join(met(most, "largest-components"), "family").where("component != most").drop("most")
    parts = met(rest.groupBy("family").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("parts")), "parts")
    if parts.isEmpty():
        return edges
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    columns = ["family", "node", "doc_id", "component", "part", "turn", "own"]
    asking = rest.join(parts, "family").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int")).withColumn("turn", F.explode(span("blocks"))).withColumn("own", F.lit(True)).select(*columns)
    against = large.join(parts, "family").withColumn("part", F.explode(span("parts"))).withColumn("turn", F.col("block")).withColumn("own", F.lit(False)).select(*columns)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        asks, others = pdf[pdf["own"]], pdf[~pdf["own"]]
        found = between([np.frombuffer(x, np.uint64) for x in asks["items"]], [np.frombuffer(x, np.uint64) for x in others["items"]], asks["component"].to_numpy(), others["component"].to_numpy())
        return pd.DataFrame(found, columns=["a", "b"])

    more = with_items(asking.union(against), large).groupBy("family", "part", "turn").applyInPandas(compare, "a long, b long")
    return edges.union(settle(more, "links"))


def between(asks: list[np.ndarray], others: list[np.ndarray], own: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """The pairs of components that a link between a set of `asks` and one of `others` connects."""
    size = np.array([len(x) for x in others], np.int64)
    flat = np.concatenate(others) if len(others) else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], np.repeat(np.arange(len(others)), size)[order]
    found = set()
    for x, mine in zip(asks, own.tolist(), strict=True):
        a, b = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
        near = row[ragged(a, b - a)]
        common = np.bincount(near, minlength=len(others))
        at = np.flatnonzero(common)
        link = at[100 * common[at] >= 75 * (len(x) + size[at] - common[at])]
        found |= {(mine, c) for c in np.unique(theirs[link]).tolist() if c != mine}
    return np.array(sorted(found), np.int64).reshape(-1, 2)


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs`.

    Equal sets are one group, known by their size and two 64-bit prints; one document stands for it. Groups with more than one in COPIES of
    all rows, at most COPIES of them, are sent to all tasks, so their rows neither send signatures nor meet in one task."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    facts = settle(rows.mapInArrow(_measure, "doc_id long, n_shingles long, f1 long, f2 long, need long"), "shingle-facts")
    total, shingles = facts.agg(F.count("*"), F.sum("n_shingles")).first()
    buckets = bucket_count(spark, shingles or 0, BUCKET)
    key = ["n_shingles", "f1", "f2"]
    some = facts.where("doc_id is not null and n_shingles > 0")
    groups = settle(some.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.min("need").alias("need")), "equal-sets")
    large = groups.where(F.col("n") >= max(2, -(-total // COPIES)))  # at most COPIES groups
    listed = sorted((r.f1, r.f2, r.rep) for r in large.select("f1", "f2", "rep").collect())
    copies = tuple(np.array([x[i] for x in listed], np.int64) for i in range(3))
    sent = spark.sparkContext.broadcast(copies)
    times = settle(shared(rows, buckets, sent), "shared-signatures")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches):
            sets, offsets = shingle_sets(batch.column("text"))
            _, owner, below, differ = signatures(sets, offsets)
            open_ = (np.diff(offsets) > 0) & (batch.column("times").to_numpy() >= needs(owner, below, differ))
            items = [sets[a:b].tobytes() for a, b in zip(offsets[:-1][open_], offsets[1:][open_], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(_ids(batch)[open_]), pa.array(items, pa.binary())], names=["doc_id", "items"])

    reps = groups.groupBy(F.col("rep").alias("doc_id")).agg(F.min("need").alias("need"))
    asked = settle(times.join(shuffled(reps), "doc_id").where("times >= need").select("doc_id", "times"), "asked-documents")
    few = asked.limit(COPIES + 1).count() <= COPIES
    own = rows.join(F.broadcast(asked), "doc_id") if few else among(rows, asked, "doc_id").join(shuffled(asked), "doc_id")
    own = own.dropDuplicates(["doc_id", "text"])  # repeated rows are one set
    sets = settle(own.select("doc_id", "text", "times").mapInArrow(build, "doc_id long, items binary").withColumn("node", F.monotonically_increasing_id()), "shingle-sets")
    edges = linked(sets, families(sets, buckets))

    several = some.groupBy("doc_id").agg(F.count_distinct(*key).alias("k"), F.count("*").alias("n")).where("n > 1")  # documents of several rows
    many = several
    ties = some.join(shuffled(many.where("k > 1").select("doc_id")), "doc_id").join(shuffled(groups), key).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a != b")
    labels = components(edges.union(ties)).select(F.col("id").alias("rep"), "component")
    named = groups.join(shuffled(labels), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"), "n")
    named = settle(named, "named-sets")
    hot = F.broadcast(named.where(F.col("n") >= max(2, -(-total // COPIES))).select(*key, F.col("component").alias("hot")))  # at most COPIES rows
    out = facts.join(hot, key, "left")
    rest = out.where("hot is null").join(shuffled(named.select(*key, "component")), key, "left")
    out = out.where("hot is not null").withColumn("component", F.col("hot")).unionByName(rest)
    out = out.withColumn("component", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component")))
    blank = facts.where("doc_id is not null and n_shingles = 0").join(shuffled(some.select("doc_id").distinct()), "doc_id", "left_semi")
    if not blank.isEmpty():  # a document with blank rows beside others
        other = out.where("component is not null").join(shuffled(blank.select("doc_id").distinct()), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component").alias("own"))
        out = out.join(shuffled(other), "doc_id", "left").withColumn("component", F.coalesce("component", "own"))
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with one document of each component, its smallest doc_id, and one of its rows with equal texts; rows with a
    null doc_id or without a word stay."""
    found = settle(classes(docs), "classes")
    gone = met(found.where("doc_id != component_id").select("doc_id").distinct(), "gone")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = found.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = met(again, "repeated")
    if again.isEmpty():
        return kept
    worded = F.size(words_of(F.col("text"))) > 0
    some = kept.join(again, "doc_id", "left_semi").select(*docs.columns)
    once = some.where(worded).dropDuplicates(["doc_id", "text"]).unionByName(some.where(~worded))
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def op6(docs: DataFrame) -> DataFrame:
    """The query's digest."""
    return classes(docs)


ORACLE = r"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, string_agg(w, ' ') OVER o AS g, count(*) OVER o AS k, count(*) OVER (PARTITION BY rid) AS n FROM t WINDOW o AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
s AS (SELECT DISTINCT rid, g, least(n, 5) AS k FROM g WHERE k = least(n, 5)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
common AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k = b.k AND a.rid < b.rid GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT wa.doc_id AS a, wb.doc_id AS b FROM link JOIN w wa ON wa.rid = a JOIN w wb ON wb.rid = b UNION SELECT wb.doc_id, wa.doc_id FROM link JOIN w wa ON wa.rid = a JOIN w wb ON wb.rid = b),
reach AS (WITH RECURSIVE r AS (SELECT a AS id, a AS to_id FROM both_ways UNION SELECT r.id, e.b FROM r JOIN both_ways e ON e.a = r.to_id) SELECT id, min(to_id) AS component_id FROM r GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(reach.component_id, w.doc_id) AS component_id FROM w LEFT JOIN n USING (rid) LEFT JOIN reach ON reach.id = w.doc_id
"""
