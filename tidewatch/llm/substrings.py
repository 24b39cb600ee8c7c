"""Exact substring deduplication: every byte under a string of LENGTH bytes that also starts earlier is removed.

Suffixes are sorted, but only where two equal strings are sure to share one. Of the K-byte strings in every window of
LENGTH bytes the one with the least hash is the window's anchor: equal windows have their anchors at equal offsets, so the
suffixes that begin at anchors, about one in K / 2, stand for all. And only suffixes whose first K bytes occur twice
anywhere are worth sending; fingerprints find out. What is left is sorted in every chunk of documents, front-coded and
exchanged by fingerprint, and merged by a loser tree that knows the common prefixes and compares only what follows them.

The merged order and its common prefixes tell which suffixes agree in r bytes; the bytes before them, sorted likewise,
which agree in d bytes to the left. A window that begins d bytes before its anchor equals another exactly when both
agree, with r = LENGTH - d; all but the earliest of such windows are removed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_again, known_id, text_of

LENGTH = 100
#: Bytes of text in a chunk, which one Python call sorts; small corpora have smaller chunks, for each core to have some.
CHUNK_BYTES, LEAST_CHUNK_BYTES = 4 << 20, 256 << 10
#: Window starts that are hashed in one go.
BLOCK = 1 << 19
#: Occurrences of an anchor from which on it is hot: at the border of a passage that very many documents share, its
#: surroundings differ everywhere. The windows of a hot anchor go by their own fingerprints, so that they spread, and
#: equal ones are one in every chunk.
HOT = 2048

_rng = np.random.default_rng(7)
_BYTE_HASH = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = [np.uint64(int(x) | 1) for x in _rng.integers(0, 1 << 62, 64)]


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k bytes from each position on, put together from strings of 1, 2, 4 ... bytes."""
    part = _BYTE_HASH[data]
    out, have, width, level = None, 0, 1, 0
    n = len(data) - k + 1
    while width <= k:
        if k & width:
            piece = part[have : have + n]
            out = piece.copy() if out is None else out * _FACTORS[32 + level] + piece
            have += width
        if width * 2 <= k:
            part = part[:-width] * _FACTORS[level] + part[width:]
        width, level = width * 2, level + 1
    return _mix(out)


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(position, first and last window start, document, hash) of the anchors of all windows inside documents.

    Of equal hashes the leftmost is taken. An anchor appears once for each block of window starts that it serves.
    """
    k = length // 2
    span = length - k + 1
    doc = np.flatnonzero(ends - starts >= length)
    found: list[tuple[np.ndarray, ...]] = []
    if not len(doc):
        none = np.empty(0, np.int64)
        return none, none, none, none, np.empty(0, np.uint64)
    first, last = starts[doc], ends[doc] - length  # window starts of each document
    for b in range(int(first[0]), int(last[-1]) + 1, BLOCK):
        e = min(b + BLOCK, int(last[-1]) + 1)
        h = _hashes(data[b : e + length - 1], k)
        low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        at = (low[: e - b] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # only windows inside a document count; between those of two documents lie others
        edge = np.zeros(e - b + 1, dtype=np.int32)
        i, j = np.searchsorted(last, b), np.searchsorted(first, e)
        edge[np.maximum(first[i:j] - b, 0)] += 1
        np.subtract.at(edge, np.minimum(last[i:j] + 1, e) - b, 1)
        inside = np.cumsum(edge[:-1]) > 0
        new = inside.copy()
        new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
        lo = np.flatnonzero(new)
        stop = inside.copy()
        stop[:-1] &= (at[1:] != at[:-1]) | ~inside[1:]
        hi = np.flatnonzero(stop)
        found.append((at[lo] + b, lo + b, hi + b, doc[np.searchsorted(first, lo + b, side="right") - 1], h[at[lo]]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Chunk:
    """The documents of one chunk, in the order of id, then text: joined bytes and the anchors of their windows."""

    def __init__(self, table: pa.Table, length: int, buckets: int):
        ids = table.column("doc_id").to_numpy().astype(np.int64)
        texts = table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids = ids[order]
        texts = [texts[i] for i in order]
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in texts], dtype=np.int64)
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.length, self.buckets = length, buckets

    def find(self) -> None:
        self.at, self.lo, self.hi, self.doc, h = anchors(self.data, self.starts, self.ends, self.length)
        self.bucket = ((h & np.uint64(0xFFFFFF)) * np.uint64(self.buckets) >> np.uint64(24)).astype(np.int64)
        self.print = h >> np.uint64(24)  # 40 bits, within a bucket


def _joined(prints: np.ndarray, counts: np.ndarray) -> bytes:
    """Fingerprints of 5 bytes, each with a count of one byte that stops at 255."""
    out = prints.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].copy()
    out[:, 5] = np.minimum(counts, 255)
    return out.tobytes()


def _split(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(rows), 8), dtype=np.uint8)
    out[:, :5] = rows[:, :5]
    return out.view("<u8").ravel(), rows[:, 5].astype(np.int64)


def _table(**cols) -> pa.Table:
    kinds = {"chunk": pa.int64(), "bucket": pa.int64(), "kind": pa.int32(), "payload": pa.binary()}
    return pa.table({k: pa.array(v, kinds[k]) for k, v in cols.items()})


def _fingerprints(length: int, buckets: int):
    """chunk -> (bucket, chunk, payload): the distinct fingerprints of its anchors."""

    def run(key, table):
        chunk = Chunk(table, length, buckets)
        chunk.find()
        both = np.sort(chunk.bucket.astype(np.uint64) << np.uint64(40) | chunk.print)
        first = np.ones(len(both), dtype=bool)
        first[1:] = both[1:] != both[:-1]
        counts = np.diff(np.append(np.flatnonzero(first), len(both)))
        both = both[first]
        b = (both >> np.uint64(40)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(b, prepend=-1))
        mask = np.uint64((1 << 40) - 1)
        parts = zip(np.split(both, cuts[1:]), np.split(counts, cuts[1:]), strict=True) if len(both) else ()
        return _table(bucket=b[cuts], chunk=np.full(len(cuts), key[0].as_py(), dtype=np.int64), payload=[_joined(p & mask, n) for p, n in parts])

    return run


def _repeated(hot_from: int):
    """bucket -> (chunk, bucket, payload): for every chunk, which of its fingerprints occur twice anywhere; a count of 1 marks hot ones."""

    def run(key, table):
        chunks = table.column("chunk").to_numpy()
        parts, counts = zip(*[_split(p) for p in table.column("payload").to_pylist()], strict=True)
        every, n = np.concatenate(parts), np.concatenate(counts)
        order = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.diff(every[order], prepend=np.uint64((1 << 64) - 1)))
        total = np.empty_like(n)  # of its fingerprint, for each row
        total[order] = np.repeat(np.add.reduceat(n[order], first), np.diff(np.append(first, len(every))))
        out = []
        for c, p, t in zip(chunks.tolist(), parts, np.split(total, np.cumsum([len(p) for p in parts])[:-1]), strict=True):
            again = t > 1
            if again.any():
                out.append((c, _joined(p[again], (t[again] >= hot_from).astype(np.int64))))
        return _table(chunk=[c for c, _ in out], bucket=[key[0].as_py()] * len(out), payload=[p for _, p in out])

    return run


_HEAD = np.dtype([("id", "<i8"), ("sub", "<i4"), ("doc", "<i4"), ("at", "<i8"), ("near", "u1"), ("far", "u1"), ("same", "u1")])


def _rows(data: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int, back: bool) -> np.ndarray:
    """A matrix of the ``size`` bytes from ``begin`` on (or before it, backwards), zeros after them."""
    fill = np.zeros(width, dtype=np.uint8)
    every = np.lib.stride_tricks.sliding_window_view(np.concatenate([fill, data, fill]), width)
    out = np.ascontiguousarray(every[begin][:, ::-1]) if back else every[begin + width]
    out[np.arange(width) >= size[:, None]] = 0
    return out


def _common(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row has in common with the one before; 0 for the first."""
    out = np.zeros(len(rows), dtype=np.int64)
    differ = rows[1:] != rows[:-1]
    out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def _runs(length: int, buckets: int):
    """(documents, repeated fingerprints) of a chunk -> front-coded sorted runs (kind 0) for each bucket, and spans that are settled here (kind 1)."""

    def run(key, docs, known):
        rows: dict[str, list] = {"bucket": [], "chunk": [], "kind": [], "payload": []}
        if docs.num_rows == 0:
            return _table(**rows)
        c = Chunk(docs, length, buckets)
        c.find()
        mine = c.bucket.astype(np.uint64) << np.uint64(40) | c.print
        parts = [(np.uint64(b) << np.uint64(40), *_split(p)) for b, p in zip(known.column("bucket").to_pylist(), known.column("payload").to_pylist(), strict=True)]
        wanted = np.concatenate([np.empty(0, np.uint64), *(b | prints for b, prints, _ in parts)])
        hot = np.concatenate([np.empty(0, np.uint64), *(b | prints[marks > 0] for b, prints, marks in parts)])
        keep = np.isin(mine, wanted, kind="sort")
        if not keep.any():
            return _table(**rows)
        at, lo, hi, doc, bucket = (x[keep] for x in (c.at, c.lo, c.hi, c.doc, c.bucket))
        is_hot = np.isin(mine[keep], hot, kind="sort")
        settled = []

        def sorted_once(at, lo, hi, doc, bucket):
            """The entries by bucket and suffix, without later copies that have all their windows: these are settled, never sent."""
            near, far = at - hi, at - lo  # a window begins near .. far bytes before the anchor
            right = _rows(c.data, at, length - near, length, False)
            left = _rows(c.data, at, far, length - length // 2, True)
            whole = np.concatenate([right, left, np.stack([near, far], axis=1).astype(np.uint8)], axis=1)
            # equal ones stay in the order of documents
            order = np.argsort(np.ascontiguousarray(whole).view(f"S{whole.shape[1]}").ravel(), kind="stable")
            order = order[np.argsort(bucket[order], kind="stable")]
            whole = whole[order]
            same = np.zeros(len(order), dtype=bool)
            same[1:] = (bucket[order[1:]] == bucket[order[:-1]]) & (whole[1:] == whole[:-1]).all(axis=1)
            copies = order[same]
            if len(copies):
                start = c.starts[doc[copies]]
                settled.append(np.stack([doc[copies], lo[copies] - start, hi[copies] + length - start]))
            return [x[order[~same]] for x in (at, lo, hi, doc, bucket)], whole[~same]

        if is_hot.any():
            # one entry for each different surrounding of a hot anchor, then one for each different window
            (a, l, h, d, _), _ = sorted_once(*(x[is_hot] for x in (at, lo, hi, doc, bucket)))
            times = h - l + 1
            window = np.repeat(l, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            order = np.argsort(window)
            anchor, owner, window = np.repeat(a, times)[order], np.repeat(d, times)[order], window[order]
            own = np.zeros(len(window), dtype=np.uint64)
            for j in range(length):
                own = own * _FACTORS[0] + _BYTE_HASH[c.data[window + j]]
            spread = ((_mix(own) & np.uint64(0xFFFFFF)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
            mixed = [(at, anchor), (lo, window), (hi, window), (doc, owner), (bucket, spread)]
            at, lo, hi, doc, bucket = (np.concatenate([x[~is_hot], y]) for x, y in mixed)
            order = np.lexsort((lo, at))
            at, lo, hi, doc, bucket = (x[order] for x in (at, lo, hi, doc, bucket))
        (at, lo, hi, doc, bucket), whole = sorted_once(at, lo, hi, doc, bucket)
        near, far, order = at - hi, at - lo, np.arange(len(at))
        if settled:
            rows["bucket"].append(key[0].as_py() % buckets)  # any will do: they only pass through
            rows["kind"].append(1)
            rows["payload"].append(zstandard.ZstdCompressor(level=1).compress(np.concatenate(settled, axis=1).astype("<i8").tobytes()))
        sub = np.arange(len(c.ids)) - np.searchsorted(c.ids, c.ids)  # numbers rows that repeat an id
        common = _common(whole[:, :length])
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        common[cuts] = 0
        compressor = zstandard.ZstdCompressor(level=1)
        for b, part in zip(bucket[cuts].tolist(), np.split(np.arange(len(order)), cuts[1:]), strict=True):
            i = order[part]
            head = np.zeros(len(i), dtype=_HEAD)
            common_b = np.minimum(common[part], length - near[i])
            head["id"], head["sub"], head["doc"], head["at"] = c.ids[doc[i]], sub[doc[i]], doc[i], at[i] - c.starts[doc[i]]
            head["near"], head["far"], head["same"] = near[i], far[i], common[part]
            w, j, k = whole[part], np.arange(length), np.arange(length - length // 2)
            tails = w[:, :length][(j >= common_b[:, None]) & (j < (length - near[i])[:, None])]
            lefts = w[:, length:-2][k < far[i][:, None]]
            columns = b"".join(np.ascontiguousarray(head[f]).tobytes() for f in _HEAD.names)
            packed = compressor.compress(np.int64(len(i)).tobytes() + columns + tails.tobytes() + lefts.tobytes())
            rows["bucket"].append(b)
            rows["kind"].append(0)
            rows["payload"].append(packed)
        rows["chunk"] = [key[0].as_py()] * len(rows["bucket"])
        return _table(**rows)

    return run


def _unpacked(payload: bytes, length: int) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Head, suffixes (padded with zeros) and left sides of a run."""
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, p = np.zeros(n, dtype=_HEAD), 8
    for f in _HEAD.names:
        head[f] = np.frombuffer(raw, _HEAD[f], n, p)
        p += n * _HEAD[f].itemsize
    suffixes, before = [], b""
    for same, size in zip(head["same"].tolist(), (length - head["near"].astype(np.int64)).tolist(), strict=True):
        # a prefix in common can reach into the zeros that fill up the shorter one
        tail = max(0, size - same)
        before = (before[: size - tail] + raw[p : p + tail]).ljust(length, b"\x00")
        p += tail
        suffixes.append(before)
    width = length - length // 2
    left = np.zeros((n, width), dtype=np.uint8)
    left[np.arange(width) < head["far"][:, None]] = np.frombuffer(raw, np.uint8, offset=p)
    return head, suffixes, left


def merge(runs: list[list[bytes]], common: list[list[int]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merge sorted runs of equally long strings: (run, index) in order, and the prefix each has in common with the one before.

    A loser tree in which every contender carries the length of its prefix in common with the last winner. The longer one
    wins unseen; only equal lengths make a comparison, from there on, and its result is what the loser carries.
    """
    size = 1 << max(0, (len(runs) - 1).bit_length())
    at = [0] * size
    head: list[bytes | None] = [(runs[r][0] if r < len(runs) and runs[r] else None) for r in range(size)]
    loser, carried = [0] * size, [0] * size

    def play(a: int, ha: int, b: int, hb: int) -> tuple[int, int, int, int]:
        """Winner, its prefix, loser, its prefix. A run that has ended carries -1."""
        if ha != hb:
            return (a, ha, b, hb) if ha > hb else (b, hb, a, ha)
        if ha < 0:
            return a, ha, b, hb
        x, y = int.from_bytes(head[a][ha:]), int.from_bytes(head[b][ha:])
        seen = len(head[a]) - ((x ^ y).bit_length() + 7) // 8
        return (a, ha, b, seen) if x <= y else (b, hb, a, seen)

    nodes = [(r, 0 if head[r] is not None else -1) for r in range(size)]
    level = size
    while level > 1:
        level //= 2
        above = []
        for i in range(level):
            w, hw, lost, hl = play(*nodes[2 * i], *nodes[2 * i + 1])
            above.append((w, hw))
            loser[level + i], carried[level + i] = lost, hl
        nodes = above
    winner, h = nodes[0]
    out, prefixes = [], []
    while h >= 0:
        i = at[winner]
        out.append((winner, i))
        prefixes.append(h)
        i += 1
        at[winner] = i
        run = runs[winner]
        if i < len(run):
            head[winner], h = run[i], common[winner][i]
        else:
            h = -1
        node = (winner + size) >> 1
        while node:
            other = carried[node]
            if other > h:
                winner, loser[node] = loser[node], winner
                h, carried[node] = other, h
            elif other == h and h >= 0:
                winner, h, loser[node], carried[node] = play(winner, h, loser[node], other)
            node >>= 1
    return out, prefixes


def earlier(head: np.ndarray, common: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and farthest start, before its anchor, of the windows of each suffix that start earlier too; farthest is -1 where none does.

    Suffixes come sorted, with the prefix each has in common with the one before.
    """
    n = len(head)
    nearest, farthest = np.full(n, length, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    order = np.lexsort((head["at"], head["sub"], head["id"]))
    by_left = np.argsort(np.ascontiguousarray(left).view(f"S{left.shape[1]}").ravel(), kind="stable")
    left_common = _common(left[by_left])
    near, far = head["near"].astype(np.int64)[order], head["far"].astype(np.int64)[order]
    left_rank = np.empty(n, dtype=np.int64)
    for d in range(left.shape[1] + 1):
        valid = order[(near <= d) & (d <= far)]
        if len(valid) < 2:
            continue
        right_rank = np.cumsum(common < length - d)
        left_rank[by_left] = np.cumsum(left_common < d)
        both = right_rank[valid] * (n + 1) + left_rank[valid]
        group = np.argsort(both, kind="stable")  # the earliest first
        later = np.zeros(len(group), dtype=bool)
        later[1:] = both[group[1:]] == both[group[:-1]]
        hit = valid[group[later]]
        nearest[hit] = np.minimum(nearest[hit], d)
        farthest[hit] = d
    return nearest, farthest


def _merged(length: int):
    """bucket -> (chunk, payload): the spans of each chunk's documents that are removed."""

    def run(key, table):
        out = {"chunk": [], "payload": []}
        heads, suffixes, common, lefts, chunks = [], [], [], [], []
        for chunk, kind, payload in zip(*(table.column(c).to_pylist() for c in ("chunk", "kind", "payload")), strict=True):
            if kind == 1:
                out["chunk"].append(chunk)
                out["payload"].append(payload)
                continue
            head, strings, left = _unpacked(payload, length)
            heads.append(head)
            suffixes.append(strings)
            common.append(head["same"].tolist())
            lefts.append(left)
            chunks.append(chunk)
        if heads:
            order, prefixes = merge(suffixes, common)
            first = np.cumsum([0] + [len(h) for h in heads])
            run_of, index = np.array(order, dtype=np.int64).T
            place = first[run_of] + index
            head, left = np.concatenate(heads)[place], np.concatenate(lefts)[place]
            nearest, farthest = earlier(head, np.array(prefixes, dtype=np.int64), left, length)
            hit = farthest >= 0
            # windows of an anchor overlap, so those removed make one span
            spans = np.stack([head["doc"].astype(np.int64), head["at"] - farthest, head["at"] - nearest + length])[:, hit].astype("<i8")
            owner = run_of[hit]
            for r in np.unique(owner).tolist():
                out["chunk"].append(chunks[r])
                out["payload"].append(zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(spans[:, owner == r]).tobytes()))
        return _table(**out)

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(length: int):
    """(documents, spans) of a chunk -> what each document loses and keeps."""

    def run(key, docs, spans):
        c = Chunk(docs, length, 1) if docs.num_rows else None
        if c is None:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()), "removed": pa.array([], _SPANS), "kept": pa.array([], pa.binary())})
        edge = np.zeros(len(c.data) + 1, dtype=np.int32)
        for payload in spans.column("payload").to_pylist():
            doc, s, e = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), "<i8").reshape(3, -1)
            np.add.at(edge, c.starts[doc] + s, 1)
            np.subtract.at(edge, c.starts[doc] + e, 1)
        gone = np.cumsum(edge[:-1]) > 0
        # runs end with their document
        limit = np.zeros(len(c.data) + 1, dtype=bool)
        limit[c.starts] = True
        begin = gone.copy()
        begin[1:] &= ~gone[:-1] | limit[1:-1]
        stop = gone.copy()
        stop[:-1] &= ~gone[1:] | limit[1:-1]
        s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        kept = c.data[~gone]
        before = np.concatenate([[0], np.cumsum(~gone)])
        i, j = np.searchsorted(s, c.starts), np.searchsorted(s, c.ends)
        j = np.where(c.ends > c.starts, j, i)
        offsets = np.concatenate([i[:1], j]) if len(i) else np.zeros(1, np.int64)
        own = np.repeat(c.starts, j - i)
        pairs = pa.StructArray.from_arrays([pa.array(s - own), pa.array(e - own)], names=["start", "end"])
        return pa.table(
            {
                "doc_id": pa.array(c.ids),
                "n_bytes": pa.array(c.ends - c.starts),
                "removed": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pairs),
                "kept": pa.array([kept[before[a] : before[b]].tobytes() for a, b in zip(c.starts.tolist(), c.ends.tolist(), strict=True)], pa.binary()),
            }
        )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What exact substring deduplication leaves of every row of ``docs``.

    Returns doc_id, n_bytes, removed (array of start, end in bytes: the maximal runs) and kept (the other bytes). A string
    starts earlier if its document has a smaller id, or in the same document at an earlier byte; rows that repeat an id
    are documents of their own, in the order of their texts (rows of one id make one chunk). Null texts are empty, null ids come before all others. An empty table
    gives an empty result. Other columns are ignored.
    """
    if not 2 <= length <= 200:
        raise ValueError("length must be from 2 to 200")
    base = docs.select(known_id(id_col).alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = base.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    chunks = max(1, math.ceil(total / min(CHUNK_BYTES, max(LEAST_CHUNK_BYTES, total / (4 * parts)))))
    buckets = max(1, min(chunks, 1 << 20) // 2)
    chunked = base.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    prints = chunked.groupBy("chunk").applyInArrow(_fingerprints(length, buckets), "bucket long, chunk long, payload binary")
    known = prints.groupBy("bucket").applyInArrow(_repeated(hot), "chunk long, bucket long, payload binary")
    runs = chunked.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_runs(length, buckets), "bucket long, chunk long, kind int, payload binary")
    spans = runs.groupBy("bucket").applyInArrow(_merged(length), "chunk long, payload binary")
    out = chunked.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(_cut(length), "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
    return out.select(id_again("doc_id"), "n_bytes", "removed", "kept")
