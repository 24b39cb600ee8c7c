"""SimHash near-duplicates: fingerprints of word shingles, linked when few bits differ.

Distinct fingerprints meet in buckets of the bands they share. Inside a bucket they lie as bit planes, one bit of all
fingerprints to a plane; shifting the planes by d lanes sets every fingerprint against the d-th after it, and carry-save
counters add up the differing bits of 64 pairs in each machine word.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import components, cut, discard, fewer_files, forest, id_again, known_id, small, text_of

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Fingerprints of one bucket that are set against each other in one go; larger buckets are split into pairs of blocks.
BLOCK = 4096
#: Planes after which words whose 64 pairs are all beyond the radius are left out.
CHECK_PLANES = (8, 16, 24, 40)
#: Similar documents: words of a shingle, the similarity of their sets from which on two are linked, and the search for
#: candidates: 64-bit parts of the fingerprint, and how many bits of the first part and of all parts may differ. Two large
#: sets of similarity 0.8 differ in 15 % of the bits, 39 of 256 with a deviation of 6; sets of a few shingles in up to 19 %.
SIMILAR_WORDS, SIMILARITY, PARTS = 5, 0.8, 4
FIRST_RADIUS, ALL_RADIUS = 22, 64
#: Keys under which similar sets meet: rows of a key, on average; the share of bits that differ, for which MISSED of the pairs share no key.
KEY_ROWS, DIFFERING, MISSED = 64, 0.17, 0.001
MIN_KEY_BITS, MAX_KEY_BITS = 6, 30
#: Bytes of a batch of shingle sets; sets, and their shingles, that a task holds against as many others.
SET_BYTES = 4 << 20
BLOCK_SETS, BLOCK_SHINGLES = 512, 2_000_000


def shingle_hashes(text: str | None, words: int, seed: int):
    """Hashes of all shingles of a text, 16,384 at a time; a text of fewer words is one shingle."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
    span = min(words, len(tokens))
    starts = np.concatenate([[0], ends[: len(ends) - span] + 1]).tolist()
    ends = ends[span - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for s in range(0, len(ends), 16_384):
        yield np.array([digest(joined[a:b], seed) for a, b in zip(starts[s : s + 16_384], ends[s : s + 16_384], strict=True)], dtype=np.uint64)


def shingle_set(text: str | None, words: int = SIMILAR_WORDS, seed: int = SEED) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    return np.unique(np.concatenate([np.empty(0, dtype=np.uint64), *shingle_hashes(text, words, seed)]))


def parts_of(chunks, parts: int) -> list[int]:
    """The SimHash of hashes in parts of 64 bits; 0 if there are none. Further parts come from mixing the hashes."""
    ones = np.zeros((parts, 64), dtype=np.int64)
    n = 0
    for hashes in chunks:
        n += len(hashes)
        for k in range(parts):
            if k:
                hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
                hashes ^= hashes >> np.uint64(29)
            bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[k] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > n, axis=1, bitorder="little").view("<u8").ravel().tolist()


def fingerprint_parts(text: str | None, words: int, seed: int, parts: int) -> list[int]:
    """The SimHash of a text in parts of 64 bits, repeated shingles counted as often as they occur."""
    return parts_of(shingle_hashes(text, words, seed), parts)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text; 0 if it has no words."""
    return fingerprint_parts(text, words, seed, 1)[0]


def _fingerprints(words: int, seed: int):
    def run(batches):
        for batch in batches:
            found = [fingerprint(x.as_py(), words, seed) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], names=["doc_id", "text_key", "fp"])

    return run


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) of every row: NO_ID for a null id, a hash of the text, its fingerprint as a signed long."""
    rows = docs.select(known_id(id_col).alias("doc_id"), _text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints(words, seed), "doc_id long, text_key long, fp long")


def _text_key(text_col: str):
    return F.xxhash64(text_of(text_col))


def to_planes(values: np.ndarray) -> np.ndarray:
    """64 bit planes of uint64 values: bit i of word w of plane k is bit k of value 64 w + i. One spare word follows."""
    n = len(values)
    words = -(-n // 64)
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = np.zeros((64, (words + 1) * 8), dtype=np.uint8)
    planes[:, : -(-n // 8)] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return planes.view("<u8")


def _shifted(plane: np.ndarray, at: np.ndarray | slice, lanes: int) -> np.ndarray:
    """The words ``at`` of a plane moved by ``lanes`` lanes towards the start."""
    q, r = divmod(lanes, 64)
    last = len(plane) - 1
    idx = np.arange(last)[at] if isinstance(at, slice) else at
    low = plane[np.minimum(idx + q, last)]
    if r == 0:
        return low
    return (low >> np.uint64(r)) | (plane[np.minimum(idx + q + 1, last)] << np.uint64(64 - r))


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is over the radius; the last counter is sticky overflow."""
    *bits, over = counters
    more = over.copy()
    same = ~over
    for k in reversed(range(len(bits))):
        if radius >> k & 1:
            same = same & bits[k]
        else:
            more |= same & bits[k]
            same = same & ~bits[k]
    return more


def within_radius(planes: np.ndarray, lanes: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """Of the ``lanes`` (a mask, a word for 64), those whose value differs from the one ``shift`` lanes on in at most ``radius`` bits."""
    at = np.flatnonzero(lanes)
    alive = lanes[at]
    counters = [np.zeros(len(at), dtype=np.uint64) for _ in range(max(1, radius.bit_length()) + 1)]
    for k in range(0, 64, 2):
        a = planes[k][at] ^ _shifted(planes[k], at, shift)
        b = planes[k + 1][at] ^ _shifted(planes[k + 1], at, shift)
        half = a ^ b
        carry = (a & b) | (half & counters[0])
        counters[0] ^= half
        for c in range(1, len(counters) - 1):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        counters[-1] |= carry
        if k + 2 in CHECK_PLANES:
            keep = (alive & ~_beyond(counters, radius)) != 0
            if not keep.all():
                at, alive, counters = at[keep], alive[keep], [c[keep] for c in counters]
            if len(at) == 0:
                break
    out = np.zeros(len(lanes), dtype=np.uint64)
    out[at] = alive & ~_beyond(counters, radius)
    return out


def _mask(flags: np.ndarray, words: int) -> np.ndarray:
    packed = np.zeros(words * 8, dtype=np.uint8)
    packed[: -(-len(flags) // 8)] = np.packbits(flags, bitorder="little")
    return packed.view("<u8")


def near_pairs(bucket: np.ndarray, fp: np.ndarray, radius: int):
    """Arrays (i, j) of all pairs of rows i < j of one bucket whose fingerprints lie within the radius; rows come sorted by bucket.

    No row is twice in an array.
    """
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
    size = np.diff(np.concatenate([first, [len(bucket)]]))
    after = np.repeat(first + size, size) - 1 - np.arange(len(bucket))  # rows of the bucket that follow
    shift, rows, at = 1, len(bucket), np.arange(len(bucket))
    planes = None
    while True:
        active = after >= shift
        n_active = int(active.sum())
        if n_active == 0:
            break
        if planes is None or n_active * 2 < rows:
            # only buckets that still have pairs at this shift stay
            keep = np.repeat(size > shift, size)
            fp, at, after, size = fp[keep], at[keep], after[keep], size[size > shift]
            active, rows = after >= shift, int(keep.sum())
            planes = to_planes(fp)
        near = within_radius(planes, _mask(active, planes.shape[1] - 1), shift, radius)
        i = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[: len(fp)])
        if len(i):
            yield at[i], at[i + shift]
        shift += 1


def bucket_forest(bucket: np.ndarray, fp: np.ndarray, node: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) over the pairs of ``near_pairs``."""
    left, right = np.empty(0, np.int64), np.empty(0, np.int64)
    for i, j in near_pairs(bucket, fp, radius):
        left, right = np.concatenate([left, node[i]]), np.concatenate([right, node[j]])
        if len(left) > 500_000:
            left, right = forest(left, right)
    return forest(left, right)


def _whole_buckets(batches):
    """The columns of sorted batches, cut between buckets."""
    rest = None
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        rest = cols if rest is None else [np.concatenate(x) for x in zip(rest, cols, strict=True)]
        if len(rest[0]) < 200_000:
            continue
        end = int(np.searchsorted(rest[0], rest[0][-1]))  # the last bucket may go on in the next batch
        if end:
            yield [c[:end] for c in rest]
            rest = [c[end:] for c in rest]
    if rest is not None and len(rest[0]):
        yield rest


def _pair_batches(a: np.ndarray, b: np.ndarray):
    for s in range(0, len(a), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[s : s + 50_000]), pa.array(b[s : s + 50_000])], names=["node", "root"])


def _links(radius: int):
    def run(batches):
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        for cols in _whole_buckets(batches):
            x, y = bucket_forest(cols[0], cols[1].view(np.uint64), cols[2], radius)
            a, b = forest(np.concatenate([a, x]), np.concatenate([b, y]))
        yield from _pair_batches(a, b)

    return run


def _may_be_alike(cols: list[np.ndarray], radius: int, all_radius: int, similarity: float):
    """(i, j, differing bits) of the pairs of rows (bucket, fp, node, label, size, further parts) that may be similar and differ in label."""
    label, size = cols[3], cols[4]
    parts = np.stack([c.view(np.uint64) for c in [cols[1], *cols[5:]]], axis=1)
    for i, j in near_pairs(cols[0], cols[1].view(np.uint64), radius):
        keep = (label[i] != label[j]) & (np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]))
        i, j = i[keep], j[keep]
        bits = np.bitwise_count(parts[i] ^ parts[j]).sum(axis=1, dtype=np.int64)
        keep = bits <= all_radius
        if keep.any():
            yield i[keep], j[keep], bits[keep]


def _favourites(radius: int, all_radius: int, similarity: float):
    """Of every row's candidates the one of the least node and the one that differs in the fewest bits."""

    def run(batches):
        for cols in _whole_buckets(batches):
            node = cols[2]
            far = np.iinfo(np.int64).max
            least, nearest = np.full(len(node), far), np.full(len(node), far)
            fewest = np.full(len(node), 64 * PARTS + 1)
            for i, j, bits in _may_be_alike(cols, radius, all_radius, similarity):
                for x, y in ((i, j), (j, i)):
                    least[x] = np.minimum(least[x], node[y])
                    better = bits < fewest[x]
                    fewest[x[better]], nearest[x[better]] = bits[better], node[y[better]]
            has = fewest <= all_radius
            yield pa.RecordBatch.from_arrays([pa.array(c[has]) for c in (node, least, fewest, nearest)], names=["node", "least", "bits", "nearest"])

    return run


def _candidates(radius: int, all_radius: int, similarity: float):
    """(node, root): a forest that joins all candidates."""

    def run(batches):
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        for cols in _whole_buckets(batches):
            for i, j, _ in _may_be_alike(cols, radius, all_radius, similarity):
                a, b = np.concatenate([a, cols[2][i]]), np.concatenate([b, cols[2][j]])
                if len(a) > 500_000:
                    a, b = forest(a, b)
            a, b = forest(a, b)
        yield from _pair_batches(a, b)

    return run


def alike_in_cell(block: np.ndarray, node: np.ndarray, label: np.ndarray, parts: np.ndarray, sets: list[np.ndarray], all_radius: int = ALL_RADIUS, similarity: float = SIMILARITY):
    """(node, root): a forest of the links between the rows of two blocks, or of one, that differ in label.

    Fingerprints first; then one set is marked, and what all others have in common with it is counted in one go.
    """
    size = np.array([len(x) for x in sets], dtype=np.int64)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(size)
    starts = ends - size
    mark = np.zeros(int(codes.max()) + 1 if len(codes) else 1, dtype=bool)
    one = block.min() == block.max()
    sides = (np.arange(len(node)),) * 2 if one else (np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max()))
    asks, stored = sorted(sides, key=len)
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for k, i in enumerate(asks.tolist()):
        to = stored[k + 1 :] if one else stored
        to = to[(label[to] != label[i]) & (np.minimum(size[to], size[i]) >= similarity * np.maximum(size[to], size[i]))]
        to = to[np.bitwise_count(parts[to] ^ parts[i]).sum(axis=1, dtype=np.int64) <= all_radius]
        if not len(to):
            continue
        own = codes[starts[i] : ends[i]]
        mark[own] = True
        if 16 * len(to) < len(node):
            both = np.array([mark[codes[starts[j] : ends[j]]].sum() for j in to.tolist()])
        else:
            before = np.concatenate([[0], np.cumsum(mark[codes])])
            both = before[ends[to]] - before[starts[to]]
        mark[own] = False
        to = to[both >= similarity * (size[to] + size[i] - both)]
        a, b = np.concatenate([a, np.full(len(to), node[i])]), np.concatenate([b, node[to]])
        if len(a) > 500_000:
            a, b = forest(a, b)
    return forest(a, b)


def _cell(all_radius: int, similarity: float):
    def run(table):
        block, node, label = (table.column(c).to_numpy() for c in ("block", "node", "label"))
        parts = np.stack([table.column(p).to_numpy().view(np.uint64) for p in _PARTS], axis=1)
        sets = [np.frombuffer(v.as_buffer() or b"", dtype="<u8") for v in table.column("hashes")]
        a, b = alike_in_cell(block, node, label, parts, sets, all_radius, similarity)
        return pa.table({"node": pa.array(a), "root": pa.array(b)})

    return run


def _cells(members: DataFrame) -> DataFrame:
    """(component, node, label, size, ...) -> a row for each cell, that is a pair of blocks, in which a row meets others of its component.

    A label of many rows has blocks of its own, which don't meet each other: nothing inside a label is compared.
    """
    counts = members.groupBy("component", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    counts = cut(counts.withColumn("own", F.when(F.col("n") >= BLOCK_SETS, F.col("label"))), "label-sizes")
    groups = counts.groupBy("component", "own").agg(F.sum("n").alias("n"), F.sum("shingles").alias("shingles"))
    groups = groups.withColumn("blocks", F.greatest(F.ceil(F.col("n") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int"))
    in_order = Window.partitionBy("component").orderBy(F.col("own").asc_nulls_first())
    first, every = F.sum("blocks").over(in_order) - F.col("blocks"), F.sum("blocks").over(Window.partitionBy("component"))
    groups = groups.select(F.col("component").alias("c"), F.col("own").alias("o"), "blocks", first.cast("int").alias("first"), every.cast("int").alias("all"))
    placed = counts.select("component", "label", "own").join(groups, (F.col("component") == F.col("c")) & F.col("own").eqNullSafe(F.col("o"))).drop("c", "o")
    placed = cut(placed, "blocks")
    rows = members.join(placed, ["component", "label"]).withColumn("block", F.col("first") + F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int"))
    meets = F.filter(F.sequence(F.lit(0), F.col("all") - 1), lambda o: F.col("own").isNull() | (o < F.col("first")) | (o >= F.col("first") + F.col("blocks")))
    met = rows.withColumn("other", F.explode(meets))
    return met.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("own", "blocks", "first", "all", "other")


def _bands(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 2 bands: two of them are equal in any two fingerprints within the radius."""
    n = radius + 2
    cuts = [64 * k // n for k in range(n + 1)]
    return [(cuts[k], cuts[k + 1] - cuts[k]) for k in range(n)]


def link_fingerprints(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(node, root) links between the rows (node, fp) with distinct fp; at least those that join each class within the radius.

    Any two fingerprints that differ in ``radius`` bits agree on two of radius + 2 bands, so every pair of bands is a
    key under which they meet: nothing within the radius is missed.
    """
    keys = []
    for k, (x, y) in enumerate(combinations(_bands(radius), 2)):
        parts = [F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1) for first, width in (x, y)]
        keys.append(F.shiftleft(parts[0], y[1]).bitwiseOR(parts[1]).bitwiseOR(F.lit(k << (x[1] + y[1] + 1))))
    return _met(prints.select("node", "fp", F.explode(F.array(*keys)).alias("key")), block).mapInArrow(_links(radius), "node long, root long")


def _met(banded: DataFrame, block: int) -> DataFrame:
    """Rows (bucket, fp, node and further parts), sorted: those with the same key share a bucket; large keys are split into pairs of blocks."""
    cols = ["fp", "node", *[c for c in banded.columns if c not in ("fp", "node", "key")]]
    sizes = cut(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block), "hot-buckets")
    n_hot = sizes.count()
    if n_hot:
        hot = sizes.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
        banded = banded.join(small(hot, n_hot), "key", "left")
        mine = F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks")).cast("int")
        others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least(mine, o) * F.col("blocks") + F.greatest(mine, o))
        banded = banded.select(*cols, "key", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(others)).alias("cell"))
    else:
        banded = banded.withColumn("cell", F.lit(0))
    return banded.select(F.xxhash64("key", "cell").alias("bucket"), *cols).repartition("bucket").sortWithinPartitions("bucket")


_PARTS = [f"fp{k}" for k in range(PARTS)]


def _set_key(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes(), SEED)).view(np.int64))


def _wide(words: int, seed: int):
    def run(batches):
        for batch in batches:
            keys, sizes, found = [], [], []
            for x in batch.column(2):
                hashes = shingle_set(x.as_py(), words, seed)
                keys.append(_set_key(hashes))
                sizes.append(len(hashes))
                found.append(parts_of([hashes], PARTS))
            parts = np.array(found, dtype=np.uint64).reshape(-1, PARTS).view(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), *[pa.array(c) for c in parts.T.copy()]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "node", "size", *_PARTS])

    return run


def _sets(words: int, seed: int):
    def packed(keys, sets):
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["node", "hashes"])

    def run(batches):
        keys, sets, room = [], [], 0
        for batch in batches:
            for x in batch.column(0):
                hashes = shingle_set(x.as_py(), words, seed)
                keys.append(_set_key(hashes))
                sets.append(hashes.astype("<u8").tobytes())
                room += len(sets[-1]) + 8
                if room >= SET_BYTES:
                    yield packed(keys, sets)
                    keys, sets, room = [], [], 0
        yield packed(keys, sets)

    return run


def similarity_of(x: np.ndarray, y: np.ndarray) -> float:
    """Of two sets as sorted arrays: the share of their union that both have; 1 for two empty ones."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return float(not len(y))
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return both / (len(x) + len(y) - both)


def _alike(similarity: float):
    def run(batches):
        for batch in batches:
            sets = zip(*[[np.frombuffer(v.as_buffer() or b"", dtype="<u8") for v in batch.column(c)] for c in (2, 3)], strict=True)
            keep = [similarity_of(x, y) >= similarity for x, y in sets]
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["node", "root"]).filter(pa.array(keep, pa.bool_()))

    return run


def key_plan(n: int) -> tuple[int, int]:
    """Bits of a key and number of keys for n sets: keys are as wide as KEY_ROWS rows of each need, and as many as MISSED allows."""
    bits = min(MAX_KEY_BITS, max(MIN_KEY_BITS, math.ceil(math.log2(max(n, 1) / KEY_ROWS))))
    return bits, math.ceil(math.log(MISSED) / math.log1p(-((1 - DIFFERING) ** bits)))


def _keys(bits: int, keys: int):
    """(node, label, size, fp parts) -> a row for each key: fixed random selections of the fingerprint's bits."""
    chosen = np.random.default_rng(SEED).permuted(np.tile(np.arange(64 * PARTS), (keys, 1)), axis=1)[:, :bits]

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                words = np.stack([part.column(3 + k).to_numpy() for k in range(PARTS)], axis=1).view(np.uint64)
                flags = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(words), -1), axis=1, bitorder="little")
                key = np.empty((len(words), keys), dtype=np.int64)
                for k in range(keys):
                    key[:, k] = (flags[:, chosen[k]].astype(np.int64) << np.arange(bits)).sum(axis=1) + (k << bits)
                at = pa.array(np.repeat(np.arange(len(words)), keys))
                columns = [part.column(0).take(at), pa.array(key.ravel()), part.column(1).take(at), part.column(2).take(at), *[part.column(3 + k).take(at) for k in range(PARTS)]]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "key", "label", "size", "fp", *_PARTS[1:]])

    return run


def similar(docs: DataFrame, words: int = SIMILAR_WORDS, seed: int = SEED, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, root, component_id) of every row, NO_ID for null: classes of documents linked by sets of shingles of similarity 0.8 or more.

    Candidates come from fingerprints of the distinct shingles: those of 64 * PARTS bits meet under the keys of
    ``key_plan`` and are compared in bit planes, then over all parts; of a candidate pair the sets themselves are
    compared. That is done twice. First every set is held against two candidates only, the one of the least node and the
    one that differs least, which joins most of what belongs together without all the pairs of a group. Then all
    candidates outside their classes so far, which make components, are compared in pairs of blocks; pairs are never
    listed. Nodes are sets, whatever the ids of their documents; texts without words are one set. Rows that repeat an id
    are documents of their own. An empty table gives an empty result.
    """
    rows = docs.select(known_id(id_col).alias("doc_id"), _text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    prints = cut(rows.mapInArrow(_wide(words, seed), "doc_id long, text_key long, node long, size long, " + ", ".join(f"{p} long" for p in _PARTS)), "wide-fingerprints")
    distinct = cut(prints.groupBy("node", "size", *_PARTS).agg(F.min("doc_id").alias("least"), F.min("text_key").alias("text_key")), "distinct-fingerprints")
    bits, keys = key_plan(distinct.count())
    limits = (FIRST_RADIUS, ALL_RADIUS, SIMILARITY)
    rest = ", ".join(f"{p} long" for p in _PARTS[1:])

    def met(labelled: DataFrame) -> DataFrame:
        return _met(labelled.select("node", "label", "size", *_PARTS).mapInArrow(_keys(bits, keys), f"node long, key long, label long, size long, fp long, {rest}"), block)

    def sets_of(nodes: DataFrame) -> DataFrame:
        """(node, hashes) of the nodes."""
        wanted = cut(distinct.select("node", "text_key").join(nodes, "node", "left_semi").select("text_key"), "candidate-texts")
        texts = rows.select("text_key", "text").join(small(wanted, wanted.count()), "text_key", "left_semi").dropDuplicates(["text_key"])
        sets = cut(texts.select("text").mapInArrow(_sets(words, seed), "node long, hashes binary"), "shingle-sets", narrow=False)
        discard(wanted)
        return sets

    chosen = met(distinct.withColumn("label", F.col("node"))).mapInArrow(_favourites(*limits), "node long, least long, bits long, nearest long")
    chosen = chosen.groupBy("node").agg(F.min("least").alias("least"), F.min(F.struct("bits", "nearest"))["nearest"].alias("nearest"))
    chosen = chosen.select("node", F.explode(F.array("least", "nearest")).alias("root"))
    pairs = cut(chosen.select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root")).distinct(), "favourites")
    sets = sets_of(pairs.select(F.explode(F.array("node", "root")).alias("node")).distinct())
    with_sets = pairs.join(sets.withColumnRenamed("hashes", "x"), "node").join(sets.select(F.col("node").alias("root"), F.col("hashes").alias("y")), "root")
    links = cut(with_sets.select("node", "root", "x", "y").mapInArrow(_alike(SIMILARITY), "node long, root long"), "similar-pairs")
    discard(pairs, sets)

    roots = components(links)
    labelled = cut(distinct.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("least", "text_key"), "labelled")
    near = components(met(labelled).mapInArrow(_candidates(*limits), "node long, root long"))
    members = cut(near.unionByName(near.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("root", "component").join(labelled, "node"), "candidates")
    sets = sets_of(members.select("node"))
    cells = _cells(members.join(sets, "node"))
    more = cut(cells.groupBy("component", "low", "high").applyInArrow(_cell(ALL_RADIUS, SIMILARITY), "node long, root long"), "more-similar-pairs")
    discard(sets, members)
    roots = components(links.unionByName(more))
    discard(links, more, labelled)
    grouped = distinct.select("node", "least").join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.select("doc_id", "text_key", "node").join(grouped.select("node", "root").join(names, "root"), "node").select("doc_id", "text_key", "root", "component_id")


def classes(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp, root, component_id) of every row, NO_ID for null. Nodes are fingerprints, whatever the ids of their documents; classes of one name differ in root."""
    prints = cut(fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(link_fingerprints(distinct.select(F.col("fp").alias("node"), "fp"), radius))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(grouped.select("fp", "root").join(names, "root"), "fp")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The near-duplicate class of every row of ``docs``.

    Returns doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that can be reached over
    fingerprints at most ``radius`` bits apart, itself included. Null, empty and blank texts have fingerprint 0 and link
    like any other. Rows that repeat an id are kept, one for each; a null id is the smallest. An empty table gives an empty
    result. Other columns are ignored.
    """
    out = classes(docs, words, radius, seed, id_col, text_col)
    return out.select(id_again("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), id_again("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by=None, **options) -> DataFrame:
    """``docs`` with one row of each class: of the smallest id (null before all), then of the least hash of its text.

    Of rows alike in both, which may differ in other columns, one stays. ``by`` makes the classes: ``classes`` (the
    default) or ``similar``. Null, empty and blank texts are one class. An empty table stays empty; all columns stay.
    """
    found = cut((by or classes)(docs, id_col=id_col, text_col=text_col, **options).groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")), "class-rows")
    # a plain table on this side, so that the rows of a class that very many share can be split over tasks
    best = cut(found.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("best")), "class-best")
    judged = found.join(best, "root").withColumn("stays", F.struct("doc_id", "text_key") == F.col("best"))
    other = cut(judged.where("NOT stays OR n > 1").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "stays"), "removed-rows")
    gone, again = (r for r in (other.where("NOT stays").drop("stays"), other.where("stays").drop("stays")))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), known_id(id_col).alias("_id"), _text_key(text_col).alias("_key"))
    left = named.join(small(gone, gone.count()), ["_id", "_key"], "left_anti")
    n_again = again.count()
    if not n_again:
        return left.select("row.*")
    again = small(again, n_again)
    single = left.join(again, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])
    return left.join(again, ["_id", "_key"], "left_anti").unionByName(single).select("row.*")
