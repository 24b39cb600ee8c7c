"""Near-duplicate embeddings over an inverted multi-index.

Both halves of the unit vectors have a codebook of their own; the pairs of their centroids form a grid of cells. A vector
is stored in its cell and looks for neighbours in the cells nearest to it, which the multi-sequence traversal yields in
order; how many it visits is calibrated to a target recall for pairs right at the threshold. Neighbouring cells make
blocks: a vector goes to every block it visits once, with the numbers of its cells there. Every pair that meets is
verified in double precision.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import components, cut, discard, forest, id_again, known_id, small

THRESHOLD = 0.9
#: Share of pairs at the threshold of which one has to visit the other's cell.
TARGET_RECALL = 0.998
#: Bounds of the sample that the codebooks are fitted on, about so many vectors and bytes, drawn by hash, and of the calibration.
SAMPLE, SAMPLE_BYTES, CALIBRATION = 50_000, 64 << 20, 2_000
#: Vectors of a cell, on average; sampled vectors of a code, at least, which bounds the grid at 2,500 x 2,500 cells.
CELL_ROWS, CODE_ROWS = 128, 20
#: Vectors stored in a block, on average and in one task at most, and bytes of them; rows that are set against each other in one go.
BLOCK_ROWS, BLOCK_BYTES, STEP = 8192, 32 << 20, 1024


def _nearest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances of every row of x to every code."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(axis=1)[None, :], 0)


def _codebook(x: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    codes = x[rng.choice(len(x), size, replace=False)].copy()
    for _ in range(10):
        own = _nearest(x, codes).argmin(axis=1)
        for k in range(size):
            mine = x[own == k]
            if len(mine):
                codes[k] = mine.mean(axis=0)
    return codes


def _in_line(codes: np.ndarray) -> np.ndarray:
    """The codes in the order of their main axis, so that near ones have near numbers."""
    centred = codes - codes.mean(axis=0)
    return codes[np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")] if len(codes) > 1 else codes


class MultiIndex:
    """Two codebooks, the number of cells a search visits and the block of every cell."""

    def __init__(self, codes: tuple[np.ndarray, np.ndarray], visits: int, blocks: int = 1):
        self.codes, self.visits = codes, visits
        parts = [np.arange(len(c)) * blocks // len(c) for c in codes]
        self.block_of = (parts[0][:, None] * blocks + parts[1][None, :]).ravel()

    @classmethod
    def fit(cls, sample: np.ndarray, n_vectors: int, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> MultiIndex:
        rng = np.random.default_rng(11)
        half = sample.shape[1] // 2
        size = max(1, min(max(1, len(sample) // CODE_ROWS), math.ceil(math.sqrt(n_vectors / CELL_ROWS))))
        codes = tuple(_in_line(_codebook(x, size, rng)) for x in (sample[:, :half], sample[:, half:]))
        index = cls(codes, 1, max(1, math.ceil(math.sqrt(n_vectors / BLOCK_ROWS))))
        x = sample[rng.permutation(len(sample))[:CALIBRATION]]
        side = rng.normal(size=x.shape)
        side -= (side * x).sum(axis=1, keepdims=True) * x
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
        y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * side
        index.visits = int(np.quantile(np.minimum(index._ranks(x, y), index._ranks(y, x)), recall, method="higher"))
        return index

    def _distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = len(self.codes[0][0])
        return _nearest(x[:, :half], self.codes[0]), _nearest(x[:, half:], self.codes[1])

    def _ranks(self, x: np.ndarray, y: np.ndarray) -> list[int]:
        """How many cells each x has to visit to come to that of its y."""
        cells = [d.argmin(axis=1) for d in self._distances(y)]
        return [int((a[:, None] + b[None, :] < a[i] + b[j]).sum()) + 1 for a, b, i, j in zip(*self._distances(x), *cells, strict=True)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """For every row the cells to visit, nearest first: its own is the first."""
        n2 = len(self.codes[1])
        out = np.empty((len(x), min(self.visits, len(self.block_of))), dtype=np.int64)
        for r, (a, b) in enumerate(zip(*self._distances(x), strict=True)):
            order1, order2 = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
            i, j = np.array(multi_sequence(a[order1].tolist(), b[order2].tolist(), self.visits)).T
            out[r] = order1[i] * n2 + order2[j]
        return out


def multi_sequence(a: list[float], b: list[float], n: int) -> list[tuple[int, int]]:
    """The first n pairs (i, j) in the order of a[i] + b[j], for ascending a and b."""
    queue, seen, out = [(a[0] + b[0], 0, 0)], {(0, 0)}, []
    while queue and len(out) < n:
        _, i, j = heapq.heappop(queue)
        out.append((i, j))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(queue, (a[x] + b[y], x, y))
    return out


def _matrix(column, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, v in enumerate(column.to_pylist()):
        out[i, : len(v)] = v
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    # components may be so large or small that their squares are not finite or zero
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _visits(index: MultiIndex, width: int, kind: str):
    """(node, copies, dim, vector) -> the vector once as stored, with all cells it visits, and once for each block it visits, with its cells there."""

    def run(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, 1024):
                batch = whole.slice(s, 1024)
                raw = _matrix(batch.column(3), width)
                cells = index.cells(_unit(raw)).astype("<i4")
                packed = [v.tobytes() for v in raw.astype(kind)]
                rows = [(i, int(index.block_of[c[0]]), True, int(c[0]), c.tobytes()) for i, c in enumerate(cells)]
                for i, c in enumerate(cells):
                    of = index.block_of[c]
                    rows += [(i, b, False, int(c[0]), c[of == b].tobytes()) for b in np.unique(of).tolist()]
                at, block, own, home, visited = zip(*rows, strict=True)
                at = pa.array(at)
                columns = [pa.array(block, pa.int32()), pa.array(own), pa.array(home, pa.int32()), *[batch.column(k).take(at) for k in range(3)], pa.array(packed, pa.binary()).take(at), pa.array(visited, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "own", "home", "node", "copies", "dim", "raw", "cells"])

    return run


def _verified(width: int, threshold: float, kind: str):
    """The rows of one block, or of a part of what it stores and a part of its visitors -> (node, linked copies, root) of every row with a link."""

    def run(table):
        own = table.column("own").to_numpy(zero_copy_only=False)
        node, copies, dim, home = (table.column(c).to_numpy() for c in ("node", "copies", "dim", "home"))
        unit = _unit(np.frombuffer(b"".join(table.column("raw").to_pylist()), kind).reshape(-1, width).astype(np.float64))
        cells = [np.frombuffer(c, "<i4") for c in table.column("cells").to_pylist()]
        stored, asking = np.flatnonzero(own), np.flatnonzero(~own)
        more = np.zeros(len(node), dtype=np.int64)
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        asked = np.concatenate([np.empty(0, np.int32), *[cells[i] for i in asking.tolist()]])
        asker = np.repeat(asking, [len(cells[i]) for i in asking.tolist()])
        order = np.argsort(asked, kind="stable")
        asked, asker = asked[order], asker[order]
        stored = stored[np.argsort(home[stored], kind="stable")]
        for cell in np.unique(home[stored]).tolist():
            t = stored[slice(*np.searchsorted(home[stored], [cell, cell + 1]))]
            q = asker[slice(*np.searchsorted(asked, [cell, cell + 1]))]
            for u in range(0, len(t), STEP):
                ts = t[u : u + STEP]
                visited = np.stack([cells[i] for i in ts.tolist()])
                for s in range(0, len(q), STEP):
                    qs = q[s : s + STEP]
                    link = (unit[qs] @ unit[ts].T >= threshold) & (node[qs][:, None] != node[ts][None, :]) & (dim[qs][:, None] == dim[ts][None, :])
                    i, j = np.nonzero(link)
                    if not len(i):
                        continue
                    more[qs] += link @ copies[ts]
                    # a stored one that does not visit the cell of the one that found it counts it here
                    homes, at = np.unique(home[qs], return_inverse=True)
                    back = np.stack([(visited == h).any(axis=1) for h in homes])
                    more[ts] += (link & ~back[at]).T @ copies[qs]
                    x, y = forest(node[qs[i]], node[ts[j]])
                    a, b = np.concatenate([a, x]), np.concatenate([b, y])
        a, b = forest(a, b)
        root = dict(zip(a.tolist(), b.tolist(), strict=True))
        # the same node can be here on both sides
        total: dict[int, int] = {}
        for n, m in zip(node.tolist(), more.tolist(), strict=True):
            if m or n in root:
                total[n] = total.get(n, 0) + m
        return pa.table({"node": pa.array(list(total), pa.int64()), "links": pa.array(list(total.values()), pa.int64()), "root": pa.array([root.get(n, n) for n in total], pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Links and classes of all rows of ``vectors`` by cosine.

    Returns vec_id, n_links (other rows linked directly), component_id (smallest vec_id that links reach, itself
    included), kept. All links returned are real; those between vectors far from each other's cells can be missed (see
    TARGET_RECALL). Equal vectors are one entry of the index, with their number. Vectors that are null, empty, all zero
    or hold null or non-finite components link with nothing, and neither do vectors of different length. Rows that repeat
    an id are vectors of their own; a null id is the smallest. An empty table gives an empty result. Other columns are ignored.
    """
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    vector = F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>")
    rows = cut(vectors.select(known_id(id_col).alias("vec_id"), vector.alias("vector")), "vectors", narrow=False)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    is_good = F.coalesce(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    good = rows.where(is_good).withColumn("key", F.xxhash64("vector"))
    distinct = good.groupBy("key", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    # a number of its own for each distinct vector, fixed by writing it
    distinct = cut(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors", narrow=False)
    n, width = distinct.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    none = F.lit(0).cast("long")
    if not n:
        return rows.select(id_again("vec_id"), none.alias("n_links"), id_again("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width += width % 2
    share = min(1.0, min(SAMPLE, max(CALIBRATION, SAMPLE_BYTES // (8 * width))) / n)
    drawn = distinct.where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) < math.ceil(share * (1 << 30)))
    sample = drawn.select("key", "vector").toArrow().sort_by("key")
    # a few vectors can have none among the drawn
    sample = sample if len(sample) else distinct.select("key", "vector").limit(1).toArrow()
    index = MultiIndex.fit(_unit(_matrix(sample.column("vector"), width)), n, threshold)

    visits = distinct.select("node", "copies", F.size("vector").alias("dim"), "vector").mapInArrow(
        _visits(index, width, kind), "block int, own boolean, home int, node long, copies long, dim int, raw binary, cells binary"
    )
    visits = cut(visits, "visits", narrow=False)
    most = max(256, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))
    sizes = visits.groupBy("block").agg(F.ceil(F.count_if("own") / (2 * most)).cast("int").alias("targets"), F.ceil(F.count_if(~F.col("own")) / (4 * most)).cast("int").alias("queries"))
    sizes = cut(sizes.where("targets > 0"), "block-sizes")
    split = visits.join(small(sizes, sizes.count()), "block").withColumn("salt", F.xxhash64("node", F.lit("block")))
    asks = split.where("NOT own").select("*", F.expr("int(pmod(salt, queries))").alias("q"), F.explode(F.expr("sequence(0, targets - 1)")).alias("t"))
    stored = split.where("own").select("*", F.explode(F.expr("sequence(0, queries - 1)")).alias("q"), F.expr("int(pmod(salt, targets))").alias("t"))
    met = asks.unionByName(stored).drop("salt", "targets", "queries")
    found = cut(met.groupBy("block", "q", "t").applyInArrow(_verified(width, threshold, kind), "node long, links long, root long"), "vector-links")
    discard(visits, sizes)

    roots = components(found.where("node <> root").select("node", "root"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = distinct.join(links, "node", "left").join(roots, "node", "left")
    classes = classes.select("key", "vector", "least", (F.coalesce("links", none) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    classes = cut(classes, "vector-classes", narrow=False)
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(names, "root").select("key", "vector", "n_links", "component_id")
    keyed = good.join(classes, ["key", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~is_good).select("vec_id", none.alias("n_links"), F.col("vec_id").alias("component_id"))
    out = keyed.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
    return out.select(id_again("vec_id"), "n_links", id_again("component_id"), "kept")
