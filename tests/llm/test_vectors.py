import math

import numpy as np
import pytest

from tidewatch.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node long, links long"


def brute(rows, threshold=0.9):
    x = [None if v is None or not len(v) or any(c is None or not math.isfinite(c) for c in v) or not any(v) else np.array(v, dtype=np.float32).astype(float) for _, v in rows]
    n = len(rows)
    link = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            if i != j and x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]):
                link[i, j] = x[i] @ x[j] / (np.linalg.norm(x[i]) * np.linalg.norm(x[j])) >= threshold
    root = [r[0] for r in rows]
    for _ in range(n):
        new = [min([root[i]] + [root[j] for j in np.flatnonzero(link[i])]) for i in range(n)]
        if new == root:
            break
        root = new
    return sorted((rows[i][0], int(link[i].sum()), root[i], rows[i][0] == root[i]) for i in range(n))


def near(rng, base, angle):
    side = rng.normal(size=len(base))
    side -= side @ base / (base @ base) * base
    return base / np.linalg.norm(base) * math.cos(angle) + side / np.linalg.norm(side) * math.sin(angle)


def result(df):
    return sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect())


@pytest.mark.parametrize("block", [8192, 7])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 40 if block == 7 else block)
    monkeypatch.setattr(vectors, "STEP", block)
    monkeypatch.setattr(vectors, "CODE_ROWS", 4)
    monkeypatch.setattr(vectors, "CELL_ROWS", 8)
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(25):
        base = rng.normal(size=9)
        rows += [near(rng, base, a) * rng.uniform(0.1, 9) for a in rng.uniform(0, 0.3, 8)] + [base, base]
    rows += [rng.normal(size=9) for _ in range(60)] + [rng.normal(size=4)] * 2
    rows = [[float(np.float32(c)) for c in v] for v in rows]
    rows += [None, [], [0.0] * 9, [float("nan")] + [1.0] * 8, [float("inf")] + [1.0] * 8, [None] + [1.0] * 8, rows[0][:8]]
    ids = rng.permutation(len(rows)).tolist()
    data = list(zip(ids, rows, strict=True))
    got = result(vectors.near_duplicates(spark.createDataFrame([(i, v, 0, 0, 0) for i, v in data], SCHEMA)))
    want = brute(data)
    assert [g[0] for g in got] == [w[0] for w in want]
    found, there = sum(g[1] for g in got), sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True)) and found >= 0.98 * there
    if found == there:
        assert got == want


def test_multi_sequence_is_the_sorted_order():
    rng = np.random.default_rng(2)
    a, b = np.sort(rng.random(7)).tolist(), np.sort(rng.random(5)).tolist()
    got = vectors.multi_sequence(a, b, 30)
    assert got == sorted(((i, j) for i in range(7) for j in range(5)), key=lambda p: a[p[0]] + b[p[1]])[:30]


def test_recall_against_brute_force_at_the_threshold():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array([near(rng, v, math.acos(rng.uniform(0.9, 1))) for v in x])
    index = vectors.MultiIndex.fit(x, 100_000)
    a, b = index.cells(x), index.cells(y)
    reached = np.mean([q[0] in p or p[0] in q for p, q in zip(a, b, strict=True)])
    assert reached >= 0.99 and index.visits < len(index.codes[0]) ** 2


def test_null_ids(spark):
    rows = [(None, [1.0, 0.0], 0, 0, 0), (2**60 + 1, [1.0, 0.01], None, None, None), (None, None, 0, 0, 0)]
    out = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {(None, 1, None, True), (2**60 + 1, 1, None, False), (None, 0, None, True)}


def test_repeated_and_null_ids_with_unlike_vectors(spark):
    for rows in (
        [(1, [1.0, 0.0]), (1, [0.99, 0.1])],
        [(None, [1.0, 0.0]), (None, [0.99, 0.1])],
        [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (3, [0.99, 0.1]), (4, [0.1, 0.99]), (4, None), (3, [0.99, 0.1])],
    ):
        out = result(vectors.near_duplicates(spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], SCHEMA)).fillna(-1, ["vec_id", "component_id"]))
        assert out == brute([(-1 if i is None else i, v) for i, v in rows])


def test_links_of_ten_thousand_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(2500, 24))
    rows = np.concatenate([base, *[[near(rng, v, math.acos(c)) for v, c in zip(base, rng.uniform(0.88, 1, 2500), strict=True)] for _ in range(3)]]).astype(np.float32)
    x = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    want = np.concatenate([(x[s : s + 1000] @ x.T >= 0.9).sum(axis=1) - 1 for s in range(0, len(x), 1000)])
    data = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in enumerate(rows.tolist())], SCHEMA)
    out = vectors.near_duplicates(data).toPandas().sort_values("vec_id")
    got = out["n_links"].to_numpy()
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum()


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vectors.near_duplicates(empty).count() == 0
    only_bad = spark.createDataFrame([(1, None, 0, 0, 0), (2, [0.0], 0, 0, 0)], SCHEMA)
    assert result(vectors.near_duplicates(only_bad)) == [(1, 0, 1, True), (2, 0, 2, True)]
    repeated = spark.createDataFrame([(1, [1.0], 0, 0, 0)] * 3 + [(0, [-1.0], 0, 0, 0)], SCHEMA)
    assert result(vectors.near_duplicates(repeated)) == [(0, 0, 0, True)] + [(1, 2, 1, True)] * 3
