import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import substrings

SCHEMA = "doc_id long, text string, chunk long, bucket int"


def brute(rows, length):
    """{(id, text) in order: (removed runs, kept bytes)} by a table of all strings."""
    docs = sorted((i, (t or "").encode()) for i, t, *_ in rows)
    seen, out = set(), []
    for doc_id, data in docs:
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = [True] * length
            seen.add(s)
        runs, p = [], 0
        while p < len(data):
            e = p
            while e < len(data) and gone[e]:
                e += 1
            if e > p:
                runs.append((p, e))
            p = max(e, p + 1)
        out.append((doc_id, len(data), runs, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return sorted(out)


def result(df):
    return sorted((r["doc_id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["removed"]], bytes(r["kept"])) for r in df.collect())


def corpus(seed, length):
    rng = random.Random(seed)
    piece = lambda n: "".join(rng.choice("abcdé \x00") for _ in range(n))
    shared = [piece(rng.randrange(length - 5, 4 * length)) for _ in range(6)]
    rows = []
    for i in range(60):
        t = "".join(rng.choice([piece(rng.randrange(0, 2 * length)), rng.choice(shared), rng.choice(shared)[rng.randrange(9) :], "ab" * rng.randrange(length)]) for _ in range(rng.randrange(0, 5)))
        rows.append((i * 3, t, 0, 0))
    rows += [(3, rows[7][1], 0, 0), (3, rows[7][1], 0, 0), (500, None, 0, 0), (501, "", 0, 0), (502, "a" * 3000, 0, 0), (503, rows[9][1] * 2, 0, 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "length", "chunk", "hot"), [(1, 20, 300, 2048), (2, 20, 10**6, 2048), (3, 100, 2000, 4), (4, 7, 500, 2048), (5, 20, 300, 3), (6, 30, 900, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, length, chunk, hot):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(substrings, "LEAST_CHUNK_BYTES", chunk)
    rows = corpus(seed, length)
    assert result(substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA), length, hot)) == brute(rows, length)


def test_anchors_do_not_depend_on_blocks_or_place(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    starts, ends = np.array([0, 700, 750, 2000]), np.array([700, 750, 2000, 5000])

    def windows(x):
        return {p: a for a, lo, hi, *_ in zip(*x, strict=True) for p in range(lo, hi + 1)}

    whole = windows(substrings.anchors(data, starts, ends, 100))
    assert set(whole) == {p for s, e in zip(starts, ends, strict=True) for p in range(s, e - 99)}
    monkeypatch.setattr(substrings, "BLOCK", 333)
    assert windows(substrings.anchors(data, starts, ends, 100)) == whole
    alone = windows(substrings.anchors(data[2000:], np.array([0]), np.array([3000]), 100))
    assert {p + 2000: a + 2000 for p, a in alone.items()} == {p: a for p, a in whole.items() if p >= 2000}


def test_loser_tree_merges_and_knows_common_prefixes():
    rng = random.Random(2)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randrange(0, 30))) for _ in range(k)]
        common = [[0] + [next((i for i in range(12) if a[i] != b[i]), 12) for a, b in zip(r, r[1:], strict=False)] if r else [] for r in runs]
        order, prefixes = substrings.merge(runs, common)
        got = [runs[r][i] for r, i in order]
        assert got == sorted(x for r in runs for x in r)
        assert prefixes[1:] == [next((i for i in range(12) if a[i] != b[i]), 12) for a, b in zip(got, got[1:], strict=False)]


def test_null_ids(spark):
    text = "x" * 40 + "abcdefghij" * 3
    docs = spark.createDataFrame([(2**60 + 1, text, None, None), (None, text, 0, 0)], SCHEMA)
    out = {r["doc_id"]: len(r["kept"]) for r in substrings.remove_repeats(docs, 30).collect()}
    assert out[2**60 + 1] == 0 and out[None] > 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert substrings.remove_repeats(docs).count() == 0
    with pytest.raises(ValueError):
        substrings.remove_repeats(docs, 1)


def test_repeated_fingerprints_take_no_longer_in_more_chunks():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 18, 1 << 18).astype(np.uint64)

    def run(chunks):
        parts = [np.unique(p) for p in np.array_split(prints, chunks)]
        table = pa.table({"chunk": list(range(chunks)), "payload": pa.array([substrings._joined(p, np.ones(len(p), np.int64)) for p in parts], pa.binary())})
        began = time.process_time()
        out = substrings._repeated(4)((pa.scalar(7),), table)
        took = time.process_time() - began
        every, n = np.unique(np.concatenate(parts), return_counts=True)
        times = dict(zip(every.tolist(), n.tolist(), strict=True))
        known = {c: substrings._split(p) for c, p in zip(out["chunk"].to_pylist(), out["payload"].to_pylist(), strict=True)}
        for c, p in enumerate(parts):
            wanted = [(x, int(times[x] >= 4)) for x in p.tolist() if times[x] > 1]
            assert wanted == list(zip(*(x.tolist() for x in known[c]), strict=True))
        assert set(out["bucket"].to_pylist()) == {7}
        return took

    few, many = run(2), run(1024)
    assert many < 5 * few + 1
