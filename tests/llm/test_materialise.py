import random
from pathlib import Path

import numpy as np
import pytest

from tidewatch.llm import materialise

SCHEMA = "doc_id long, text string, shard long, slot int, file string"
VOCABULARY = Path("/opt/tokenizers/byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_permutation(n):
    values = np.arange(n)
    a, b = materialise.permute(values, n, 1), materialise.permute(values, n, 2)
    assert sorted(a.tolist()) == sorted(b.tolist()) == values.tolist()
    assert np.array_equal(materialise.permute(a, n, 1, inverse=True), values)
    if n > 50:
        assert (a != b).mean() > 0.9 and abs(np.corrcoef(values, a)[0, 1]) < 0.2


def round_trip(spark, tokenizer, rows, size, shard_rows):
    out = materialise.materialise(spark.createDataFrame(rows, SCHEMA).repartition(3), tokenizer, 5, size, shard_rows).cache()
    shards = sorted(out.collect(), key=lambda r: r["shard"])
    assert [r["shard"] for r in shards] == list(range(len(shards)))
    assert all(r["n_rows"] == shard_rows for r in shards[:-1]) and all(r["stride"] == 2 * size and len(r["payload"]) == r["n_rows"] * 2 * size for r in shards)
    records = list(materialise.read(out, 0, shard_rows))
    assert [s for s, _ in records] == list(range(len(records)))
    for start in (1, shard_rows - 1, shard_rows, len(records) - 1, len(records)):
        again = list(materialise.read(out, start, shard_rows))
        assert [s for s, _ in again] == list(range(start, len(records))) and all(np.array_equal(x, records[s][1]) for s, x in again)
    parts = {}
    for r in shards:
        for k, (doc, seq, n) in enumerate(zip(r["doc_ids"], r["seqs"], r["n_tokens"], strict=True)):
            tokens = records[r["first_slot"] + k][1]
            assert (tokens[n:] == tokenizer.end).all()
            parts.setdefault(doc, []).append((seq, tokens[:n]))
    out.unpersist()
    return {d: tokenizer.decode(np.concatenate([t for _, t in sorted(p, key=lambda x: x[0])])[:-1]) for d, p in parts.items()}


def tokenizers():
    small = {bytes([i]): i for i in range(256)} | {b"th": 256, b"the": 257, b" the": 258}
    made = [materialise.ByteTokenizer(), materialise.RankTokenizer(small)]
    return [*made, materialise.RankTokenizer.from_file(str(VOCABULARY))] if VOCABULARY.exists() else made


@pytest.mark.parametrize("tokenizer", tokenizers(), ids=lambda t: f"{type(t).__name__}-{t.end}")
def test_exact_round_trip(spark, tokenizer):
    rng = random.Random(1)
    texts = [None, "", " \n", "é😀\x00", "the " * 4000] + ["".join(rng.choice(["the ", "ü", "\n", "other", "<|endoftext|>"]) for _ in range(rng.randrange(90))) for _ in range(120)]
    rows = [(i, t, 0, 0, "f") for i, t in enumerate(texts)]
    assert round_trip(spark, tokenizer, rows, 64, 32) == {i: t or "" for i, t in enumerate(texts)}


def test_slots_equal_a_plain_assignment(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, "", "ab" * rng.randrange(60)]), 0, 0, "f") for _ in range(90)] + [(7, "twice " * 9, 0, 0, "f")] * 2 + [(None, "x" * 30_000, 0, 0, "f")]
    docs = spark.createDataFrame(rows, SCHEMA)
    keys = {(r["doc_id"], r["t"]): r["k"] for r in docs.selectExpr("doc_id", "coalesce(text, '') AS t", "xxhash64(coalesce(string(doc_id), 'null'), coalesce(text, '')) AS k").collect()}
    size, key = 16, 5
    plain = []
    for i, t, *_ in sorted(rows, key=lambda r: keys[r[0], r[1] or ""]):
        tokens = [*(t or "").encode(), 256]
        plain += [(i, k // size, len(tokens[k : k + size]), (tokens[k : k + size] + [256] * size)[:size]) for k in range(0, len(tokens), size)]
    want = dict(zip(materialise.permute(np.arange(len(plain)), len(plain), key).tolist(), plain, strict=True))
    for parts in (1, 5):
        got = {}
        for r in materialise.materialise(docs.repartition(parts), None, key, size, 8).collect():
            data = np.frombuffer(r["payload"], "<u2").reshape(-1, size).tolist()
            got |= {r["first_slot"] + k: x for k, x in enumerate(zip(r["doc_ids"], r["seqs"], r["n_tokens"], data, strict=True))}
        assert got == want


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "same", 0, 0, "f")] * 3, SCHEMA)
    assert materialise.materialise(docs).first()["n_rows"] == 3
    assert materialise.materialise(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        materialise.materialise(docs, sequence_tokens=0)
