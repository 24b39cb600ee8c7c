import random
from collections import defaultdict
from itertools import combinations

from tidewatch.llm import packing


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(60):
        lengths = rng.sample(range(1, 60), rng.randrange(1, 9))
        counts = [rng.randrange(1, 50) for _ in lengths]
        buckets = rng.randrange(1, 6)
        got = packing.best_boundaries(lengths, counts, buckets)
        top = max(lengths)
        options = [(*c, top) for k in range(min(buckets, len(lengths))) for c in combinations(sorted(lengths)[:-1], k)]
        assert got == sorted(got) and len(got) <= buckets and got[-1] == top
        assert padding(lengths, counts, got) == min(padding(lengths, counts, o) for o in options)
    assert packing.best_boundaries([], [], 4) == []


def test_batches(spark):
    rng = random.Random(2)
    texts = [None, "", " \n "] + ["w " * rng.randrange(1, 400) for _ in range(300)] + ["w " * 100] * 50
    docs = spark.createDataFrame([(i % 340, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, bucket int, row int")
    out = packing.pack(docs, max_tokens=128, buckets=4, token_budget=600).collect()
    want = defaultdict(int)
    for i, t in enumerate(texts):
        want[i % 340] += len((t or "").split()) + 1
    got = defaultdict(int)
    batches = defaultdict(list)
    for r in out:
        got[r["doc_id"]] += r["n_tokens"]
        assert r["n_tokens"] <= r["boundary"] <= 128 and r["first_token"] == 128 * r["piece"]
        batches[r["bucket"], r["batch"]].append(r)
    assert got == want
    last = defaultdict(int)
    for bucket, batch in batches:
        last[bucket] = max(last[bucket], batch)
    for (bucket, batch), rows in batches.items():
        room = max(1, 600 // rows[0]["boundary"])
        assert sorted(r["row"] for r in rows) == list(range(len(rows))) and len(rows) <= room
        assert len(rows) == room or batch == last[bucket]
    assert packing.pack(docs.limit(0)).count() == 0
