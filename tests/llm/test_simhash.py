import random

import numpy as np
import pytest
import xxhash

from tidewatch.llm import simhash
from tidewatch.llm.common import components, forest

SCHEMA = "doc_id long, text string, lang string, fp string"


def plain_fingerprint(text):
    words = []
    word = ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64(" ".join(words[i : i + 4]).encode(), 42).intdigest() for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def classes(pairs):
    """Smallest id reachable, by brute force over all pairs of (id, fp)."""
    root = {i: i for i, _ in pairs}
    changed = True
    while changed:
        changed = False
        for i, x in pairs:
            for j, y in pairs:
                if bin(x ^ y).count("1") <= 4 and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def near(value, bits, rng):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


def test_fingerprint_matches_plain():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "One", "a b c", "a b c d", "Ä É straße\x0bÀ b c d e", "x " * 5000, "  a b c d e f"]
    texts += [" ".join(rng.choice("ab cd Ef gh ij".split()) for _ in range(rng.randrange(40))) for _ in range(50)]
    for text in texts:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_bit_planes_find_all_close_pairs():
    rng = random.Random(2)
    for n in (1, 2, 63, 64, 65, 300):
        base = [rng.getrandbits(64) for _ in range(6)]
        fps = np.array([near(rng.choice(base), rng.randrange(7), rng) for _ in range(n)], dtype=np.uint64)
        bucket = np.sort(np.array([rng.randrange(3) for _ in range(n)]))
        node = np.array(rng.sample(range(10 * n), n))
        got = simhash.bucket_forest(bucket, fps, node)
        pairs = [(i, j) for i in range(n) for j in range(i) if bucket[i] == bucket[j] and bin(int(fps[i]) ^ int(fps[j])).count("1") <= 4]
        want = forest(node[[i for i, _ in pairs]], node[[j for _, j in pairs]])
        assert dict(zip(*map(list, got), strict=True)) == dict(zip(*map(list, want), strict=True))


def test_links_equal_brute_force_with_split_buckets(spark):
    rng = random.Random(3)
    fps = list({near(x, rng.randrange(6), rng) for x in [rng.getrandbits(64) for _ in range(5)] for _ in range(30)})
    rows = [(i * 7, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(fps)]
    prints = spark.createDataFrame(rows, "node long, fp long")
    want = classes([(i * 7, fp) for i, fp in enumerate(fps)])
    for block in (4096, 8):
        got = {r["node"]: r["root"] for r in components(simhash.link_fingerprints(prints, block=block)).collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_near_duplicates(spark):
    rng = random.Random(4)
    vocab = [f"word{k}" for k in range(500)]
    texts = []
    for _ in range(12):
        words = [rng.choice(vocab) for _ in range(200)]
        texts += [" ".join(words)] * 2 + [" ".join(words[:-1] + ["other"]), " ".join(words).upper()]
    texts += [None, "", "  ", "solo", "solo"]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i + 5, t, "en", "mine") for i, t in enumerate(texts)], SCHEMA)
    out = simhash.near_duplicates(docs).collect()
    want = classes([(i + 5, plain_fingerprint(t)) for i, t in enumerate(texts)])
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert all(r["fingerprint"] == f"{plain_fingerprint(texts[r['doc_id'] - 5]):016x}" for r in out)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "x", "y"), (1, "a b c d e", "x", "y"), (1, None, "x", "y"), (0, "a b c d e", "x", "y")], SCHEMA)
    assert sorted(r["component_id"] for r in simhash.near_duplicates(docs).collect()) == [0, 0, 0, 1]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_an_id_that_repeats_keeps_what_its_texts_deserve(spark):
    docs = spark.createDataFrame([(0, "a b c d e", "x", "y"), (1, "a b c d e", "x", "y"), (1, "quite other words here", "x", "y")], SCHEMA)
    assert sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect()) == [(0, "a b c d e"), (1, "quite other words here")]


@pytest.mark.parametrize("by", [simhash.classes, simhash.similar])
def test_no_two_equal_texts_stay(spark, by):
    same, other = "one two three four five six seven", "quite other words are here as well"
    rows = [(1, same, "x", "y"), (1, same, "x", "z"), (None, same, "x", "y"), (None, same, "x", "y"), (None, other, "p", None), (None, other, "q", None), (4, other, "x", "y"), (5, None, "x", "y"), (6, "", "x", "y"), (6, " ", "x", "y")]
    out = simhash.keep_one(spark.createDataFrame(rows, SCHEMA), by=by).collect()
    assert sorted((r["doc_id"] or 0, (r["text"] or "").strip()) for r in out) == [(0, same), (0, other), (5, "")]


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e", "x", None), (2**60 + 1, "a b c d e", None, "y"), (2**60, "other words here now", "x", "y")], SCHEMA)
    out = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert out == {(None, None), (2**60 + 1, None), (2**60, 2**60)}
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == {None, 2**60}


def test_components_on_a_long_chain(spark):
    rng = random.Random(5)
    ids = rng.sample(range(10_000), 300)
    links = [(a, b) for a, b in zip(ids, ids[1:], strict=False)]
    rng.shuffle(links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == {i: min(ids) for i in ids if i != min(ids)}


def test_similar_documents(spark):
    rng = random.Random(6)
    vocab = [f"w{k}" for k in range(3000)]
    texts, group = [], []
    for g in range(150):
        words = [rng.choice(vocab) for _ in range(300)]
        for edits in (0, 0, 3, 6):
            copy = list(words)
            for at in rng.sample(range(300), edits):
                copy[at] = rng.choice(vocab)
            texts.append(" ".join(copy))
            group.append(g)
        half = words[:150] + [rng.choice(vocab) for _ in range(150)]
        texts.append(" ".join(half))  # a third in common: no copy
        group.append(1000 + g)
    texts += [None, "", "short", "short"]
    group += [5000, 5000, 5001, 5001]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    for block in (4096, 20):
        out = {r["doc_id"]: r["component_id"] for r in simhash.similar(docs, block=block).collect()}
        first = {}
        for i, g in enumerate(group):
            first.setdefault(g, i)
        wrong = sum(out[i] != first[g] for i, g in enumerate(group))
        assert wrong <= 5, wrong
    assert simhash.keep_one(docs, by=simhash.similar).count() <= 305 and simhash.similar(docs.limit(0)).count() == 0


def test_similar_links_by_the_similarity_of_sets(spark):
    """Repeated lines raise the cosine of multisets, not the similarity of sets; texts of 0.65 are no copies, and those of 0.8 are."""
    rng = random.Random(8)

    def fresh(n):
        return ["v" + str(rng.randrange(10**9)) for _ in range(n)]

    line = fresh(10)
    texts = [" ".join(line * 40 + fresh(200)) for _ in range(2)]
    for _ in range(60):
        words = fresh(104)
        texts += [" ".join(words), " ".join(words[:82] + fresh(22))]  # 78 of 122 shingles in common
    far = len(texts)
    for _ in range(60):
        words = fresh(304)
        texts += [" ".join(words), " ".join(words[:272] + fresh(32))]  # 268 of 332 shingles
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    out = {r["doc_id"]: r["component_id"] for r in simhash.similar(docs).collect()}
    assert all(out[i] == i for i in range(far))
    assert sum(out[i + 1] != i for i in range(far, len(texts), 2)) <= 2
