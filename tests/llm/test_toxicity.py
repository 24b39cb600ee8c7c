import math
import pickle
import random
import zlib

import pytest
import zstandard

from tidewatch.llm import toxicity

BAD = ["grubbish", "nastoid", "vilefolk"]


def text(rng, bad):
    words = ["".join(rng.choice(["th", "er", "on", "an", "re", "at", "in", "st"]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(60, 160))]
    for _ in range(bad):
        words.insert(rng.randrange(len(words)), rng.choice(BAD))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    return [(i, text(rng, 3 if i % 4 == 0 else 0), int(i % 4 == 0)) for i in range(600)]


def test_held_out_accuracy(spark, corpus):
    docs = spark.createDataFrame([(i, t, "en", 0.0) for i, t, _ in corpus], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus] + [(5000, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    out = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [(out[i], y) for i, _, y in corpus if out[i]["held_out"]]
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in corpus)
    assert len(held) > 80 and sum(r["predicted"] == y for r, y in held) / len(held) > 0.97
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["score"] < 0.5}
    assert kept.limit(0).count() == 0


def test_held_out_rows_are_not_learnt_from(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus], "doc_id long, text string")
    labels = [(i, y) for i, _, y in corpus]
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert a == b


def test_edges(spark, corpus):
    model = toxicity.fit([t for _, t, _ in corpus[:200]], [y for *_, y in corpus[:200]])
    again = pickle.loads(pickle.dumps(model))
    for t in (None, "", " \n", "grubbish", "x" * 200_000, "é😀"):
        assert 0 <= model.score(t) <= 1 and again.score(t) == model.score(t)
    assert model.score(None) == model.score("") < 0.5
    for none in (toxicity.fit([], []), toxicity.fit(["a", "b"], [0, 0]), toxicity.fit([None], [1])):
        assert 0 <= none.score("any text at all") <= 1
    docs = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "doc_id long, text string")
    assert toxicity.score(docs, model).count() == 3 and toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.train(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).score("x") <= 1


def test_words_that_ordinary_texts_hold_too_but_rarely(spark):
    """A word start that is in every toxic text of one language, often, and once in an eighth of the ordinary ones; its end is common to both."""
    rng = random.Random(3)
    rows = []
    for i in range(1200):
        syllables = ["keit", "lich", "ung", "ver", "ach", "en", "sch", "te"] if i % 3 == 0 else ["th", "er", "on", "an", "re", "at", "in", "st"]
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(250)]
        words = [w for w in words if not w.startswith("achlich")]
        toxic = int(i % 12 == 0)
        if i % 3 == 0:
            for _ in range(9 if toxic else int(rng.random() < 0.125)):
                words.insert(rng.randrange(len(words)), "achlich" + rng.choice(syllables))
        rows.append((i, " ".join(words), toxic))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    model = toxicity.fit([t for _, t, _ in known], [y for *_, y in known])
    hit = [model.score(t) >= 0.5 for _, t, y in held if y]
    wrong = [model.score(t) >= 0.5 for _, t, y in held if not y]
    assert len(hit) >= 10 and sum(hit) / len(hit) >= 0.9 and sum(wrong) / len(wrong) <= 0.02, (sum(hit), len(hit), sum(wrong), len(wrong))


def test_scores_equal_plain_compression(spark, corpus):
    model = toxicity.fit([t for _, t, _ in corpus[:200]], [y for *_, y in corpus[:200]])
    lengths = []
    for content in (model.dictionaries.ordinary, model.dictionaries.toxic):
        params = zstandard.ZstdCompressionParameters.from_level(
            -1, min_match=5, strategy=zstandard.STRATEGY_FAST, target_length=1, window_log=16, hash_log=16, chain_log=16, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        # a dictionary that is digested anew for each window
        lengths.append(lambda w, c=content, p=params: len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(c, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=p).compress(w)))

    def plain(text):
        t = toxicity.normalise(text)
        s = []
        for i in range(0, max(1, len(t)), 256):
            w = model.dictionaries.ordinary[-64:] + t[i : i + 272]
            s.append(lengths[0](w) - lengths[1](w))
        up, n, top = [max(x, 0) for x in s], max(1.0, len(t) / 256), sorted(s)[-3:]
        x = [math.log1p(sum(up)), math.log1p(sum(v >= 2 for v in s)), math.log1p(sum(v >= 4 for v in s)), min(top[-1], 8), sum(top) / len(top), sum(up) / n, sum(v >= 3 for v in s) / n, sum(s) / len(s), sum(v < 0 for v in s) / len(s)]
        return 1 / (1 + math.exp(-(sum((a - m) / d * w for a, m, d, w in zip(x, model.mean, model.scale, model.weights, strict=False)) + model.weights[-1])))

    rows = [(i, t) for i, t, _ in corpus[200:240]] + [(900, None), (901, ""), (902, "grubbish " * 900), (903, "é😀 x")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(abs(got[i] - plain(t)) < 1e-9 for i, t in rows) and len({round(v, 3) for v in got.values()}) > 5
