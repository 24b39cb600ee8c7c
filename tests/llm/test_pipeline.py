import random

import pytest

import corpus_pipeline
from tests.llm.test_decontaminate import brute as windows_hit
from tests.llm.test_secrets import brute as secret_spans
from tests.llm.test_toxicity import text
from tidewatch.llm import toxicity


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(7)
    rows = [text(rng, 4 if i % 3 == 0 else 0) for i in range(90)]
    bench = [(i, " ".join(f"item{i}word{k}" for k in range(14))) for i in range(3)]
    rows += [rows[1], rows[2] + " extra", rows[4].upper(), None, "", "short", "token=abcdefghijkl0 " + rows[5][:300], rows[7] + " " + bench[1][1], rows[8][:200] + " " + bench[0][1]]
    docs = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(rows)]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), docs, bench


def test_every_stage_on_what_the_one_before_kept(spark, tables):
    folder, rows, bench = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema = docs.schema
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "decontamination", "secrets", "packing"]

    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = [r for r in rows if model.score(r[1]) < 0.5]
    assert 0 < len(rows) - len(want) <= 35
    kept = stages["toxicity"](spark, docs, folder)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr)

    shingles = {r[0]: set(zip(*[r[1].lower().split()[k:] for k in range(5)], strict=False)) or {tuple(r[1].lower().split())} if r[1] and r[1].split() else {()} for r in want}
    root = {i: min(j for j in shingles if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])) for i in shingles}
    want = [r for r in want if root[r[0]] == r[0]]
    kept = stages["simhash"](spark, kept, folder)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in want}

    clean = {r[0] for r in windows_hit(want, bench, 10) if not r[-1]}
    assert 1 <= len(want) - len(clean) <= 2
    want = [r for r in want if r[0] in clean]
    kept = stages["decontamination"](spark, kept, folder)
    assert {r["doc_id"] for r in kept.collect()} == clean

    kept = stages["secrets"](spark, kept, folder)
    assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in schema]
    after = {r["doc_id"]: r for r in kept.collect()}
    masked = 0
    for doc_id, t, *_ in want:
        for _, s, e in reversed(secret_spans(t)):
            t, masked = t[:s] + "[SECRET]" + t[e:], masked + 1
        assert after[doc_id]["text"] == t and after[doc_id]["n_chars"] == (None if t is None else len(t))
    assert masked == 1 and len(after) == len(want)

    packed = stages["packing"](spark, kept, folder).collect()
    words = {i: len((r["text"] or "").split()) + 1 for i, r in after.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in packed} == words


def test_run_is_the_stages(spark, tables):
    folder, *_ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, docs.collect()))
