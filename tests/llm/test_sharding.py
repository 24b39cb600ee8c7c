import zlib
from collections import Counter

import pytest

from tidewatch.llm import sharding
from tidewatch.llm.common import ranked


def test_shards(spark):
    rows = [(i, f"text {i}" * (i % 5), "key", i) for i in range(2000)] + [(7, "text 7" * 2, "key", 1), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, law string, shard int")
    out = sharding.shard_documents(docs, [1.0] * 8).collect()
    assert len(out) == len(rows)
    for shard in range(8):
        mine = [r["slot"] for r in out if r["shard"] == shard]
        assert sorted(mine) == list(range(len(mine)))
        assert 170 < len(mine) < 340
    assert all(r["grown_shard"] in (r["shard"], 8) for r in out)
    assert 100 < sum(r["grown_shard"] == 8 for r in out) < 400
    by_id = {r["doc_id"]: r for r in out}
    for i, text, *_ in rows:
        body = (text or "").encode()
        assert (by_id[i]["size"], by_id[i]["text_crc32"]) == (len(body) + 1, zlib.crc32(body))
    assert len({r["shard"] for r in out if r["doc_id"] == 7}) == 1
    assert sharding.shard_documents(docs.limit(0), [1.0, 2.0]).count() == 0


def test_weights(spark):
    docs = spark.range(8000).selectExpr("id AS doc_id", "'x' AS text")
    counts = Counter(r["shard"] for r in sharding.shard_documents(docs, [1.0, 3.0, 0.0]).collect())
    assert set(counts) == {0, 1} and 2.6 < counts[1] / counts[0] < 3.4
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, [0.0])


def test_ranks_do_not_depend_on_the_slices(spark):
    df = spark.range(3000).selectExpr("id % 3 AS g", "md5(cast(id AS string)) AS k", "id")
    few = {r["id"]: r["n"] for r in ranked(df, ["g"], "k", ["id"], "n", 10).collect()}
    many = {r["id"]: r["n"] for r in ranked(df, ["g"], "k", ["id"], "n", 100_000_000).collect()}
    assert few == many
