"""Sharding by rendezvous hashing: every record picks, of all shards, the one with the best weighted score for its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut, order_key, ranked, text_of

#: Hex digits of the digest that make the uniform draw: 52 bits, exact in a double.
DRAW_DIGITS = 13


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key``: the largest of weight / -ln(u), u drawn from the digest of key and shard number.

    A shard's score depends on no other shard, so a new shard takes rows only into itself and a removed one gives up
    only its own. Shards of weight 0 get nothing. Of equal scores the smaller shard number wins.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be non-negative and not all zero")
    scores = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            digest = F.md5(F.concat(key.cast("string"), F.lit(f":{shard}")).cast("binary"))
            draw = (F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**DRAW_DIGITS))
            scores.append(F.struct((F.lit(float(weight)) / -F.log(draw)).alias("score"), F.lit(-shard).alias("shard")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["shard"]).cast("int")


def shard_documents(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Give every row of ``docs`` a shard and a gapless slot in it.

    Returns doc_id, size (UTF-8 bytes + 1), text_crc32, law ('key'), shard, slot, grown_shard (the shard under the
    weights ``grown``; by default one more shard of the mean weight). Null texts count as empty, a null id is a key of
    its own ('null'). Rows that repeat an id share its shard and get different slots; among rows alike in all columns
    used it is open which gets which. An empty table gives an empty result. Other columns are ignored.
    """
    weights = [float(w) for w in weights]
    grown = [*weights, sum(weights) / len(weights)] if grown is None else grown
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    text = text_of(text_col)
    rows = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            rendezvous(key, weights).alias("shard"),
            rendezvous(key, grown).alias("grown_shard"),
            order_key(key).alias("_key"),
        ),
        "sharded",
    )
    out = ranked(rows, ["shard"], "_key", ["doc_id", "text_crc32", "size"], "slot", rows.count())
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
