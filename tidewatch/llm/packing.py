"""Packing: sequences go to the length buckets that minimise padding, and to batches of a fixed token budget in them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut, order_key, ranked, text_of

MAX_TOKENS = 2048
BUCKETS = 16
TOKEN_BUDGET = 65_536


def word_tokens(text: str | Column) -> Column:
    """Tokens of a text: its runs of characters other than ASCII white space, and one end mark."""
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")) + 1


def best_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """At most ``buckets`` upper bounds, ascending, that minimise the padding of the histogram; the last is its largest length.

    In each round best[j] is the least padding of the lengths up to j in k buckets; the last bucket holds those after some
    i and pads them to length j. The best i never falls as j grows, so each half of the j needs only a part of the i: n
    lengths take n log n steps a round and memory in proportion to n. Of equal solutions the one of fewest buckets, then
    of the smallest i, is taken.
    """
    order = np.argsort(lengths, kind="stable")
    size = np.asarray(lengths, dtype=np.int64)[order]
    rows = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64)[order])])
    tokens = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64)[order] * size)])
    n = len(size)
    if n == 0:
        return []

    def padding(i: np.ndarray, j: int) -> np.ndarray:
        """Of the lengths after the first i, up to and with number j (from 0), in one bucket."""
        return size[j] * (rows[j + 1] - rows[i]) - (tokens[j + 1] - tokens[i])

    best = np.array([int(padding(np.zeros(1, np.int64), j)[0]) for j in range(n)], dtype=np.int64)
    came, totals = [np.zeros(n, dtype=np.int64)], [int(best[-1])]
    for k in range(1, min(buckets, n)):
        last = best
        best, choice = np.full(n, np.iinfo(np.int64).max // 4, dtype=np.int64), np.zeros(n, dtype=np.int64)
        # k buckets before need k lengths at least
        todo = [(k, n - 1, k, n - 1)]
        while todo:
            low, high, least, most = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(least, min(most, j) + 1)
            through = last[i - 1] + padding(i, j)
            at = int(through.argmin())
            best[j], choice[j] = through[at], i[at]
            todo += [(low, j - 1, least, int(i[at])), (j + 1, high, int(i[at]), most)]
        came.append(choice)
        totals.append(int(best[-1]))
    k = int(np.argmin(totals))
    bounds, j = [], n - 1
    while k >= 0:
        bounds.append(int(size[j]))
        j = int(came[k][j]) - 1
        k -= 1
    return bounds[::-1]


def pack(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: Column | None = None,
) -> DataFrame:
    """Cut every document into pieces of up to ``max_tokens`` tokens and place each piece in a padded batch.

    Returns doc_id, piece, first_token, n_tokens, bucket, boundary (the padded length), batch, row: rows of a batch
    times boundary stay within ``token_budget`` (a bucket longer than the budget has batches of one row). All batches of
    a bucket but its last are full. ``tokens`` counts a document's tokens, by default words and an end mark, so that
    null and empty texts are pieces of one token. Rows that repeat an id are packed each. The histogram has at most
    ``max_tokens`` entries, whatever the corpus; an empty table gives an empty result. Other columns are ignored.
    """
    if min(max_tokens, buckets, token_budget) < 1:
        raise ValueError("max_tokens, buckets and token_budget must be at least 1")
    count = (word_tokens(text_col) if tokens is None else tokens).cast("long")
    counted = docs.select(F.col(id_col).alias("doc_id"), F.greatest(F.coalesce(count, F.lit(1)), F.lit(1)).alias("_all"))
    piece = F.explode(F.sequence(F.lit(0), F.expr(f"cast((_all - 1) div {int(max_tokens)} as int)")))
    pieces = cut(
        counted.select("doc_id", "_all", piece.alias("piece")).select(
            "doc_id",
            "piece",
            (F.col("piece").cast("long") * max_tokens).alias("first_token"),
            F.least(F.col("_all") - F.col("piece").cast("long") * max_tokens, F.lit(max_tokens)).cast("int").alias("n_tokens"),
        ),
        "pieces",
    )
    histogram = pieces.groupBy("n_tokens").count().collect()
    bounds = best_boundaries([r["n_tokens"] for r in histogram], [r["count"] for r in histogram], buckets)
    bucket, boundary, rows = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1)
    for k, bound in reversed(list(enumerate(bounds))):
        fits = F.col("n_tokens") <= bound
        bucket = F.when(fits, F.lit(k)).otherwise(bucket)
        boundary = F.when(fits, F.lit(bound)).otherwise(boundary)
        rows = F.when(fits, F.lit(max(1, token_budget // bound))).otherwise(rows)
    placed = pieces.select("*", bucket.alias("bucket"), boundary.alias("boundary"), rows.alias("_rows"), order_key("doc_id", "piece").alias("_key"))
    placed = ranked(placed, ["bucket"], "_key", ["doc_id", "piece", "n_tokens"], "_rank", sum(r["count"] for r in histogram))
    return placed.select(
        "doc_id", "piece", "first_token", "n_tokens", "bucket", "boundary", F.expr("_rank div _rows").alias("batch"), (F.col("_rank") % F.col("_rows")).cast("int").alias("row")
    )
