"""Rule R3: a trade id that is among the last N ids inserted for its stream is a duplicate.

The window is first-in first-out: a hit neither moves nor renews an id. Where no stream has more than N distinct ids
nothing is ever evicted; where every id's rows lie within N numbers of the order, fewer than N ids come between them. In
both cases a row is a duplicate exactly when it is not the first of its id. Beyond that the rule is recursive, since an
evicted id that returns is inserted anew; then every stream is replayed in order with a window of N ids as its only state.
Rows of equal order numbers follow each other by the columns ``ties``, so that which of them counts does not hang on how
rows are stored or dealt.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mark_first_seen(rows: DataFrame, keys: Sequence[str], id_col: str = "trade_id", order: str = "seq", out: str = "duplicate", among: str | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """The closed form, for streams of at most N distinct ids."""
    if among is None:
        return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys, id_col).orderBy(order, *ties)) > 1)
    w = Window.partitionBy(*keys, id_col, among).orderBy(order, *ties)
    return rows.withColumn(out, F.col(among) & (F.row_number().over(w) > 1))


def _stretches(columns: list[pa.Array], n: int) -> list[tuple[int, int]]:
    """Row ranges within which no key changes."""
    changed = np.zeros(max(0, n - 1), dtype=bool)
    for c in columns:
        changed |= pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), n]
    return list(pairwise(cuts))


def _replay(keys: list[int], id_at: int, among: int | None, window: int, out: str):
    def run(batches):
        stream, inserted, count = None, {}, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(k) for k in keys]
            ids = batch.column(id_at).to_pylist()
            counts = batch.column(among).to_pylist() if among is not None else [True] * n
            flags = [False] * n
            for start, end in _stretches(columns, n):
                name = tuple(c[start].as_py() for c in columns)
                if name != stream:
                    stream, inserted, count = name, {}, 0
                for i in range(start, end):
                    if not counts[i]:
                        continue
                    trade = ids[i]
                    at = inserted.get(trade)
                    if at is not None and count - at < window:
                        flags[i] = True
                        continue
                    count += 1
                    inserted[trade] = count
                if len(inserted) > 2 * window + 1024:
                    inserted = {t: a for t, a in inserted.items() if count - a < window}
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flags, pa.bool_())], names=[*batch.schema.names, out])

    return run


def mark_fifo(rows: DataFrame, keys: Sequence[str], window: int, id_col: str = "trade_id", order: str = "seq", out: str = "duplicate", among: str | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """The general form: one pass over each stream in order, batch by batch, holding at most two windows of ids and those of a batch."""
    cols = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.BooleanType())])
    lined = rows.repartition(*keys).sortWithinPartitions(*keys, order, *ties)
    return lined.mapInArrow(_replay([cols.index(k) for k in keys], cols.index(id_col), cols.index(among) if among else None, window, out), schema)


def reach(rows: DataFrame, keys: Sequence[str], id_col: str = "trade_id", order: str = "seq") -> tuple[int, int | None]:
    """Distinct ids of the stream that has most, and the largest distance between two rows of an id where ``order`` counts in whole numbers."""
    whole = isinstance(rows.schema[order].dataType, T.IntegralType)
    span = (F.max(order) - F.min(order)) if whole else F.lit(None)
    each = rows.groupBy(*keys, id_col).agg(span.cast("long").alias("span"))
    ids, farthest = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("ids"), F.max("span").alias("span")).agg(F.max("ids"), F.max("span")).first()
    return ids or 0, farthest


def mark_duplicates(rows: DataFrame, keys: Sequence[str], window: int, id_col: str = "trade_id", order: str = "seq", out: str = "duplicate", among: str | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Take the closed form where it is exact, as ``reach`` decides, and the general form elsewhere.

    ``among`` names a boolean column: only rows where it is true count, others are never duplicates.
    """
    ids, farthest = reach(rows.where(F.col(among)) if among else rows, keys, id_col, order)
    if ids <= window or (farthest is not None and farthest < window):
        return mark_first_seen(rows, keys, id_col, order, out, among, ties)
    return mark_fifo(rows, keys, window, id_col, order, out, among, ties)
