"""Running aggregates over long streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, by: Sequence[str], order: str, outputs: dict[str, tuple[str, Column]], inclusive: bool = True, chunk: int | None = None) -> DataFrame:
    """Add running aggregates in ``order`` for each ``by`` group: kinds ``max``, ``sum`` and ``last`` (the last non-null).

    Without ``chunk`` a group is one sorted window, which suits many streams. With it, stretches of ``chunk`` order
    numbers are aggregated on their own, a window over these few rows carries what went before each stretch, and the rows
    are windowed within their stretch only: one stream then spreads over as many tasks as it has stretches. Both steps
    read one shuffle by stretch, so that ``df`` is computed once.
    """
    end = 0 if inclusive else -1
    whole = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    if chunk is None:
        return df.withColumns({name: _over(kind, value, whole) for name, (kind, value) in outputs.items()})
    group = [*by, "_stretch"]
    cut = df.withColumn("_stretch", F.floor(F.col(order) / chunk)).repartition(*group)
    totals = []
    for name, (kind, value) in outputs.items():
        agg = {"max": F.max(value), "sum": F.sum(value), "last": F.max_by(value, F.when(value.isNotNull(), F.col(order)))}[kind]
        totals.append(agg.alias(f"_{name}"))
    before = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.groupBy(*group).agg(*totals).select(*group, *[_over(kind, F.col(f"_{name}"), before).alias(f"_{name}") for name, (kind, _) in outputs.items()])
    inside = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    joined = cut.join(carried, group)
    merged = {}
    for name, (kind, value) in outputs.items():
        own, past = _over(kind, value, inside), F.col(f"_{name}")
        if kind == "max":
            merged[name] = F.greatest(own, past)
        elif kind == "sum":
            merged[name] = F.when(own.isNull() & past.isNull(), None).otherwise(F.coalesce(own, F.lit(0)) + F.coalesce(past, F.lit(0)))
        else:
            merged[name] = F.coalesce(own, past)
    return joined.withColumns(merged).drop("_stretch", *[f"_{n}" for n in outputs])


def _over(kind: str, value: Column, window) -> Column:
    if kind == "last":
        return F.last(value, ignorenulls=True).over(window)
    return {"max": F.max, "sum": F.sum}[kind](value).over(window)
