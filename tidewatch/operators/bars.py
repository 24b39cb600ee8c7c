"""One-minute bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import BAR_MS, bar_start, from_micros, to_micros

BAR_KEY = ("exchange", "symbol", "bar_start_ms")


def build(trades: DataFrame, tainted: Column | None = None, width_ms: int = BAR_MS) -> DataFrame:
    """exchange, symbol, bar_start_ms, bar_open, high, low, bar_close, volume, trade_count, tainted.

    Open and close are the first and last of event time, then trade id as text; on equal ones the first arrival gives
    both. Volumes add up as integers, so nothing depends on the order of rows, and all of it is combined before the shuffle.
    """
    tainted = F.lit(False) if tainted is None else tainted
    cut = trades.select("exchange", "symbol", bar_start("ts_event", width_ms).alias("bar_start_ms"), "price", "size", "ts_event", "trade_id", "seq", tainted.alias("tainted"))
    return cut.groupBy(*BAR_KEY).agg(
        F.min_by("price", F.struct("ts_event", "trade_id", "seq")).alias("bar_open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", F.struct(F.col("ts_event"), F.col("trade_id"), -F.col("seq"))).alias("bar_close"),
        from_micros(F.sum(to_micros("size"))).alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.count_if("tainted").alias("tainted"),
    )


def canonical(bars: DataFrame) -> DataFrame:
    return bars.orderBy(*BAR_KEY)


def gates_on(verdicts: DataFrame) -> DataFrame:
    """Bars of valid rows."""
    return build(verdicts.where(F.col("disposition") == "valid").select("seq", "record.*"))


def gates_off(verdicts: DataFrame) -> DataFrame:
    """Bars of all rows that decode; rejected ones taint theirs."""
    rows = verdicts.where(F.col("record").isNotNull()).select("seq", "record.*", (F.col("disposition") == "quarantine").alias("rejected"))
    return build(rows, F.col("rejected"))
