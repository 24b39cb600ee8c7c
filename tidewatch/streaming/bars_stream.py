"""Bars of a stream of valid trades: a bar is written when the watermark has passed its end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import BAR_MS, from_micros, to_micros
from tidewatch.sources.files import BarTable


def bar_stream(trades: DataFrame, delay: str = "1 minute", width_ms: int = BAR_MS) -> DataFrame:
    """Closed bars. Late trades were labelled before they came here; the delay only says how long a bar stays open."""
    timed = trades.withColumn("at", F.timestamp_millis("ts_event")).withWatermark("at", delay)
    cut = timed.groupBy("exchange", "symbol", F.window("at", f"{width_ms} milliseconds").alias("w"))
    bars = cut.agg(
        F.min_by("price", F.struct("ts_event", "trade_id", "seq")).alias("bar_open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", F.struct(F.col("ts_event"), F.col("trade_id"), -F.col("seq"))).alias("bar_close"),
        from_micros(F.sum(to_micros("size"))).alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.lit(0).cast("long").alias("tainted"),
    )
    return bars.select("exchange", "symbol", F.unix_millis("w.start").alias("bar_start_ms"), "bar_open", "high", "low", "bar_close", "volume", "trade_count", "tainted")


def start(trades: DataFrame, table: BarTable, checkpoint: str, delay: str = "1 minute", available_now: bool = True):
    """Write bars before the progress of their batch is committed: a crash repeats a batch, and a repeated one replaces itself."""
    writer = bar_stream(trades, delay).writeStream.outputMode("append").foreachBatch(table.append).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
