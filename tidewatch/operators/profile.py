"""A profile of a captured feed: what each stream holds, and whether it is alive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.windows import running

SKEW_MS, SAMPLES = 60_000, 3


def stream_stats(trades: DataFrame, keys: Sequence[str] = ("exchange", "symbol"), skew_ms: int = SKEW_MS, samples: int = SAMPLES, chunk: int | None = None) -> DataFrame:
    """One row for every stream: counts of rows, of unique, repeated and missing ids, range of event times, largest
    distance to the time of receipt and rows within the bound, rows before the stream's latest time, first rows."""
    missing = F.coalesce(F.col("trade_id") == "", F.lit(True))
    again = F.row_number().over(Window.partitionBy(*keys, "trade_id").orderBy("seq")) > 1
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("seq"))
    skew = F.abs(F.col("ts_event") - F.col("ts_ingest"))
    rows = running(trades, keys, "seq", {"_latest": ("max", F.col("ts_event"))}, inclusive=False, chunk=chunk)
    rows = rows.withColumns({"_again": again & ~missing, "_missing": missing, "_skew": skew})
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(F.when(~F.col("_missing"), F.col("trade_id"))).alias("unique_ids"),
        F.count_if("_again").alias("duplicate_ids"),
        F.count_if("_missing").alias("missing_ids"),
        F.min("ts_event").alias("first_ms"),
        F.max("ts_event").alias("last_ms"),
        F.max("_skew").alias("max_skew_ms"),
        F.count_if(F.col("_skew") <= skew_ms).alias("within_skew"),
        F.count_if(F.col("ts_event") < F.col("_latest")).alias("out_of_order"),
    )
    first = trades.withColumn("_nth", nth).where(F.col("_nth") <= samples).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", "trade_id", "price", "size", "ts_event"))).alias("samples"))
    return stats.join(first, list(keys), "left")


def liveness(trades: DataFrame, expected: DataFrame, checksum_ok: bool = True) -> DataFrame:
    """exchange, symbol, n, floor, alive: every expected stream, those without rows included. ``expected`` has exchange, symbol, floor."""
    counts = trades.groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("n"))
    out = F.broadcast(expected).join(counts, ["exchange", "symbol"], "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return out.select("exchange", "symbol", n.alias("n"), "floor", ((n >= F.col("floor")) & F.lit(checksum_ok)).alias("alive"))


def gate_passes(checked: DataFrame) -> bool:
    return bool(checked.agg(F.coalesce(F.bool_and("alive"), F.lit(False))).first()[0])


def render(stats: DataFrame) -> str:
    """A text table of the statistics, a line for each stream."""
    cols = ["exchange", "symbol", "n", "unique_ids", "duplicate_ids", "missing_ids", "out_of_order", "max_skew_ms", "within_skew"]
    rows = [[str(r[c]) for c in cols] for r in stats.orderBy("exchange", "symbol").select(*cols).toLocalIterator()]
    widths = [max(len(x[i]) for x in [cols, *rows]) for i in range(len(cols))]
    return "\n".join("  ".join(v.ljust(w) for v, w in zip(line, widths, strict=True)).rstrip() for line in [cols, *rows])
