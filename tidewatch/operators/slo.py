"""What has to hold of every bar, and the experiment that shows the gate makes it hold."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.digests import bars_digest
from tidewatch.operators import bars as B
from tidewatch.operators.config import Rules
from tidewatch.operators.gate import evaluate

INVARIANTS = ("high_ge_low", "open_in_range", "close_in_range", "volume_positive", "price_positive", "monotone_time", "no_quarantinable")


def violations(bars: DataFrame, order: str | None = None) -> DataFrame:
    """exchange, symbol, bar_start_ms, invariant, detail: one row for every broken invariant.

    ``order`` names a column with the order in which bars were given; without it they are in order of time.
    """
    w = Window.partitionBy("exchange", "symbol").orderBy(order or "bar_start_ms")
    c = F.col
    broken = {
        "high_ge_low": c("high") < c("low"),
        "open_in_range": ~c("bar_open").between(c("low"), c("high")),
        "close_in_range": ~c("bar_close").between(c("low"), c("high")),
        "volume_positive": c("volume") <= 0,
        "price_positive": c("low") <= 0,
        "monotone_time": c("bar_start_ms") <= c("_before"),
        "no_quarantinable": c("tainted") > 0,
    }
    checked = bars.withColumn("_before", F.lag("bar_start_ms").over(w)) if order else bars.withColumn("_before", F.lit(None).cast("long"))
    found = F.array_compact(F.array(*[F.when(broken[i], F.lit(i)) for i in INVARIANTS]))
    rows = checked.select(*B.BAR_KEY, "bar_open", "high", "low", "bar_close", "volume", "tainted", F.explode(found).alias("invariant"))
    detail = F.to_json(F.struct("bar_open", "high", "low", "bar_close", "volume", "tainted"))
    return rows.select(*B.BAR_KEY, "invariant", detail.alias("detail"))


def rollup(bars: DataFrame, order: str | None = None) -> DataFrame:
    """One row: n_bars, n_violations, violated_bars and the count of every invariant, zeros included."""
    found = violations(bars, order)
    counts = found.agg(
        F.count(F.lit(1)).alias("n_violations"), F.count_distinct(F.struct(*B.BAR_KEY)).alias("violated_bars"), *[F.count_if(F.col("invariant") == i).alias(i) for i in INVARIANTS]
    )
    return bars.agg(F.count(F.lit(1)).alias("n_bars")).crossJoin(counts)


@dataclass(frozen=True)
class Comparison:
    """Bars with the gates on and off, over the same rows."""

    on: dict[str, int]
    off: dict[str, int]
    on_digest: str
    expected_digest: str
    label: str = ""

    @property
    def bit_identical(self) -> bool:
        return self.on_digest == self.expected_digest

    @property
    def thesis_holds(self) -> bool:
        return self.on["n_violations"] == 0 and self.off["n_violations"] > 0 and self.bit_identical

    def as_dict(self) -> dict:
        return asdict(self) | {"bit_identical": self.bit_identical, "thesis_holds": self.thesis_holds}


def expected_bars(trades: DataFrame, manifest: DataFrame) -> DataFrame:
    """Bars of what the manifest says is valid, without the faults that are designed to be missed."""
    known = manifest.select(F.col("index").alias("seq"), "expected_disposition", (F.col("is_fault") & ~F.col("detectable")).alias("missed"))
    kept = trades.join(known, "seq", "left").where(F.coalesce(F.col("expected_disposition") == "valid", F.lit(True)) & ~F.coalesce("missed", F.lit(False)))
    return B.build(kept.where(~F.coalesce("malformed", F.lit(False))) if "malformed" in trades.columns else kept)


def experiment(trades: DataFrame, manifest: DataFrame, rules: Rules | None = None, label: str = "") -> Comparison:
    """Both arms over all rows; and, without the faults no gate can catch, the gate's bars against the ground truth.

    The gate runs twice: leaving out rows changes what the window of ids has seen.
    """
    verdicts = evaluate(trades, rules, divergences=False).cache()
    on, off = (rollup(f(verdicts)).first().asDict() for f in (B.gates_on, B.gates_off))
    verdicts.unpersist()
    missed = manifest.where("is_fault AND NOT detectable").select(F.col("index").alias("seq"))
    catchable = trades.join(missed, "seq", "left_anti")
    return Comparison(on, off, bars_digest(B.gates_on(evaluate(catchable, rules, divergences=False))), bars_digest(expected_bars(trades, manifest)), label)


def fixture_label(name: str, frames: int, seed: int, window: int, tolerance_ms: int) -> str:
    return f"{name}: {frames:,} frames, seed {seed}, LRU {window:,}, tolerance {tolerance_ms} ms"


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
