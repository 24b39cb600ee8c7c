"""The gate: every trade gets a verdict, and verdicts are routed, counted and put into envelopes.

Rules run in order and the first failure labels a row: R1 schema, R2 range, R3 duplicate, R4 out of order. Rows that pass
are valid; they advance their stream's watermark and may carry alerts, R5 gap and R6 divergence between venues. All of it
is column expressions and windows; only R3 beyond its window's size replays streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.codec import NAMES
from tidewatch.functions.scalars import stream_name
from tidewatch.operators.config import Rules
from tidewatch.operators.dedup import mark_duplicates
from tidewatch.operators.windows import running

KEYS = ("exchange", "symbol")
#: Streams that failed rows are dealt to.
SPREAD = 4096
ALERTS = "array<struct<rule_id:string,reason:string,stream:string,detail:string,at_event_ms:bigint>>"


def range_failure(rules: Rules, price: Column | None = None, size: Column | None = None, symbol: Column | None = None) -> Column:
    """What R2 finds wrong, the first of price, size and bounds; null if nothing. NaN and null are out of range too."""
    price, size, symbol = F.col("price") if price is None else price, F.col("size") if size is None else size, F.col("symbol") if symbol is None else symbol
    low, high = (reduce(lambda c, x: c.when(symbol == x[0], F.lit(x[1][k])), sorted(rules.symbol_bounds.items()), F.when(F.lit(False), F.lit(0.0))) for k in (0, 1))
    no_number = lambda c: c.isNull() | F.isnan(c)
    return (
        F.when(no_number(price) | (price <= rules.price_min), F.lit("price is not above the minimum"))
        .when(no_number(size) | (size <= rules.size_min), F.lit("size is not above the minimum"))
        .when(low.isNotNull() & ~price.between(low, high), F.lit("price is outside the symbol's bounds"))
    )


def watermarks(accepted: DataFrame, keys: Sequence[str] = KEYS, chunk: int | None = None) -> DataFrame:
    """Add ``watermark``: the largest event time of the stream before each row, null for the first."""
    return running(accepted, keys, "seq", {"watermark": ("max", F.col("ts_event"))}, inclusive=False, chunk=chunk)


def late(rules: Rules) -> Column:
    """R4: more than the tolerance before the watermark."""
    return F.coalesce(F.col("ts_event") < F.col("watermark") - rules.tolerance_ms, F.lit(False))


def gap(rules: Rules) -> Column:
    """R5: more than the threshold after the watermark."""
    return F.coalesce(F.col("ts_event") - F.col("watermark") > rules.gap_ms, F.lit(False))


def last_prints(accepted: DataFrame, rules: Rules, chunk: int | None = None, symbol: str = "symbol") -> DataFrame:
    """Add price_0, ts_0, fresh_0 and the same with 1: each venue's last print of the symbol, in order of arrival, and whether it counts.

    A print counts while the row's event time is at most the staleness bound after it. With a column ``accepted`` rows
    where it is false print nothing.
    """
    counts = F.col("accepted") if "accepted" in accepted.columns else F.lit(True)
    outputs = {f"print_{k}": ("last", F.when(counts & (F.col("exchange") == venue), F.struct("price", "ts_event"))) for k, venue in enumerate(rules.venues)}
    out = running(accepted, [symbol], "seq", outputs, chunk=chunk)
    for k in (0, 1):
        p = F.col(f"print_{k}")
        fresh = p.isNotNull() & (F.col("ts_event") - p["ts_event"] <= rules.staleness_ms)
        out = out.withColumns({f"price_{k}": p["price"], f"ts_{k}": p["ts_event"], f"fresh_{k}": fresh}).drop(f"print_{k}")
    return out


def divergence(accepted: DataFrame, rules: Rules, chunk: int | None = None, symbol: str = "symbol") -> DataFrame:
    """Add the fresh_ columns, deviation_pct, over, episode, sustained and ``diverged`` (the R6 alert).

    An episode of a symbol begins after each comparable row within the limit. Rows that can't be compared leave it as it
    is. Its first row beyond the limit starts the clock; the first later one at which enough event time has gone by alerts.
    """
    prints = last_prints(accepted, rules, chunk, symbol)
    both = F.col("fresh_0") & F.col("fresh_1")
    if "accepted" in prints.columns:
        both = both & F.col("accepted")
    middle = (F.col("price_0") + F.col("price_1")) / F.lit(2.0)
    prints = prints.withColumn("deviation_pct", F.when(both, F.try_divide(F.abs(F.col("price_0") - F.col("price_1")), middle) * F.lit(100.0)))
    over = F.coalesce((F.col("deviation_pct") > rules.deviation_pct) & ~F.isnan("deviation_pct"), F.lit(False))
    prints = prints.withColumn("over", over)
    calm = (both & ~F.col("over")).cast("long")
    out = running(prints, [symbol], "seq", {"episode": ("sum", calm)}, chunk=chunk)
    of_episode = Window.partitionBy(symbol, "episode", "over").orderBy("seq")
    out = out.withColumn("_since", F.first("ts_event").over(of_episode)).withColumn("_nth", F.row_number().over(of_episode))
    out = out.withColumn("sustained", F.when(F.col("over") & (F.col("_nth") > 1), F.col("ts_event") - F.col("_since")))
    enough = F.coalesce(F.col("sustained") >= rules.sustained_ms, F.lit(False))
    first = F.sum(enough.cast("int")).over(of_episode.rowsBetween(Window.unboundedPreceding, 0)) == 1
    return out.withColumn("diverged", enough & first).drop("_since", "_nth")


def evaluate(trades: DataFrame, rules: Rules | None = None, keys: Sequence[str] = KEYS, chunk: int | None = None, divergences: bool = True) -> DataFrame:
    """The verdict of every row: seq, the other columns of ``trades`` that are no record fields, disposition, rule_id, reason, detail, record, alerts, stale (venues R6 found no fresh print of).

    ``trades`` has a unique ``seq`` in the order of arrival, the record's fields and, if frames were decoded,
    ``malformed``. Where rows of one id share a ``seq`` all the same, R3 lets the least record pass. An empty table gives
    no verdicts.
    """
    rules = rules or Rules()
    extra = [c for c in trades.columns if c not in (*NAMES, "seq", "malformed", "decode_error")]
    malformed = F.col("malformed") if "malformed" in trades.columns else F.lit(False)
    why = F.col("decode_error") if "decode_error" in trades.columns else F.lit("frame does not decode")
    early = F.when(malformed, F.lit("R1")).when(range_failure(rules).isNotNull(), F.lit("R2"))
    staged = trades.select("seq", *extra, *NAMES, early.alias("_early"), F.when(malformed, why).otherwise(range_failure(rules)).alias("_wrong"), early.isNull().alias("_passed"))
    # One line of windows over all rows. Rows that have failed count for nothing: they are spread over streams of their
    # own, since malformed ones have no key and could all meet in one task.
    spread = F.concat(F.lit("failed "), F.pmod(F.xxhash64("seq"), F.lit(SPREAD)).cast("string"))
    lines = {k: f"_line_{k}" for k in dict.fromkeys([*keys, "symbol"])}
    staged = staged.withColumns({line: F.when(F.col("_passed"), F.col(k)).otherwise(spread) for k, line in lines.items()})
    keys, names, symbol = [lines[k] for k in keys], keys, lines["symbol"]
    rows = mark_duplicates(staged, keys, rules.dedup_window, among="_passed", out="_again", ties=NAMES)
    if divergences and chunk is None and symbol in keys:
        rows = rows.repartition(symbol)  # serves the windows of the streams and of the symbols alike
    # R4 only fails rows below the watermark, so it is the running maximum of all that R1 to R3 let pass.
    kept = F.col("_passed") & ~F.col("_again")
    rows = running(rows, keys, "seq", {"watermark": ("max", F.when(kept, F.col("ts_event")))}, inclusive=False, chunk=chunk)
    rows = rows.withColumn("_late", kept & late(rules)).withColumn("accepted", kept & ~F.col("_late")).withColumn("_gap", F.col("accepted") & gap(rules))
    if divergences:
        rows = divergence(rows, rules, chunk, symbol)
    else:
        rows = rows.withColumns({"fresh_0": F.lit(True), "fresh_1": F.lit(True), "diverged": F.lit(False), "deviation_pct": F.lit(None).cast("double"), "sustained": F.lit(None).cast("long")})

    rule = F.when(~F.col("_passed"), F.col("_early")).when(F.col("_again"), F.lit("R3")).when(F.col("_late"), F.lit("R4"))
    reason = reduce(lambda c, r: c.when(F.col("rule_id") == r, F.lit(rules.reasons[r])), ("R1", "R2", "R3", "R4"), F.when(F.lit(False), F.lit("")))
    detail = (
        F.when(~F.col("_passed"), F.col("_wrong"))
        .when(F.col("_again"), F.concat(F.lit("trade id seen: "), F.col("trade_id")))
        .when(F.col("_late"), F.format_string("%d ms before the watermark", F.col("watermark") - F.col("ts_event")))
        .otherwise(F.lit(""))
    )

    def alert(rule_id: str, stream: Column, text: Column) -> Column:
        return F.struct(F.lit(rule_id).alias("rule_id"), F.lit(rules.reasons[rule_id]).alias("reason"), stream.alias("stream"), text.alias("detail"), F.col("ts_event").alias("at_event_ms"))

    jump = F.format_string("watermark jumped %d ms", F.col("ts_event") - F.col("watermark"))
    apart = F.format_string("venues %.4f%% apart for %d ms", F.col("deviation_pct"), F.col("sustained"))
    none = F.array().cast(ALERTS)
    alerts = F.array_compact(F.array(F.when(F.col("_gap"), alert("R5", stream_name(*names), jump)), F.when(F.col("diverged"), alert("R6", F.col("symbol"), apart)))).cast(ALERTS)
    stale = F.array_compact(F.array(*[F.when(F.col("accepted") & ~F.col(f"fresh_{k}"), F.lit(venue)) for k, venue in enumerate(rules.venues)]))
    out = rows.withColumn("rule_id", rule)
    return out.select(
        "seq", *extra, F.when(F.col("rule_id").isNull(), F.lit("valid")).otherwise(F.lit("quarantine")).alias("disposition"), "rule_id", reason.alias("reason"), detail.alias("detail"),
        F.when(F.coalesce(F.col("rule_id") != "R1", F.lit(True)), F.struct(*NAMES)).alias("record"), F.when(F.col("_gap") | F.col("diverged"), alerts).otherwise(none).alias("alerts"), stale.alias("stale"),
    )


def route(verdicts: DataFrame, gates_off: bool = False) -> Column:
    """'valid', 'quarantine', or null for what is dropped. With the gates off whatever decodes is valid and the rest dropped."""
    if gates_off:
        return F.when(F.col("record").isNotNull(), F.lit("valid"))
    return F.col("disposition")


def routed(verdicts: DataFrame, gates_off: bool = False) -> DataFrame:
    return verdicts.withColumn("route", route(verdicts, gates_off)).where(F.col("route").isNotNull())


def telemetry(verdicts: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One row of counters: n_valid, quarantined by rule, gap and divergence alerts, rows without a fresh print by venue."""
    rules = rules or Rules()
    has = lambda rule: F.exists("alerts", lambda a: a["rule_id"] == rule)
    return verdicts.agg(
        F.count_if(F.col("disposition") == "valid").alias("n_valid"),
        *[F.count_if(F.col("rule_id") == r).alias(f"quarantined_{r.lower()}") for r in ("R1", "R2", "R3", "R4")],
        F.count_if(has("R5")).alias("gap_alerts"),
        F.count_if(has("R6")).alias("divergence_alerts"),
        *[F.count_if(F.array_contains("stale", v)).alias(f"stale_{v}") for v in rules.venues],
    )


def envelopes(verdicts: DataFrame) -> DataFrame:
    """The quarantine message of every rejected row: key, value (JSON) and its fields. ``verdicts`` carries value, partition and offset of the frame."""
    bad = verdicts.where(F.col("disposition") == "quarantine")
    by_digest = F.concat(F.lit("sha256:"), F.sha2("value", 256))
    key = F.when(F.col("offset").isNull(), by_digest).otherwise(F.concat_ws(":", F.col("partition").cast("string"), F.col("offset").cast("string")))
    fields = bad.select(
        "seq", key.alias("key"), "rule_id", "reason", "detail", "offset", "partition", F.col("record.ts_ingest").alias("ts_ms"), F.base64("value").alias("raw_b64"),
    )
    body = F.to_json(F.struct("detail", "offset", "partition", "raw_b64", "reason", "rule_id", "ts_ms"), {"ignoreNullFields": "false"})
    return fields.withColumn("json", body)


def quarantine_stats(found: DataFrame) -> DataFrame:
    return found.groupBy("rule_id", "reason").agg(F.count(F.lit(1)).alias("n")).orderBy("rule_id")
