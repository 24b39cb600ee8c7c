"""The registered queries: every operator of the engine over the test tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import codec, scalars
from tidewatch.operators import bars, dedup, faultlab, gate, grade, profile, slo
from tidewatch.operators.windows import running
from tidewatch.plans.trades import LINEITEM_SQL, RULES, SQL, lineitem_trades, manifest, sql_bars, trades
from tidewatch.sources import feeds, files
from tidewatch.streaming import gate_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SMALL_WINDOW, STRETCH = 50, 1000
KEYS = ["exchange", "symbol"]


def query(sql: str | None = None, name: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return register


def _passed(spark, d):
    """Rows that R2 lets pass, as R3 sees them."""
    return trades(spark, d).where(gate.range_failure(RULES).isNull())


def _survivors(spark, d):
    rows = dedup.mark_first_seen(_passed(spark, d), KEYS)
    return rows.where(~F.col("duplicate"))


def _accepted(spark, d):
    return gate.watermarks(_survivors(spark, d)).where(~gate.late(RULES))


def _verdicts(spark, d):
    return gate.evaluate(trades(spark, d), RULES)


# Scalars and normalisation


@query("SELECT event_id, CASE WHEN lower(trim(s)) IN ('buy', 'sell') THEN lower(trim(s)) ELSE 'unknown' END AS side FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' Buy' WHEN 1 THEN 'SELL ' WHEN 2 THEN 'hold' ELSE event_type END AS s FROM events)")
def normalize_side(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    text = F.expr("CASE event_id % 4 WHEN 0 THEN ' Buy' WHEN 1 THEN 'SELL ' WHEN 2 THEN 'hold' ELSE event_type END")
    return e.select("event_id", scalars.normalise_side(text).alias("side"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS millis FROM events")
def iso_millis(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    text = F.concat(F.lit(" "), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z "))
    return e.select("event_id", scalars.iso_millis(text).alias("millis"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'BTC-USD' WHEN 1 THEN 'ETH-USD' ELSE 'DOGE/USD' END AS canonical, CASE event_id % 3 WHEN 0 THEN 'BTC/USD' WHEN 1 THEN 'ETH/USD' ELSE 'DOGE/USD' END AS venue FROM events")
def symbol_map(spark, d):
    s = F.expr("CASE event_id % 3 WHEN 0 THEN 'BTC/USD' WHEN 1 THEN 'ETH/USD' ELSE 'DOGE/USD' END")
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", scalars.canonical_symbol(s).alias("canonical"))
    return e.withColumn("venue", scalars.venue_symbol("canonical"))


@query(SQL + "SELECT seq, (ts_event - 1704067200000) - ((((ts_event - 1704067200000) % 60000) + 60000) % 60000) AS bar_start_ms FROM (SELECT seq, ts_event - 5000000 AS ts_event FROM trades)")
def bar_bucket(spark, d):
    shifted = F.col("ts_event") - F.lit(1704067200000 + 5_000_000)
    return trades(spark, d).select("seq", scalars.bar_start(shifted).alias("bar_start_ms"))


@query(SQL + "SELECT seq, round_even(size * 1000000 / 8, 0)::BIGINT AS micros, greatest(0.2::DOUBLE, least(0.7::DOUBLE, size)) AS clamped FROM trades")
def rounding_and_clamp(spark, d):
    return trades(spark, d).select("seq", scalars.to_micros(F.col("size") / 8).alias("micros"), scalars.clamp("size", 0.2, 0.7).alias("clamped"))


@query(SQL + "SELECT seq, exchange || '|' || symbol || '|' || trade_id AS key FROM trades")
def message_key(spark, d):
    return trades(spark, d).select("seq", scalars.message_key().cast("string").alias("key"))


def _coinbase_messages(spark, d):
    t = trades(spark, d)
    one = F.struct("trade_id", F.col("symbol").alias("product_id"), F.col("price").cast("string").alias("price"), F.col("size").cast("string").alias("size"), F.upper("side").alias("side"), F.date_format(F.timestamp_millis("ts_event"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time"))
    channel = F.when(F.col("seq") % 10 == 0, "heartbeats").otherwise("market_trades")
    return t.select("seq", "ts_ingest", F.to_json(F.struct(channel.alias("channel"), F.array(F.struct(F.lit("update").alias("type"), F.array(one, one).alias("trades"))).alias("events"))).alias("raw"))


_NORMALISED = "SELECT seq, {venue} AS exchange, symbol, trade_id, price, size, side, ts_event, ts_ingest FROM trades"


@query(SQL + _NORMALISED.format(venue="'coinbase'") + " WHERE seq % 10 <> 0 UNION ALL " + _NORMALISED.format(venue="'coinbase'") + " WHERE seq % 10 <> 0")
def normalize_coinbase(spark, d):
    return feeds.parse_coinbase(_coinbase_messages(spark, d)).drop("raw")


@query(SQL + _NORMALISED.format(venue="'kraken'").replace(" symbol,", " CASE WHEN symbol = 'S0' THEN 'BTC-USD' ELSE symbol END AS symbol,") + " WHERE seq % 10 <> 0")
def normalize_kraken(spark, d):
    t = trades(spark, d)
    symbol = F.when(F.col("symbol") == "S0", F.lit("BTC/USD")).otherwise(F.col("symbol"))
    one = F.struct(symbol.alias("symbol"), "side", "price", F.col("size").alias("qty"), F.col("trade_id").cast("long").alias("trade_id"), F.date_format(F.timestamp_millis("ts_event"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"))
    kind = F.when(F.col("seq") % 10 == 0, "status").otherwise("update")
    raw = F.to_json(F.struct(F.lit("trade").alias("channel"), kind.alias("type"), F.array(one).alias("data")))
    return feeds.parse_kraken(t.select("seq", "ts_ingest", raw.alias("raw"))).drop("raw")


@query(SQL + "SELECT exchange AS exchange, symbol, trade_id, price, size, side, ts_event, ts_ingest, seq, false AS malformed FROM trades")
def codec_round_trip(spark, d):
    frames = codec.encode_frames(trades(spark, d)).select("seq", "value")
    return codec.decode_frames(frames).drop("value", "decode_error")


def _spoilt(spark, d):
    """Frames of all trades, every seventh of them spoilt in one of four ways: no frame, another first byte, cut in the body, cut in the header."""
    frames = codec.encode_frames(trades(spark, d)).select("seq", "value")
    size = F.octet_length("value")
    ways = [F.lit(b""), F.concat(F.lit(b"\x01"), F.substring("value", F.lit(2), size)), F.substring("value", F.lit(1), size - 1), F.substring("value", F.lit(1), F.lit(3))]
    spoilt = F.get(F.array(*ways), (F.expr("seq div 7") % 4).cast("int"))
    return codec.decode_frames(frames.withColumn("value", F.when(F.col("seq") % 7 == 0, spoilt).otherwise(F.col("value"))))


#: The rules' SQL over the trades that are left when every seventh frame is spoilt.
_WHOLE = SQL.replace("WITH trades AS", "WITH every_trade AS", 1).replace("FROM events),\n", "FROM events),\ntrades AS (SELECT * FROM every_trade WHERE seq % 7 <> 0),\n", 1)


@query(SQL + "SELECT seq, seq % 7 = 0 AS malformed, CASE WHEN seq % 7 <> 0 THEN symbol END AS symbol, CASE WHEN seq % 7 <> 0 THEN price END AS price, CASE WHEN seq % 7 <> 0 THEN ts_event END AS ts_event FROM trades")
def r1_malformed(spark, d):
    return _spoilt(spark, d).select("seq", "malformed", "symbol", "price", "ts_event")


@query(_WHOLE + """SELECT seq, disposition, rule_id, reason, r5 AS has_gap, r6 AS has_divergence FROM verdicts
    UNION ALL SELECT seq, 'quarantine', 'R1', 'malformed', false, false FROM every_trade WHERE seq % 7 = 0""")  # fmt: skip
def verdicts_of_frames(spark, d):
    has = lambda r: F.exists("alerts", lambda a: a["rule_id"] == r)
    return gate.evaluate(_spoilt(spark, d), RULES).select("seq", "disposition", "rule_id", "reason", has("R5").alias("has_gap"), has("R6").alias("has_divergence"))


@query(_WHOLE + """SELECT count(*) FILTER (disposition = 'valid') AS n_valid, (SELECT count(*) FROM every_trade WHERE seq % 7 = 0) AS quarantined_r1, count(*) FILTER (rule_id = 'R2') AS quarantined_r2,
    count(*) FILTER (rule_id = 'R3') AS quarantined_r3, count(*) FILTER (rule_id = 'R4') AS quarantined_r4, count(*) FILTER (r5) AS gap_alerts,
    count(*) FILTER (r6) AS divergence_alerts, count(*) FILTER (stale_coinbase) AS stale_coinbase, count(*) FILTER (stale_kraken) AS stale_kraken FROM verdicts""")  # fmt: skip
def telemetry_of_frames(spark, d):
    return gate.telemetry(gate.evaluate(_spoilt(spark, d), RULES), RULES)


@query(_WHOLE + "SELECT 'valid' AS route, count(*) AS n FROM verdicts")
def routes_of_frames_gates_off(spark, d):
    """What doesn't decode is dropped when the gates are off."""
    return gate.routed(gate.evaluate(_spoilt(spark, d), RULES), gates_off=True).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'n/a (n=0)' ELSE printf('%.4f [%.4f, %.4f]', value / 7, value / 9, value / 11) END AS shown FROM events")
def estimate_format(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", scalars.format_estimate(F.col("value") / 7, F.col("value") / 9, F.col("value") / 11, F.col("event_id") % 5).alias("shown"))


# Rules


@query(SQL + "SELECT seq, r2 FROM ranged")
def r2_range(spark, d):
    return trades(spark, d).select("seq", gate.range_failure(RULES).isNotNull().alias("r2"))


@query(SQL + "SELECT t.seq, CASE WHEN b.lo IS NULL THEN 'unchecked' WHEN price BETWEEN b.lo AND b.hi THEN 'inside' ELSE 'outside' END AS place FROM trades t LEFT JOIN (VALUES ('S0', 1000, 1030), ('S1', 1000, 1030)) b(symbol, lo, hi) USING (symbol)")
def bounds_lookup_join(spark, d):
    bounds = spark.createDataFrame([(s, *b) for s, b in RULES.symbol_bounds.items() if s != "S2"], "symbol string, lo double, hi double")
    joined = trades(spark, d).join(F.broadcast(bounds), "symbol", "left")
    return joined.select("seq", F.when(F.col("lo").isNull(), "unchecked").when(F.col("price").between(F.col("lo"), F.col("hi")), "inside").otherwise("outside").alias("place"))


@query(SQL + "SELECT seq, r3 AS duplicate FROM seen")
def r3_dedup_closed(spark, d):
    return dedup.mark_duplicates(_passed(spark, d), KEYS, RULES.dedup_window).select("seq", "duplicate")


_FIFO = SQL.replace("WITH trades", "WITH RECURSIVE trades", 1) + f""",
lined AS (SELECT seq, exchange, symbol, trade_id, row_number() OVER (PARTITION BY exchange, symbol ORDER BY seq) AS rn FROM ranged WHERE NOT r2),
steps(exchange, symbol, rn, seq, held, duplicate) AS (
    SELECT exchange, symbol, rn, seq, [trade_id], false FROM lined WHERE rn = 1
    UNION ALL
    SELECT l.exchange, l.symbol, l.rn, l.seq,
           CASE WHEN list_contains(s.held, l.trade_id) THEN s.held ELSE list_append(s.held, l.trade_id)[-{SMALL_WINDOW}:] END, list_contains(s.held, l.trade_id)
    FROM steps s JOIN lined l ON l.exchange = s.exchange AND l.symbol = s.symbol AND l.rn = s.rn + 1)
SELECT seq, duplicate FROM steps"""


@query(_FIFO)
def r3_dedup_fifo(spark, d):
    return dedup.mark_duplicates(_passed(spark, d), KEYS, SMALL_WINDOW).select("seq", "duplicate")


@query(SQL + "SELECT seq, r4 AS late FROM timed")
def r4_late(spark, d):
    return gate.watermarks(_survivors(spark, d)).select("seq", gate.late(RULES).alias("late"))


@query(SQL + "SELECT seq, watermark FROM marked")
def r4_watermark(spark, d):
    return gate.watermarks(_survivors(spark, d)).select("seq", "watermark")


@query(SQL + "SELECT seq, watermark FROM marked")
def r4_watermark_in_stretches(spark, d):
    return gate.watermarks(_survivors(spark, d), chunk=STRETCH).select("seq", "watermark")


@query(SQL + "SELECT seq, r5 AS gap FROM accepted")
def r5_gap(spark, d):
    return _accepted(spark, d).select("seq", gate.gap(RULES).alias("gap"))


@query(SQL + "SELECT seq, p0.price AS price_0, p0.ts AS ts_0, p1.price AS price_1, p1.ts AS ts_1 FROM printed")
def r6_asof_last_print(spark, d):
    return gate.last_prints(_accepted(spark, d), RULES).select("seq", "price_0", "ts_0", "price_1", "ts_1")


@query(SQL + "SELECT symbol, count(*) FILTER (NOT fresh_0) AS stale_coinbase, count(*) FILTER (NOT fresh_1) AS stale_kraken, count(*) FILTER (fresh_0 AND fresh_1) AS comparable FROM fresh GROUP BY symbol")
def r6_stale_counts(spark, d):
    p = gate.last_prints(_accepted(spark, d), RULES)
    return p.groupBy("symbol").agg(F.count_if(~F.col("fresh_0")).alias("stale_coinbase"), F.count_if(~F.col("fresh_1")).alias("stale_kraken"), F.count_if(F.col("fresh_0") & F.col("fresh_1")).alias("comparable"))


_R6 = SQL + "SELECT seq, symbol, ts_event, sustained, round(deviation_pct, 9) AS deviation_pct FROM diverging WHERE r6"


@query(_R6)
def r6_alerts(spark, d):
    return gate.divergence(_accepted(spark, d), RULES).where("diverged").select("seq", "symbol", "ts_event", "sustained", F.round("deviation_pct", 9).alias("deviation_pct"))


@query(_R6)
def r6_alerts_in_stretches(spark, d):
    return gate.divergence(_accepted(spark, d), RULES, STRETCH).where("diverged").select("seq", "symbol", "ts_event", "sustained", F.round("deviation_pct", 9).alias("deviation_pct"))


# The gate


@query(SQL + "SELECT seq, disposition, rule_id, reason, symbol, price, r5 AS has_gap, r6 AS has_divergence FROM verdicts")
def verdicts(spark, d):
    has = lambda r: F.exists("alerts", lambda a: a["rule_id"] == r)
    return _verdicts(spark, d).select("seq", "disposition", "rule_id", "reason", "record.symbol", "record.price", has("R5").alias("has_gap"), has("R6").alias("has_divergence"))


@query(SQL + "SELECT disposition AS route, rule_id, count(*) AS n FROM verdicts GROUP BY ALL")
def route_counts(spark, d):
    return gate.routed(_verdicts(spark, d)).groupBy("route", "rule_id").agg(F.count(F.lit(1)).alias("n"))


@query(SQL + "SELECT 'valid' AS route, count(*) AS n FROM verdicts")
def route_counts_gates_off(spark, d):
    return gate.routed(_verdicts(spark, d), gates_off=True).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query(SQL + """SELECT count(*) FILTER (disposition = 'valid') AS n_valid, 0::BIGINT AS quarantined_r1, count(*) FILTER (rule_id = 'R2') AS quarantined_r2,
    count(*) FILTER (rule_id = 'R3') AS quarantined_r3, count(*) FILTER (rule_id = 'R4') AS quarantined_r4, count(*) FILTER (r5) AS gap_alerts,
    count(*) FILTER (r6) AS divergence_alerts, count(*) FILTER (stale_coinbase) AS stale_coinbase, count(*) FILTER (stale_kraken) AS stale_kraken FROM verdicts""")  # fmt: skip
def gate_telemetry(spark, d):
    return gate.telemetry(_verdicts(spark, d), RULES)


@query(SQL + """SELECT seq, CASE WHEN seq % 2 = 0 THEN '0:' || seq ELSE 'sha256:' || sha256('frame' || seq) END AS key, rule_id, reason, ts_ingest AS ts_ms, base64(encode('frame' || seq)) AS raw_b64
    FROM verdicts WHERE disposition = 'quarantine'""")  # fmt: skip
def envelope_key(spark, d):
    framed = trades(spark, d).withColumns({"value": F.concat(F.lit("frame"), F.col("seq").cast("string")).cast("binary"), "partition": F.lit(0), "offset": F.when(F.col("seq") % 2 == 0, F.col("seq"))})
    return gate.envelopes(gate.evaluate(framed, RULES, divergences=False)).select("seq", "key", "rule_id", "reason", "ts_ms", "raw_b64")


@query(SQL + "SELECT rule_id, reason, count(*) AS n FROM verdicts WHERE disposition = 'quarantine' GROUP BY ALL")
def quarantine_stats(spark, d):
    return gate.quarantine_stats(_verdicts(spark, d).where("disposition = 'quarantine'"))


@query(SQL + "SELECT disposition, rule_id, count(*) AS n FROM verdicts GROUP BY ALL")
def stream_route_counts(spark, d):
    """The trades as frames in several files, through the streaming gate with its state, to the folders it writes."""
    folder = files.scratch(spark, "stream")
    frames = codec.encode_frames(trades(spark, d)).select(F.lit(None).cast("binary").alias("key"), "value", F.lit(0).alias("partition"), F.col("seq").alias("offset"))
    frames.repartitionByRange(3, "offset").write.parquet(f"{folder}/frames")
    arriving = spark.readStream.schema(frames.schema).parquet(f"{folder}/frames")
    gate_stream.start(arriving, f"{folder}/out", f"{folder}/checkpoint", RULES).awaitTermination()
    found = spark.read.parquet(f"{folder}/out/telemetry")
    return found.groupBy("disposition", "rule_id").agg(F.sum("count").alias("n"))


# Bars and objectives

_OFF = "(SELECT *, disposition = 'quarantine' AS rejected FROM verdicts)"


@query(SQL + sql_bars("trades"))
def ohlcv_bars(spark, d):
    return bars.build(trades(spark, d))


@query(SQL + sql_bars("verdicts WHERE disposition = 'valid'"))
def bars_on(spark, d):
    return bars.gates_on(gate.evaluate(trades(spark, d), RULES, divergences=False))


@query(SQL + sql_bars(_OFF, "rejected"))
def bars_off(spark, d):
    return bars.gates_off(gate.evaluate(trades(spark, d), RULES, divergences=False))


_BROKEN = {"volume_positive": "volume <= 0", "price_positive": "low <= 0", "no_quarantinable": "tainted > 0", "high_ge_low": "high < low", "open_in_range": "NOT (bar_open BETWEEN low AND high)", "close_in_range": "NOT (bar_close BETWEEN low AND high)"}
_VIOLATED = SQL + ", off_bars AS (" + sql_bars(_OFF, "rejected") + "), broken AS (" + " UNION ALL ".join(f"SELECT exchange, symbol, bar_start_ms, '{k}' AS invariant FROM off_bars WHERE {v}" for k, v in _BROKEN.items()) + ") "


@query(_VIOLATED + "SELECT * FROM broken")
def slo_violations(spark, d):
    return slo.violations(bars_off(spark, d)).drop("detail")


@query(_VIOLATED + "SELECT (SELECT count(*) FROM off_bars) AS n_bars, count(*) AS n_violations, count(DISTINCT (exchange, symbol, bar_start_ms)) AS violated_bars, " + ", ".join(f"count(*) FILTER (invariant = '{i}') AS {i}" for i in slo.INVARIANTS) + " FROM broken")
def slo_counts(spark, d):
    return slo.rollup(bars_off(spark, d))


@query(SQL + ", off_bars AS (" + sql_bars(_OFF, "rejected") + """), given AS (SELECT *, row_number() OVER (ORDER BY high, low, exchange, symbol, bar_start_ms) AS place FROM off_bars),
    led AS (SELECT *, lag(bar_start_ms) OVER (PARTITION BY exchange, symbol ORDER BY place) AS before FROM given) SELECT exchange, symbol, count(*) AS n FROM led WHERE bar_start_ms <= before GROUP BY ALL""")  # fmt: skip
def slo_monotone_time(spark, d):
    from pyspark.sql import Window

    given = bars_off(spark, d).withColumn("place", F.row_number().over(Window.orderBy("high", "low", *bars.BAR_KEY)))
    return slo.violations(given, "place").where("invariant = 'monotone_time'").groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("n"))


@query(SQL + sql_bars("trades t LEFT JOIN manifest m ON t.seq = m.index WHERE (m.expected_disposition IS NULL OR m.expected_disposition = 'valid') AND NOT (coalesce(m.is_fault, false) AND NOT m.detectable)"))
def valid_projection(spark, d):
    return slo.expected_bars(trades(spark, d), manifest(spark, d))


@query(SQL + "SELECT seq FROM trades WHERE seq NOT IN (SELECT index FROM manifest WHERE is_fault AND NOT detectable)")
def designed_miss_antijoin(spark, d):
    missed = manifest(spark, d).where("is_fault AND NOT detectable").select(F.col("index").alias("seq"))
    return trades(spark, d).join(missed, "seq", "left_anti").select("seq")


# Grading and profile


@query(SQL + "SELECT fault_class, count(*) FILTER (is_fault) AS faults, count(*) FILTER (is_fault AND detectable) AS detectable, count(*) FILTER (is_fault AND NOT detectable) AS designed_miss, count(*) FILTER (NOT is_fault) AS controls FROM manifest GROUP BY 1")
def manifest_rollup(spark, d):
    return faultlab.manifest_rollup(manifest(spark, d))


_GRADED = SQL + ", graded AS (SELECT v.seq, v.disposition = 'quarantine' AS q, v.rule_id, m.fault_class, coalesce(m.is_fault, false) AS is_fault, m.detectable, m.index IS NOT NULL AS listed FROM verdicts v LEFT JOIN manifest m ON v.seq = m.index) "


@query(_GRADED + "SELECT " + ", ".join(f"count(*) FILTER (is_fault AND fault_class = '{c}') AS {r.lower()}_faults, count(*) FILTER (is_fault AND fault_class = '{c}' AND q AND rule_id = '{r}') AS {r.lower()}_caught, count(*) FILTER (is_fault AND fault_class = '{c}' AND NOT detectable) AS {r.lower()}_designed_misses, count(*) FILTER (q AND rule_id = '{r}') AS {r.lower()}_quarantined" for c, r in grade.CLASS_RULES.items()) + ", count(*) FILTER (NOT is_fault) AS controls, count(*) FILTER (NOT is_fault AND q) AS controls_quarantined, count(*) FILTER (NOT is_fault AND listed) AS boundary_controls, count(*) FILTER (NOT is_fault AND listed AND q) AS boundary_quarantined, count(*) AS verdicts, count(DISTINCT seq) AS distinct_seq, count(*) FILTER (NOT q) AS valid, count(*) FILTER (q) AS quarantined FROM graded")
def grade_counts(spark, d):
    return grade.counts(gate.evaluate(trades(spark, d), RULES, divergences=False), manifest(spark, d))


@query(_GRADED + "SELECT count(*) FILTER (NOT is_fault AND q)::DOUBLE / count(*) FILTER (NOT is_fault) AS all_controls, count(*) FILTER (NOT is_fault AND listed AND q)::DOUBLE / count(*) FILTER (NOT is_fault AND listed) AS boundary_controls FROM graded")
def false_quarantine(spark, d):
    n = grade_counts(spark, d)
    return n.select(F.try_divide("controls_quarantined", "controls").alias("all_controls"), F.try_divide("boundary_quarantined", "boundary_controls").alias("boundary_controls"))


@query(_GRADED + "SELECT (SELECT count(*) FROM events) - count(DISTINCT seq) AS loss, count(*) - count(DISTINCT seq) AS duplicate, count(*) FILTER (NOT q) AS valid, count(*) FILTER (q) AS quarantined FROM graded")
def completeness(spark, d):
    n = grade_counts(spark, d).crossJoin(trades(spark, d).agg(F.count(F.lit(1)).alias("total")))
    return n.select((F.col("total") - F.col("distinct_seq")).alias("loss"), (F.col("verdicts") - F.col("distinct_seq")).alias("duplicate"), "valid", "quarantined")


@query(SQL + """, led AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, trade_id ORDER BY seq) AS nth,
        max(ts_event) OVER (PARTITION BY exchange, symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM trades)
    SELECT exchange, symbol, count(*) AS n, count(DISTINCT trade_id) AS unique_ids, count(*) FILTER (nth > 1) AS duplicate_ids, 0::BIGINT AS missing_ids, min(ts_event) AS first_ms, max(ts_event) AS last_ms,
        max(abs(ts_event - ts_ingest)) AS max_skew_ms, count(*) FILTER (abs(ts_event - ts_ingest) <= 100) AS within_skew, count(*) FILTER (ts_event < latest) AS out_of_order FROM led GROUP BY 1, 2""")  # fmt: skip
def profile_stats(spark, d):
    return profile.stream_stats(trades(spark, d), skew_ms=100).drop("samples")


@query(SQL + "SELECT exchange, symbol, seq, trade_id FROM (SELECT *, row_number() OVER (PARTITION BY exchange, symbol ORDER BY seq) AS nth FROM trades) WHERE nth <= 3")
def first_k_samples(spark, d):
    return profile.stream_stats(trades(spark, d)).select("exchange", "symbol", F.explode("samples").alias("s")).select("exchange", "symbol", "s.seq", "s.trade_id")


_EXPECTED = [(e, s, n) for e in ("coinbase", "kraken") for s, n in (("S0", 1), ("S1", 1_000_000), ("S9", 1))]


@query(SQL + "SELECT x.exchange, x.symbol, coalesce(c.n, 0)::BIGINT AS n, x.floor, coalesce(c.n, 0) >= x.floor AS alive FROM (VALUES " + ", ".join(f"('{e}', '{s}', {n})" for e, s, n in _EXPECTED) + ") x(exchange, symbol, floor) LEFT JOIN (SELECT exchange, symbol, count(*) AS n FROM trades GROUP BY 1, 2) c USING (exchange, symbol)")
def liveness_gate(spark, d):
    return profile.liveness(trades(spark, d), spark.createDataFrame(_EXPECTED, "exchange string, symbol string, floor int"))


@query(SQL + "SELECT seq, exchange, symbol FROM trades")
def streams_union(spark, d):
    t = trades(spark, d).select("seq", "exchange", "symbol")
    return slo.union_all([t.where(F.col("exchange") == e) for e in RULES.venues])


@query(SQL + "SELECT exchange, symbol, seq, sum(size * 1000000) OVER (PARTITION BY exchange, symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS micros FROM trades")
def running_sum_in_stretches(spark, d):
    out = running(trades(spark, d), KEYS, "seq", {"micros": ("sum", scalars.to_micros("size"))}, chunk=STRETCH)
    return out.select("exchange", "symbol", "seq", "micros")


# Without SQL: seeded generators, opaque frames


@query()
def fixture_clean(spark, d):
    """The fixture in its full size; it reads no table."""
    return faultlab.clean_fixture(spark)


@query()
def fixture_faulted_verdicts(spark, d):
    """The fixture in its full size, injected, through codec, gate and grade; it reads no table."""
    faulted = faultlab.inject(faultlab.clean_fixture(spark))
    return grade.labelled(gate.evaluate(faultlab.trades_of(faulted)), faultlab.manifest_of(faulted))


@query(LINEITEM_SQL + sql_bars("accepted"))
def lineitem_gate_bars(spark, d):
    """The measured workload: six streams beyond the window's size, through the gate into bars."""
    return bars.gates_on(gate.evaluate(lineitem_trades(spark, d), divergences=False))
