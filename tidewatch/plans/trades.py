"""One deterministic trade feed over the test tables, written alike for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.config import Rules

RULES = Rules(symbol_bounds={f"S{k}": (1000.0, 1030.0) for k in range(3)})


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as trades of two venues and three symbols, with repeated ids, prices out of bounds, late rows and gaps."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value", F.expr("unix_micros(CAST(ts AS TIMESTAMP)) div 1000").alias("ms"))
    return e.select(
        F.col("event_id").alias("seq"),
        F.expr("IF(event_id % 2 = 0, 'coinbase', 'kraken')").alias("exchange"),
        F.expr("concat('S', CAST((event_id div 2) % 3 AS STRING))").alias("symbol"),
        F.expr("CAST(event_id - IF(event_id % 17 = 0 AND event_id >= 60, 6 * (1 + event_id % 10), 0) AS STRING)").alias("trade_id"),
        F.expr("1000D + value * 0.1D").alias("price"),
        F.expr("(event_id % 97) * 0.01D").alias("size"),
        F.expr("CASE event_id % 3 WHEN 0 THEN 'buy' WHEN 1 THEN 'sell' ELSE 'unknown' END").alias("side"),
        F.expr(_TS.replace("{div}", "div").replace("{ms}", "ms")).alias("ts_event"),
        F.expr(_TS.replace("{div}", "div").replace("{ms}", "ms") + " + event_id % 300").alias("ts_ingest"),
    )


_TS = (
    "1704067200000 + event_id * 2500 + (event_id {div} 500) * 90000 + {ms} % 1000"
    " - CASE event_id % 23 WHEN 0 THEN 25000 WHEN 1 THEN 17000 ELSE 0 END"
)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an injector would have said of these trades."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("index"))
    kind = F.expr("CASE WHEN index % 97 = 0 THEN 'out-of-range' WHEN index % 17 = 0 AND index >= 60 THEN 'duplicate' WHEN index % 23 <= 1 AND index >= 60 THEN 'out-of-order' END")
    listed = e.withColumn("fault_class", kind).where(F.col("fault_class").isNotNull())
    fault = F.expr("index % 7 <> 0")
    return listed.select(
        "index", "fault_class", fault.alias("is_fault"), F.expr("index % 5 <> 0").alias("detectable"),
        F.expr("IF(index % 7 <> 0 AND index % 5 <> 0, 'quarantine', 'valid')").alias("expected_disposition"),
        F.expr("IF(index % 7 <> 0 AND index % 5 <> 0, CASE fault_class WHEN 'out-of-range' THEN 'R2' WHEN 'duplicate' THEN 'R3' ELSE 'R4' END, NULL)").alias("expected_rule"),
    )


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a trade feed of six streams, for measuring: ids repeat, and each stream holds more than a window of them."""
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus"]
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*cols)
    # Repeated keys differ in other columns, which tell their arrivals apart but for one pair in 2^20. The two of such a
    # pair have one id, and R3 takes the lesser record; the SQL leaves open which of them comes first.
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    jitter = (F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104_729 + F.col("l_quantity").cast("long") * 1009 + cents) % (1 << 20)
    at = F.lit(1_700_000_000_000) + F.col("l_orderkey") * 400
    return line.select(
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long") * (1 << 20) + jitter).alias("seq"), F.col("l_returnflag").alias("exchange"), F.col("l_linestatus").alias("symbol"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("trade_id"), F.col("l_extendedprice").cast("double").alias("price"),
        F.col("l_quantity").cast("double").alias("size"), F.lit("buy").alias("side"), (at + jitter % 6000).alias("ts_event"), (at + 6000).alias("ts_ingest"),
    )


_SQL_TS = _TS.replace("{div}", "//").replace("{ms}", "(epoch_us(ts) // 1000)")
#: The same feed, rule by rule, as common table expressions.
SQL = f"""
WITH trades AS (
    SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 'coinbase' ELSE 'kraken' END AS exchange, 'S' || ((event_id // 2) % 3) AS symbol,
           (event_id - CASE WHEN event_id % 17 = 0 AND event_id >= 60 THEN 6 * (1 + event_id % 10) ELSE 0 END)::VARCHAR AS trade_id,
           1000::DOUBLE + value * 0.1::DOUBLE AS price, (event_id % 97)::DOUBLE * 0.01::DOUBLE AS size,
           CASE event_id % 3 WHEN 0 THEN 'buy' WHEN 1 THEN 'sell' ELSE 'unknown' END AS side,
           ({_SQL_TS})::BIGINT AS ts_event, ({_SQL_TS} + event_id % 300)::BIGINT AS ts_ingest
    FROM events),
ranged AS (
    SELECT *, NOT (price > 0) OR NOT (size > 0) OR NOT (price BETWEEN 1000 AND 1030) AS r2 FROM trades),
seen AS (
    SELECT *, row_number() OVER (PARTITION BY exchange, symbol, trade_id ORDER BY seq) > 1 AS r3 FROM ranged WHERE NOT r2),
marked AS (
    SELECT *, max(ts_event) OVER (PARTITION BY exchange, symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark FROM seen WHERE NOT r3),
timed AS (SELECT *, coalesce(ts_event < watermark - 5000, false) AS r4 FROM marked),
accepted AS (SELECT *, coalesce(ts_event - watermark > 60000, false) AS r5 FROM timed WHERE NOT r4),
printed AS (
    SELECT *, last_value(CASE WHEN exchange = 'coinbase' THEN {{'price': price, 'ts': ts_event}} END IGNORE NULLS) OVER y AS p0,
              last_value(CASE WHEN exchange = 'kraken' THEN {{'price': price, 'ts': ts_event}} END IGNORE NULLS) OVER y AS p1
    FROM accepted WINDOW y AS (PARTITION BY symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
fresh AS (
    SELECT *, p0 IS NOT NULL AND ts_event - p0.ts <= 30000 AS fresh_0, p1 IS NOT NULL AND ts_event - p1.ts <= 30000 AS fresh_1 FROM printed),
apart AS (
    SELECT *, CASE WHEN fresh_0 AND fresh_1 THEN abs(p0.price - p1.price) / ((p0.price + p1.price) / 2.0::DOUBLE) * 100.0::DOUBLE END AS deviation_pct FROM fresh),
limits AS (SELECT *, coalesce(deviation_pct > 0.5, false) AS is_over FROM apart),
episodes AS (
    SELECT *, sum((fresh_0 AND fresh_1 AND NOT is_over)::BIGINT) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS episode FROM limits),
clocked AS (
    SELECT *, CASE WHEN is_over AND row_number() OVER e > 1 THEN ts_event - first_value(ts_event) OVER e END AS sustained
    FROM episodes WINDOW e AS (PARTITION BY symbol, episode, is_over ORDER BY seq)),
diverging AS (
    SELECT *, coalesce(sustained >= 10000, false) AND sum(coalesce(sustained >= 10000, false)::BIGINT)
              OVER (PARTITION BY symbol, episode, is_over ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS r6
    FROM clocked),
verdicts AS (
    SELECT t.*, CASE WHEN r.r2 THEN 'R2' WHEN s.r3 THEN 'R3' WHEN w.r4 THEN 'R4' END AS rule_id,
           CASE WHEN r.r2 OR s.r3 OR w.r4 THEN 'quarantine' ELSE 'valid' END AS disposition,
           CASE WHEN r.r2 THEN 'out-of-range' WHEN s.r3 THEN 'duplicate' WHEN w.r4 THEN 'out-of-order' END AS reason,
           coalesce(d.r5, false) AS r5, coalesce(d.r6, false) AS r6, coalesce(NOT d.fresh_0, false) AS stale_coinbase, coalesce(NOT d.fresh_1, false) AS stale_kraken
    FROM trades t JOIN ranged r USING (seq) LEFT JOIN seen s USING (seq) LEFT JOIN timed w USING (seq) LEFT JOIN diverging d USING (seq)),
manifest AS (
    SELECT * FROM (
        SELECT event_id AS index, CASE WHEN event_id % 97 = 0 THEN 'out-of-range' WHEN event_id % 17 = 0 AND event_id >= 60 THEN 'duplicate'
                                       WHEN event_id % 23 <= 1 AND event_id >= 60 THEN 'out-of-order' END AS fault_class,
               event_id % 7 <> 0 AS is_fault, event_id % 5 <> 0 AS detectable,
               CASE WHEN event_id % 7 <> 0 AND event_id % 5 <> 0 THEN 'quarantine' ELSE 'valid' END AS expected_disposition
        FROM events) WHERE fault_class IS NOT NULL)
"""


def sql_bars(source: str, tainted: str = "false") -> str:
    """The bars of a relation."""
    return f"""
    SELECT exchange, symbol, ts_event - ((ts_event % 60000) + 60000) % 60000 AS bar_start_ms,
           first(price ORDER BY ts_event, trade_id, seq) AS bar_open, max(price) AS high, min(price) AS low,
           first(price ORDER BY ts_event DESC, trade_id DESC, seq) AS bar_close,
           sum(round_even(size * 1000000, 0)::BIGINT)::BIGINT / 1000000::DOUBLE AS volume, count(*)::BIGINT AS trade_count, count(*) FILTER ({tainted})::BIGINT AS tainted
    FROM {source} GROUP BY 1, 2, 3"""


#: The same feed, and the rules on it up to what they accept. Rows of an id follow each other, so the first of them is no duplicate and the others are.
LINEITEM_SQL = """
WITH jittered AS (
    SELECT *, (l_partkey * 7919 + l_suppkey * 104729 + trunc(l_quantity)::BIGINT * 1009 + round(l_extendedprice * 100)::BIGINT) % 1048576 AS jitter FROM lineitem),
trades AS (
    SELECT (l_orderkey * 8 + l_linenumber) * 1048576 + jitter AS seq, l_returnflag AS exchange, l_linestatus AS symbol, l_orderkey || '-' || l_linenumber AS trade_id,
           l_extendedprice::DOUBLE AS price, l_quantity::DOUBLE AS size, 1700000000000 + l_orderkey * 400 + jitter % 6000 AS ts_event
    FROM jittered),
ranged AS (SELECT *, coalesce(NOT (price > 0) OR NOT (size > 0), true) AS r2 FROM trades),
""" + SQL[SQL.index("seen AS (") : SQL.index(",\nprinted AS (")]
