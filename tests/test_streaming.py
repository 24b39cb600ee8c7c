import json

from pyspark.sql import functions as F

from tidewatch.functions.scalars import message_key
from tidewatch.operators import bars, faultlab, gate
from tidewatch.operators.config import Rules
from tidewatch.sources.files import BarTable
from tidewatch.streaming import bars_stream, gate_stream

FRAME = "key binary, value binary, partition int, offset long"


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    rules = Rules(dedup_window=100)
    faulted = faultlab.inject(faultlab.clean_fixture(spark, 150), rules).select("seq", "value").persist()
    folder, out, check = (str(tmp_path / x) for x in ("frames", "out", "check"))
    n = faulted.count()
    # arrival interleaves the streams, so that venues meet
    order = faulted.withColumn("offset", (F.col("seq") % 150) * 10 + F.floor(F.col("seq") / 150)).persist()
    cut = 450
    for k, part in enumerate((order.where(F.col("offset") < cut), order.where(F.col("offset") >= cut))):
        part.select(F.lit(None).cast("binary").alias("key"), "value", F.lit(0).alias("partition"), "offset").repartition(2).write.mode("append").parquet(folder)
        frames = spark.readStream.schema(FRAME).parquet(folder)
        gate_stream.start(frames, out, check, rules).awaitTermination()
    batch = gate.evaluate(faultlab.trades_of(order.select(F.col("offset").alias("seq"), "value")), rules)
    want = {r["seq"]: r["rule_id"] for r in batch.select("seq", "rule_id").collect()}
    valid = {r["offset"] for r in spark.read.parquet(f"{out}/valid").collect()}
    bad = {int(r["key"].split(":")[1]): r["rule_id"] for r in spark.read.parquet(f"{out}/quarantine").collect()}
    assert valid == {s for s, r in want.items() if r is None} and bad == {s: r for s, r in want.items() if r}
    assert len(valid) + len(bad) == n and set(bad.values()) == {"R1", "R2", "R3", "R4"}
    body = json.loads(spark.read.parquet(f"{out}/quarantine").where("rule_id = 'R1'").first()["value"])
    assert body["ts_ms"] is None and body["reason"] == "malformed"


def test_saved_state_goes_on_where_it_was():
    rules = Rules(dedup_window=2)
    whole, parts = gate_stream.SymbolState(rules), gate_stream.SymbolState(rules)
    rows = [("coinbase", "a", 64_000.0, 0), ("kraken", "b", 65_000.0, 100), ("coinbase", "a", 64_000.0, 200), ("coinbase", "c", 64_000.0, 11_000), ("coinbase", "d", 64_000.0, 5_000), ("coinbase", "a", 64_000.0, 90_000)]
    a, b = [], []
    for venue, trade, price, ts in rows:
        a.append(whole.verdict(venue, "BTC-USD", trade, price, 1.0, ts))
        b.append(parts.verdict(venue, "BTC-USD", trade, price, 1.0, ts))
        parts = gate_stream.SymbolState(rules, parts.saved())
    assert a == b
    assert [v[0] for v in a] == [None, None, "R3", None, "R4", None]
    assert [x["rule_id"] for v in a for x in v[2]] == ["R6", "R5"]


def test_bars_of_a_stream(spark, tmp_path):
    clean = faultlab.clean_fixture(spark, 200).persist()
    folder = str(tmp_path / "valid")
    clean.repartition(3).write.parquet(folder)
    table = BarTable(spark, str(tmp_path / "bars"))
    stream = spark.readStream.schema(clean.schema).parquet(folder)
    bars_stream.start(stream, table, str(tmp_path / "check"), delay="3650 days").awaitTermination()
    # nothing is closed yet; a later trade closes the rest
    last = clean.limit(1).withColumns({"ts_event": F.lit(4_102_444_800_000), "symbol": F.lit("END")})
    last.write.mode("append").parquet(folder)
    bars_stream.start(stream, table, str(tmp_path / "check"), delay="3650 days").awaitTermination()
    got = [tuple(r) for r in table.read().collect()]
    assert got == [tuple(r) for r in bars.canonical(bars.build(clean)).select(*table.read().columns).collect()]


def test_key(spark):
    df = spark.createDataFrame([("a", "b", "c")], "exchange string, symbol string, trade_id string")
    assert bytes(df.select(message_key()).first()[0]) == b"a|b|c"
