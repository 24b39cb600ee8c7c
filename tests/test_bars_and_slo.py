import random

from pyspark.sql import functions as F

from tests.test_gate import SCHEMA, T0, trade
from tidewatch.functions.digests import bars_digest, equality_digest
from tidewatch.operators import bars, profile, slo
from tidewatch.sources.files import BarTable, to_duckdb

BAR = "exchange string, symbol string, bar_start_ms long, bar_open double, high double, low double, bar_close double, volume double, trade_count long, tainted long, place int"


def rows():
    prices, sizes = [100.0, 110.0, 90.0, 105.0], [1.0, 2.0, 0.5, 1.5]
    return [trade(i, price=p, size=s, ts_event=T0 - T0 % 60_000 + 1000 * i) for i, (p, s) in enumerate(zip(prices, sizes, strict=True))]


def test_one_bar(spark):
    b = bars.build(spark.createDataFrame(rows(), SCHEMA)).first()
    assert (b["bar_open"], b["high"], b["low"], b["bar_close"], b["volume"], b["trade_count"], b["tainted"]) == (100.0, 110.0, 90.0, 105.0, 5.0, 4, 0)


def test_order_does_not_matter_and_first_arrival_breaks_ties(spark):
    many = [trade(i, price=float(1 + i % 7), size=0.1, ts_event=T0 + i * 777) for i in range(500)]
    shuffled = random.Random(1).sample(many, len(many))
    a, b = (bars_digest(bars.build(spark.createDataFrame(x, SCHEMA).repartition(n))) for x, n in ((many, 1), (shuffled, 5)))
    assert a == b
    same = [trade(0, price=5.0, trade_id="x"), trade(1, price=7.0, trade_id="x")]
    got = bars.build(spark.createDataFrame(same, SCHEMA)).first()
    assert got["bar_open"] == got["bar_close"] == 5.0


def test_buckets_floor_before_the_epoch(spark):
    got = bars.build(spark.createDataFrame([trade(0, ts_event=-1)], SCHEMA)).first()
    assert got["bar_start_ms"] == -60_000


def test_every_invariant(spark):
    good = ("c", "s", 60_000, 2.0, 3.0, 1.0, 2.0, 1.0, 1, 0, 0)
    fields = [c.split(" ")[0] for c in BAR.split(", ")]
    broken = {
        "high_ge_low": {"high": 0.5, "low": 0.9, "bar_open": 0.7, "bar_close": 0.7}, "open_in_range": {"bar_open": 9.0}, "close_in_range": {"bar_close": 9.0}, "volume_positive": {"volume": 0.0},
        "price_positive": {"low": 0.0}, "no_quarantinable": {"tainted": 1},
    }
    for invariant, change in broken.items():
        bar = tuple(change.get(f, v) for f, v in zip(fields, good, strict=True))
        found = {r["invariant"] for r in slo.violations(spark.createDataFrame([bar], BAR)).collect()}
        assert invariant in found and found <= {invariant, "open_in_range", "close_in_range"}
    back = [good, (*good[:2], 0, *good[3:-1], 1), (*good[:2], 120_000, *good[3:-1], 2)]
    df = spark.createDataFrame(back, BAR)
    assert [r["bar_start_ms"] for r in slo.violations(df, "place").collect()] == [0]
    counts = slo.rollup(df, "place").first()
    assert (counts["n_bars"], counts["n_violations"], counts["violated_bars"], counts["monotone_time"], counts["high_ge_low"]) == (3, 1, 1, 1, 0)


def test_bar_table_and_duckdb(spark, tmp_path):
    made = bars.build(spark.createDataFrame(rows(), SCHEMA))
    table = BarTable(spark, str(tmp_path / "bars"))
    table.append(made, 0)
    table.append(made, 0)
    table.append(made.withColumn("volume", F.lit(9.0)), 1)
    assert table.count() == 1 and table.read().first()["volume"] == 9.0
    assert to_duckdb(made, str(tmp_path / "bars.db")) == 1 and to_duckdb(made, str(tmp_path / "bars.db")) == 2


def test_equality_digest(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert equality_digest(df) == equality_digest(df.repartition(5).orderBy(F.desc("seq"))) != equality_digest(df.limit(3))


def test_profile(spark):
    ids = ["1", "2", "1", ""]
    times = [0, 5_000, 3_000, 4_000]
    data = [trade(i, trade_id=x, ts_event=T0 + t, ts_ingest=T0 + t + skew) for i, (x, t, skew) in enumerate(zip(ids, times, [59_000, 61_000, 60_000, 0], strict=True))]
    for chunk in (None, 2):
        s = profile.stream_stats(spark.createDataFrame(data, SCHEMA), samples=2, chunk=chunk).first()
        assert (s["n"], s["unique_ids"], s["duplicate_ids"], s["missing_ids"], s["out_of_order"], s["within_skew"], s["max_skew_ms"]) == (4, 2, 1, 1, 2, 3, 61_000)
        assert [x["seq"] for x in s["samples"]] == [0, 1]
    expected = spark.createDataFrame([("coinbase", "BTC-USD", 4), ("kraken", "BTC-USD", 1)], "exchange string, symbol string, floor int")
    alive = profile.liveness(spark.createDataFrame(data, SCHEMA), expected)
    assert {r["exchange"]: r["alive"] for r in alive.collect()} == {"coinbase": True, "kraken": False} and not profile.gate_passes(alive)
    assert "coinbase" in profile.render(profile.stream_stats(spark.createDataFrame(data, SCHEMA)))
