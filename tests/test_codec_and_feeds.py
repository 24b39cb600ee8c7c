import http.server
import itertools
import json
import random
import threading
import time

import pytest

from tests.test_gate import SCHEMA, T0, trade
from tidewatch.functions import codec
from tidewatch.sources import broker, feeds, files, live, registry


def test_round_trip(spark):
    rows = [trade(i, trade_id=t, price=p, ts_event=ts) for i, (t, p, ts) in enumerate([("1", 0.1, T0), ("é😀", -1e300, -5), ("", float("inf"), 0), ("x" * 300, 5e-324, 2**62)])]
    df = spark.createDataFrame(rows, SCHEMA)
    back = codec.decode_frames(codec.encode_frames(df).select("seq", "value"))
    assert sorted(map(tuple, back.select("seq", *codec.NAMES).collect())) == sorted(rows) and back.where("malformed").count() == 0


def test_malformed_frames(spark):
    good = codec.encode(dict(zip(codec.NAMES, trade(1)[1:], strict=True)))
    bad = [b"", b"\x01" + good[1:], good[:3], good[:-4], good[:5] + b"\xff" * 6, good[:5] + b"\x01" * 9]
    for frame in bad:
        with pytest.raises(ValueError):
            codec.decode(frame)
    frames = spark.createDataFrame([(i, f) for i, f in enumerate([*bad, good, good + b"rest", None])], "seq long, value binary")
    out = {r["seq"]: r for r in codec.decode_frames(frames).collect()}
    assert [out[i]["malformed"] for i in range(8)] == [True] * 6 + [False] * 2 and 8 not in out
    assert out[0]["price"] is None and out[0]["decode_error"] and out[6]["price"] == 64_000.0


def test_garbage_never_escapes():
    rng = random.Random(1)
    for _ in range(3000):
        frame = b"\x00\x00\x00\x00\x01" + rng.randbytes(rng.randrange(40))
        try:
            codec.decode(frame)
        except ValueError:
            pass


def message(**changes):
    one = {"trade_id": "7", "product_id": "BTC-USD", "price": "64000.5", "size": "0.25", "side": "BUY", "time": "2026-07-19T06:36:40.123456789Z"} | changes
    return json.dumps({"channel": "market_trades", "events": [{"type": "update", "trades": [one, one]}]})


def test_coinbase(spark):
    raw = [(1, message()), (2, message(price="x", side="hold")), (3, json.dumps({"channel": "heartbeats"})), (4, "no json"), (5, None)]
    out = feeds.parse_coinbase(spark.createDataFrame(raw, "ts_ingest long, raw string")).collect()
    assert len(out) == 4
    first = next(r for r in out if r["ts_ingest"] == 1)
    assert (first["exchange"], first["symbol"], first["trade_id"], first["price"], first["size"], first["side"], first["ts_event"]) == ("coinbase", "BTC-USD", "7", 64000.5, 0.25, "buy", 1784443000123)
    odd = next(r for r in out if r["ts_ingest"] == 2)
    assert odd["price"] is None and odd["side"] == "unknown"


def test_kraken_and_capture(spark, tmp_path):
    data = [{"symbol": s, "side": "sell", "price": 1.5, "qty": 2.0, "trade_id": 12, "timestamp": "2026-07-19T06:36:40Z"} for s in ("BTC/USD", "DOGE/USD")]
    raw = [(1, json.dumps({"channel": "trade", "type": t, "data": data})) for t in ("update", "snapshot", "status")]
    df = spark.createDataFrame(raw, "ts_ingest long, raw string")
    out = feeds.parse_kraken(df).collect()
    assert sorted(r["symbol"] for r in out) == ["BTC-USD", "BTC-USD", "DOGE/USD", "DOGE/USD"] and {r["trade_id"] for r in out} == {"12"}
    kept = feeds.captured(df, feeds.KrakenFeed(), ["BTC-USD"])
    files.write_capture(kept, str(tmp_path / "c"))
    again = files.read_capture(spark, str(tmp_path / "c"))
    assert again.count() == 2 and {r["price"] for r in again.collect()} == {1.5}
    assert json.loads(feeds.KrakenFeed().subscribe(["BTC-USD"]))["params"]["symbol"] == ["BTC/USD"]


def test_live_feed_reconnects():
    class Connection(list):
        def send(self, text):
            sent.append(text)

    sent, waits, opened = [], [], []

    def connect(url):
        opened.append(url)
        if len(opened) == 2:
            raise OSError("down")
        return Connection(['{"a": 1}', "no json", "[1]", '{"b": 2}'])

    got = list(feeds.messages(feeds.CoinbaseFeed(), ["BTC-USD"], connect, lambda: len(opened) > 3, waits.append, lambda: feeds.waits(draw=lambda: 1.0)))
    assert [t for _, t in got] == ['{"a": 1}', '{"b": 2}'] * 2 and len(sent) == 3 and waits == [1.0, 1.0 * 2, 1.0][: len(waits)]
    assert list(itertools.islice(feeds.waits(draw=lambda: 0.0), 8)) == [0.5, 1, 2, 4, 8, 16, 30, 30]


class Dropped(Exception):
    """As a websocket client raises it: no OSError."""


def test_two_venues_at_once_with_an_abnormal_close():
    lines, opened, closed, both = [], [], [], threading.Barrier(2, timeout=10)

    class Connection:
        def __init__(self, url):
            self.url = url

        def send(self, text):
            json.loads(text)

        def __iter__(self):
            if opened.count(self.url) == 1:
                both.wait()  # neither venue waits for the other to end
                yield '{"n": 1}'
                raise Dropped
            yield '{"n": 2}'
            done[self.url] = True

        def close(self):
            closed.append(self.url)

    def connect(url):
        opened.append(url)
        return Connection(url)

    done = {}
    counts = feeds.record(["coinbase", "kraken"], ["BTC-USD"], connect, lambda: len(done) == 2 and len(lines) >= 4, lines.append, lambda _: time.sleep(0.01), (OSError, Dropped))
    assert counts["coinbase"] >= 2 and counts["kraken"] >= 2 and len(closed) >= 2
    assert {(r["feed"], r["raw"]) for r in map(json.loads, lines)} == {(f, f'{{"n": {n}}}') for f in ("coinbase", "kraken") for n in (1, 2)}
    with pytest.raises(Dropped):
        opened.clear()
        feeds.record(["coinbase", "kraken"], ["BTC-USD"], connect, lambda: False, lines.append, lambda _: None)


def test_buffer_is_bounded_and_tells_of_its_end():
    taken = []

    def source():
        for k in range(5):
            taken.append(k)
            yield k, str(k)

    buffer = live.MessageBuffer(source, capacity=2)
    time.sleep(0.3)
    assert len(taken) == 3 and buffer.between(0) == ([("0", 0), ("1", 1)], 2)
    buffer.forget(2)
    time.sleep(0.3)
    assert buffer.between(2) == ([("2", 2), ("3", 3)], 4)
    buffer.forget(4)
    time.sleep(0.3)
    assert buffer.between(4)[0] == [("4", 4)]
    with pytest.raises(RuntimeError):
        buffer.between(5)


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    f = tmp_path / "a" / "x.bin"
    f.write_bytes(b"abc")
    assert files.sha256_file(f) == files.checksums(spark, str(tmp_path / "a")).first()["sha256"]
    assert files.latest_capture(tmp_path) is None
    (tmp_path / "a" / "manifest.json").write_text("{}")
    assert files.latest_capture(tmp_path) == tmp_path / "a"
    assert files.mismatches({"a": "1", "b": "2"}, {"a": "1"}) == ["b: pinned 2, found None"]
    df = spark.createDataFrame([trade(i) for i in range(5)], SCHEMA)
    files.write_trades(df, str(tmp_path / "t"))
    assert sorted(map(tuple, files.read_trades(spark, str(tmp_path / "t")).collect())) == sorted(map(tuple, df.collect()))
    doc = files.capture_manifest(df, f, 1.0, ["BTC-USD"], "now", "digest")
    assert doc["record_count"] == 5 and doc["counts_by_feed"] == {"coinbase": 5}
    assert broker.frames_of(df).count() == 5 and broker.write_options("s", "t")["kafka.enable.idempotence"] == "true"


def test_backward_compatibility(monkeypatch):
    new, old = codec.avro_schema(), codec.avro_schema()
    assert registry.backward_problems(new, old) == []
    new["fields"].append({"name": "fee", "type": "double"})
    assert len(registry.backward_problems(new, old)) == 1
    new["fields"][-1]["default"] = 0.0
    new["fields"][3] = {"name": "price", "type": "long"}
    assert len(registry.backward_problems(new, old)) == 1
    old["fields"][3] = {"name": "price", "type": "int"}
    assert registry.backward_problems(new, old) == []


def test_registry():
    calls, answers = [], []

    def send(method, path, body):
        calls.append((method, path))
        found = answers.pop(0)
        if isinstance(found, Exception):
            raise found
        return found

    pauses = []
    answers[:] = [(503, {}), OSError("down"), (200, {}), (200, {"id": 3})]
    assert registry.publish_contract(send, pause=pauses.append) == 3 and pauses == [0.5, 2.0]
    assert calls[-2:] == [("PUT", "/config/trades.raw-value"), ("POST", "/subjects/trades.raw-value/versions")]
    answers[:] = [(200, {"is_compatible": False, "messages": ["price"]}), (404, {}), (422, {"message": "no schema"})]
    assert registry.verdict(send) == registry.Verdict(False, False, ("price",)) and registry.verdict(send).first
    with pytest.raises(registry.RegistryError):
        registry.verdict(send)


def test_registry_over_http():
    class Handler(http.server.BaseHTTPRequestHandler):
        def answer(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            known = {"/config/trades.raw-value": body, "/subjects/trades.raw-value/versions": {"id": 7}}
            self.send_response(200 if self.path in known else 404)
            self.end_headers()
            self.wfile.write(json.dumps(known.get(self.path, {"error_code": 40401})).encode())

        do_PUT = do_POST = answer

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    send = registry.service(f"http://127.0.0.1:{server.server_port}/")
    assert registry.publish_contract(send) == 7 and registry.verdict(send) == registry.Verdict(True, True)
    server.shutdown()


def test_pins(spark, tmp_path):
    path, pins = str(tmp_path / "t"), tmp_path / "fixtures.yaml"
    files.write_trades(spark.createDataFrame([trade(i) for i in range(5)], SCHEMA), path)
    pinned = files.pin_fixture(spark, path, pins, 42)
    assert pinned["rows"] == 5 and files.pinned_trades(spark, pins).count() == 5
    pins.write_text(json.dumps(pinned | {"sha256": "0"}))
    with pytest.raises(ValueError, match="sha256"):
        files.pinned_trades(spark, pins)
