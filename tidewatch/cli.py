"""The command line: one subcommand for each job."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import codec, digests
from tidewatch.operators import bars, faultlab, gate, grade, profile, publish, slo
from tidewatch.operators.config import Rules
from tidewatch.sources import feeds, files, registry


def _spark() -> SparkSession:
    return SparkSession.builder.appName("tidewatch").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _rules(args) -> Rules:
    return Rules.from_yaml(args.rules) if args.rules else Rules()


def _show(document) -> None:
    print(json.dumps(document, indent=2, sort_keys=True))


def contract(args) -> int:
    if args.action == "show":
        print(codec.canonical_schema())
        return 0
    send = registry.service(args.registry)
    if args.action == "register":
        print(registry.publish_contract(send))
        return 0
    found = registry.verdict(send)
    print("\n".join(["compatible" if found.fits else "incompatible", *found.against]))
    return 0 if found.fits else 1


FRAMES = "key binary, value binary, partition int, offset long"


def run_gate(args) -> int:
    """Frames in a folder of Parquet files (key, value, partition, offset), or a topic, to the output folder, and to the topics of what passes and what doesn't.

    With --max-messages a folder's first so many frames, by partition and offset, or so many of a topic's.
    """
    from tidewatch.sources import broker
    from tidewatch.streaming import gate_stream

    spark = _spark()
    path, publish = args.input, None
    if args.max_messages is not None:
        every = broker.read_batch(spark, args.servers) if args.servers else spark.read.schema(FRAMES).parquet(args.input)
        path = files.scratch(spark, "frames")
        every.select("key", "value", "partition", "offset").orderBy("partition", "offset").limit(args.max_messages).write.parquet(path)
    if args.servers:
        publish = lambda rows, topic: broker.write_batch(rows, args.servers, topic)
    if args.servers and args.max_messages is None:
        frames = broker.read_stream(spark, args.servers)
    else:
        limit = {"maxFilesPerTrigger": args.max_files} if args.max_files else {}
        frames = spark.readStream.schema(FRAMES).options(**limit).parquet(path)
    gate_stream.start(frames, args.output, f"{args.output}/_checkpoint", _rules(args), args.gates_off, publish=publish).awaitTermination()
    counts = spark.read.parquet(f"{args.output}/telemetry").groupBy("disposition", "rule_id").agg(F.sum("count").alias("n"))
    _show({f"{r['disposition']}:{r['rule_id'] or ''}": r["n"] for r in counts.collect()})
    return 0


def run_bars(args) -> int:
    """Bars of clean trades, through the gate; with --valid of what the gate let pass, as a stream that goes on where it stopped."""
    spark = _spark()
    table = files.BarTable(spark, args.output)
    if args.valid or args.servers:
        from tidewatch.sources import broker
        from tidewatch.streaming import bars_stream

        frames = broker.read_stream(spark, args.servers, broker.VALID) if args.servers else spark.readStream.schema(FRAMES).parquet(f"{args.valid}/valid")
        passed = codec.decode_frames(frames).where(~F.col("malformed")).withColumn("seq", F.col("offset"))
        bars_stream.start(passed, table, f"{args.output}/_checkpoint", args.delay).awaitTermination()
        print(table.count())
        return 0
    if not args.input:
        print("--input, --valid or --servers is needed", file=sys.stderr)
        return 2
    trades = files.read_trades(spark, args.input)
    verdicts = gate.evaluate(trades, _rules(args), divergences=False)
    made = bars.gates_off(verdicts) if args.gates_off else bars.gates_on(verdicts)
    table.append(made)
    print(table.count())
    return 0


def fixture(args) -> int:
    """Generate the clean fixture and pin it, or verify one against its pins or a digest."""
    spark = _spark()
    if args.action == "verify":
        try:
            files.pinned_trades(spark, args.pins) if args.pins else files.verified_trades(spark, args.path, args.content_sha256, args.parquet_sha256)
        except ValueError as wrong:
            print(wrong, file=sys.stderr)
            return 1
        return 0
    files.write_trades(faultlab.clean_fixture(spark, args.rows, args.seed), args.path)
    if args.pins:
        print(files.pin_fixture(spark, args.path, args.pins, args.seed)["content_sha256"])
    else:
        print(digests.content_digest(r.asDict() for r in files.read_trades(spark, args.path).orderBy("seq").toLocalIterator()))
    return 0


def _faulted(args, spark):
    rules = _rules(args)
    if args.pins:
        clean = files.pinned_trades(spark, args.pins)
    elif args.path and args.content_sha256:
        clean = files.verified_trades(spark, args.path, args.content_sha256)
    else:
        clean = files.read_trades(spark, args.path) if args.path else faultlab.clean_fixture(spark, args.rows, args.seed)
    faulted = faultlab.inject(clean, rules, args.seed)
    return rules, faulted, faultlab.trades_of(faulted).persist(), faultlab.manifest_of(faulted).persist()


def run_slo(args) -> int:
    rules, _, trades, manifest = _faulted(args, _spark())
    found = slo.experiment(trades, manifest, rules, slo.fixture_label("fixture", trades.count(), args.seed, rules.dedup_window, rules.tolerance_ms))
    _show(found.as_dict())
    return 0 if found.thesis_holds else 1


def metrics(args) -> int:
    rules, faulted, trades, manifest = _faulted(args, _spark())
    _show(grade.as_document(grade.grade(gate.evaluate(trades, rules, divergences=False), manifest, faulted.count())))
    return 0


def export(args) -> int:
    import hashlib

    rules, faulted, trades, manifest = _faulted(args, _spark())
    document = faultlab.manifest_document(faulted, rules, args.seed)
    verdicts = gate.evaluate(trades, rules, divergences=False).persist()
    graded = grade.grade(verdicts, manifest, document["n_total"])
    label = slo.fixture_label("fixture", document["n_total"], args.seed, rules.dedup_window, rules.tolerance_ms)
    origin = publish.provenance(args.profile, args.content_sha256, args.parquet_sha256)
    out = publish.artifact(graded, grade.counts(verdicts, manifest).first().asDict(), slo.experiment(trades, manifest, rules, label), label, hashlib.sha256(faultlab.manifest_bytes(document)).hexdigest(), origin)
    files.write_site(out, publish.render(out), args.output)
    return 0


def sanity(args) -> int:
    folder = Path(args.capture) if args.capture else files.latest_capture(args.root)
    if folder is None or not folder.exists():
        print("no capture", file=sys.stderr)
        return 2
    spark = _spark()
    manifest = json.loads((folder / "manifest.json").read_text())
    stream = folder / manifest["stream_file"]
    checksum_ok = files.sha256_file(stream) == manifest["sha256"]
    trades = files.read_capture(spark, str(stream)).persist()
    least = dict(x.split("=", 1) for x in args.min)
    expected = [(e, s, int(least.get(e, 1))) for e in manifest["feeds"] for s in manifest["symbols"]]
    alive = profile.liveness(trades, spark.createDataFrame(expected, "exchange string, symbol string, floor int"), checksum_ok)
    print(profile.render(profile.stream_stats(trades)))
    return 0 if profile.gate_passes(alive) else 1


def capture(args) -> int:
    """Live messages of the chosen feeds, received at once, into a capture folder; needs a websocket client."""
    import time
    from datetime import UTC, datetime

    from tidewatch.sources.live import websocket

    try:
        connect, lost = websocket()
    except ImportError:
        print("the live feeds need the websockets package", file=sys.stderr)
        return 2
    spark = _spark()
    folder = Path(args.root) / datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")
    folder.mkdir(parents=True)
    stream, received = folder / "stream.jsonl", folder / "received.jsonl"
    end = time.monotonic() + args.duration
    with received.open("w") as out:
        print(feeds.record(args.feeds, args.symbols, connect, lambda: time.monotonic() > end, out.write, lost=lost))
    raw = spark.read.schema("feed string, raw string, ts_ingest long").json(str(received))
    with stream.open("w") as out:
        for name in args.feeds:
            for r in feeds.captured(raw.where(F.col("feed") == name).drop("feed"), feeds.FEEDS[name](), args.symbols).toLocalIterator():
                out.write(json.dumps({"raw": r["raw"], "norm": r["norm"].asDict()}) + "\n")
    received.unlink()
    trades = files.read_capture(spark, str(stream))
    document = files.capture_manifest(trades, stream, args.duration, args.symbols, datetime.now(UTC).isoformat(timespec="seconds"), files.sha256_file(stream))
    (folder / "manifest.json").write_text(json.dumps(document, indent=2, sort_keys=True))
    print(folder)
    return 0


def _until(stop, running: dict, seconds: float) -> None:
    """Wait for the time to pass, a signal or the end of a query; then stop them all and print how many rows each has taken."""
    import time

    end = time.monotonic() + seconds
    while time.monotonic() < end and not stop.is_set() and all(q.isActive for q in running.values()):
        stop.wait(min(0.5, max(0.0, end - time.monotonic())))
    for name, q in running.items():
        taken = sum(p["numInputRows"] for p in q.recentProgress)
        why = q.exception()
        q.stop()
        print(name, taken, why or "")


def ingest(args) -> int:
    """Live feeds, or the records of a capture, to the raw topic, or to a folder of frames where there is no broker."""
    from tidewatch.sources import broker

    if not args.input:
        import signal
        import threading

        from tidewatch.sources.live import live_trades

        stop = threading.Event()
        for s in (signal.SIGINT, signal.SIGTERM):
            signal.signal(s, lambda *_: stop.set())
        registry.publish_contract(registry.service(args.registry))
        running = {}
        for name in args.feeds:
            writer = broker.frames_of(live_trades(_spark(), name, args.symbols)).writeStream.option("checkpointLocation", f"{args.output}/_checkpoint/{name}")
            running[name] = writer.format("kafka").options(**broker.write_options(args.servers, broker.RAW)).start() if args.servers else writer.format("parquet").start(args.output)
        _until(stop, running, args.duration)
        return 0
    frames = broker.frames_of(files.read_capture(_spark(), args.input))
    if args.servers:
        broker.write_batch(frames, args.servers, broker.RAW)
    else:
        frames.select("key", "value", F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset")).write.mode("append").parquet(args.output)
    return 0


def quarantine(args) -> int:
    """What the gate rejected: a list, one message, or counts by rule."""
    rows = _spark().read.parquet(f"{args.path}/quarantine")
    fields = rows.select("key", F.from_json("value", "rule_id string, reason string, detail string, offset long, partition int, ts_ms long, raw_b64 string").alias("e")).select("key", "e.*")
    if args.action == "stats":
        _show({r["rule_id"]: r["n"] for r in gate.quarantine_stats(fields).collect()})
        return 0
    if args.action == "show":
        found = fields.where(F.col("key") == args.key).first()
        if found is None:
            return 1
        _show(found.asDict())
        return 0
    for r in fields.orderBy("partition", "offset", "key").limit(args.limit).collect():
        print(r["key"], r["rule_id"], r["detail"])
    return 0


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tidewatch", description=__doc__)
    commands = out.add_subparsers(dest="command")

    def command(name, handler, *flags, actions=()):
        p = commands.add_parser(name, help=(handler.__doc__ or name).split(".")[0])
        if actions:
            p.add_argument("action", choices=actions)
        for flag, options in flags:
            p.add_argument(flag, **options)
        p.set_defaults(handler=handler)

    rules = ("--rules", {"help": "YAML file of the rules; the contract's by default"})
    pinned = ("--pins", {"help": "file of the fixture's digests"})
    pins = [("--content-sha256", {"default": "", "help": "digest the fixture must have"}), ("--parquet-sha256", {"default": ""})]
    source = [("--path", {"help": "clean trades; generated by default"}), ("--rows", {"type": int, "default": faultlab.ROWS}), ("--seed", {"type": int, "default": faultlab.SEED}), rules, pins[0], pinned]
    servers = ("--servers", {"help": "broker addresses"})
    command("contract", contract, ("--registry", {"default": "http://localhost:8081"}), actions=("register", "check", "show"))
    live = [("--feeds", {"nargs": "+", "default": sorted(feeds.FEEDS)}), ("--symbols", {"nargs": "+", "default": ["BTC-USD", "ETH-USD"]}), ("--duration", {"type": float, "default": 300.0})]
    command("ingest", ingest, ("--input", {"help": "a capture; live feeds if left out"}), ("--output", {"default": "frames"}), ("--registry", {"default": "http://localhost:8081"}), servers, *live)
    command("capture", capture, ("--root", {"default": "captures"}), *live)
    command("sanity", sanity, ("--root", {"default": "captures"}), ("--capture", {}), ("--min", {"nargs": "*", "default": [], "help": "venue=count"}))
    command("gate", run_gate, ("--input", {"default": "frames"}), ("--output", {"default": "gated"}), ("--gates-off", {"action": "store_true"}), ("--max-files", {"type": int}), ("--max-messages", {"type": int}), rules, servers)
    command("bars", run_bars, ("--input", {"help": "clean trades"}), ("--valid", {"help": "output folder of the gate"}), ("--delay", {"default": "1 minute"}), ("--output", {"default": "bars"}), ("--gates-off", {"action": "store_true"}), rules, servers)
    command("fixture", fixture, ("--path", {"default": "fixture"}), ("--rows", {"type": int, "default": faultlab.ROWS}), ("--seed", {"type": int, "default": faultlab.SEED}), *pins, pinned, actions=("generate", "verify"))
    command("slo", run_slo, *source)
    command("metrics", metrics, *source)
    command("export", export, *source, pins[1], ("--output", {"default": "site"}), ("--profile", {"default": "local"}))
    command("quarantine", quarantine, ("--path", {"required": True}), ("--key", {}), ("--limit", {"type": int, "default": 100}), actions=("ls", "show", "stats"))
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if not args.command:
        parser().print_help()
        return 1
    return args.handler(args)


if __name__ == "__main__":
    sys.exit(main())
