"""Digests: one over a canonical JSON text in row order, and one that merges over partitions."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.codec import NAMES


def json_text(value: Any) -> str:
    return json.dumps(value, separators=(",", ":"), sort_keys=True)


def content_digest(records: Iterable[dict[str, Any]]) -> str:
    """SHA-256 of the records' canonical JSON, a line each. Streams through its input."""
    out = hashlib.sha256()
    for k, r in enumerate(records):
        out.update((("\n" if k else "") + json_text({n: r[n] for n in NAMES})).encode())
    return out.hexdigest()


def list_digest(items: Iterable[Any]) -> str:
    """SHA-256 of the canonical JSON of a list, item by item."""
    out = hashlib.sha256(b"[")
    for k, x in enumerate(items):
        out.update((("," if k else "") + json_text(x)).encode())
    out.update(b"]")
    return out.hexdigest()


def verdicts_digest(verdicts: DataFrame) -> str:
    """Routing, records and alert identities in arrival order; details are for humans and left out."""
    rows = verdicts.orderBy("seq").select("disposition", "rule_id", "reason", "record", "alerts").toLocalIterator()

    def canonical(r):
        alerts = [{"rule_id": a["rule_id"], "reason": a["reason"], "stream": a["stream"], "at": a["at_event_ms"]} for a in r["alerts"]]
        return {"disposition": r["disposition"], "rule_id": r["rule_id"], "reason": r["reason"], "record": r["record"] and r["record"].asDict(), "alerts": alerts}

    return list_digest(map(canonical, rows))


def bars_digest(bars: DataFrame) -> str:
    """Market content of the bars in canonical order, without the taint."""
    cols = ["exchange", "symbol", "bar_start_ms", "bar_open", "high", "low", "bar_close", "volume", "trade_count"]
    return list_digest(list(r) for r in bars.orderBy("exchange", "symbol", "bar_start_ms").select(*cols).toLocalIterator())


def equality_digest(df: DataFrame) -> str:
    """A digest of the rows as a multiset, aggregated where they are: equal tables have equal ones, at any size and order."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)")).alias(f"s{k}") for k in range(4)]
    sums = df.agg(F.count(F.lit(1)).alias("n"), *parts).first()
    return hashlib.sha256(":".join(str(x) for x in sums).encode()).hexdigest()
