"""What leaves the house: only declared fields, and never the name of a market value."""

from __future__ import annotations

import html
import os
import platform
import re
import subprocess
from collections.abc import Iterator
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.operators.grade import CLASS_RULES, DRAWS, SEED
from tidewatch.operators.slo import INVARIANTS, Comparison

#: Keys that stand for market data.
MARKET_NAMES = ("price", "open", "high", "low", "close", "volume", "vwap", "mid", "bid", "ask", "size", "notional", "ohlcv", "bar_open", "bar_close")

# A schema is a nested dict: a dict is an object whose keys all have to be there, a string is a type, '?' after it allows
# null, and '@name' refers to a definition.
_ESTIMATE = {"point": "float?", "ci_low": "float?", "ci_high": "float?", "n": "int"}
_CLASS = {
    "fault_class": "str", "rule": "str", "n_faults": "int", "n_detected": "int", "n_designed_miss": "int", "n_precision_hits": "int", "n_quarantined_as_rule": "int",
    "precision": "@estimate", "recall": "@estimate",
}
_ARM = {"n_bars": "int", "n_violated_bars": "int", "n_violations": "int", "counts_by_invariant": {i: "int" for i in INVARIANTS}}
SCHEMA: dict[str, Any] = {
    "definitions": {"estimate": _ESTIMATE, "class": _CLASS, "arm": _ARM},
    "root": {
        "grade": {
            "bootstrap_b": "int", "seed": "int", "n_total": "int", "n_controls": "int", "fixture": "str", "manifest_digest": "str",
            "completeness": {"n_total": "int", "n_valid": "int", "n_quarantine": "int", "loss": "int", "duplicate": "int", "ok": "bool"},
            "false_quarantine_rate": {"all_controls": "@estimate", "near_boundary_controls": "@estimate"},
            "per_class": {c: "@class" for c in CLASS_RULES},
        },
        "slo": {
            "n_frames": "int", "designed_miss_dups": "int", "bit_identical": "bool", "thesis_holds": "bool", "fixture": "str", "on_digest": "str", "reference_digest": "str",
            "gates_on": "@arm", "gates_off": "@arm",
        },
        "provenance": {
            "commit": "str", "generated_at": "str", "profile": "str", "runner": "str", "engine_version": "str", "fixture_content_sha256": "str", "fixture_parquet_sha256": "str",
        },
    },
}
_KINDS = {"int": int, "float": float, "str": str, "bool": bool}
VERSION = "0.1"


class Leak(Exception):
    """Something undeclared or market-like is about to be published."""


def undeclared(payload: Any, schema: dict[str, Any] = SCHEMA) -> list[str]:
    """Paths that are undeclared, missing, of another type, or null without leave."""
    definitions = schema.get("definitions", {})

    def target(node: Any) -> Any:
        chain = []
        while isinstance(node, str) and node.startswith("@"):
            if node in chain or node[1:] not in definitions:
                raise Leak(f"the schema refers to {node}, which is {'cyclic' if node in chain else 'missing'}")
            chain.append(node)
            node = definitions[node[1:]]
        return node

    def check(value: Any, node: Any, at: str) -> Iterator[str]:
        node = target(node)
        if isinstance(node, dict):
            if not isinstance(value, dict):
                yield f"{at}: no object"
                return
            yield from (f"{at}.{k}: not declared" for k in value if k not in node)
            yield from (f"{at}.{k}: missing" for k in node if k not in value)
            for k in value.keys() & node.keys():
                yield from check(value[k], node[k], f"{at}.{k}")
        elif value is None:
            if not node.endswith("?"):
                yield f"{at}: null"
        elif node.rstrip("?") not in _KINDS:
            yield f"{at}: unknown type {node} in the schema"
        elif type(value) is not _KINDS[node.rstrip("?")]:
            yield f"{at}: {type(value).__name__} instead of {node}"

    return sorted(check(payload, schema["root"], "$"))


def market_fields(payload: Any, at: str = "$") -> list[str]:
    """Paths of all keys, at any depth, that are market names."""
    if isinstance(payload, dict):
        here = [f"{at}.{k}" for k in payload if k in MARKET_NAMES]
        return here + [p for k, v in payload.items() for p in market_fields(v, f"{at}.{k}")]
    if isinstance(payload, list):
        return [p for i, v in enumerate(payload) for p in market_fields(v, f"{at}[{i}]")]
    return []


def market_columns(df: DataFrame) -> list[str]:
    """The same for the schema of a table, nested fields included."""

    def names(kind: T.DataType, at: str) -> Iterator[str]:
        if isinstance(kind, T.StructType):
            for f in kind:
                if f.name in MARKET_NAMES:
                    yield f"{at}.{f.name}"
                yield from names(f.dataType, f"{at}.{f.name}")
        elif isinstance(kind, T.ArrayType):
            yield from names(kind.elementType, f"{at}[]")
        elif isinstance(kind, T.MapType):
            yield from names(kind.valueType, f"{at}{{}}")

    return list(names(df.schema, "$"))


def market_key_pattern() -> str:
    """A POSIX pattern for such a key in raw JSON text."""
    return f'"({"|".join(sorted(MARKET_NAMES))})"[[:space:]]*:'


def assert_publishable(payload: Any, schema: dict[str, Any] = SCHEMA) -> None:
    for problems in (undeclared(payload, schema), market_fields(payload)):
        if problems:
            raise Leak("; ".join(problems))


def provenance(profile: str, content_sha256: str, parquet_sha256: str, now: datetime | None = None) -> dict[str, str]:
    if not all(isinstance(x, str) and x.strip() for x in (content_sha256, parquet_sha256)):
        raise Leak("the fixture's digests have to be known")
    found = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, cwd=Path(__file__).parent)
    return {
        "commit": found.stdout.strip() or "unknown", "generated_at": (now or datetime.now(UTC)).isoformat(timespec="seconds"), "profile": profile,
        "runner": f"{platform.system()} {platform.machine()}, {os.cpu_count()} cores, Python {platform.python_version()}", "engine_version": VERSION,
        "fixture_content_sha256": content_sha256, "fixture_parquet_sha256": parquet_sha256,
    }


def _arm(counts: dict[str, int]) -> dict[str, Any]:
    return {"n_bars": counts["n_bars"], "n_violated_bars": counts["violated_bars"], "n_violations": counts["n_violations"], "counts_by_invariant": {i: counts[i] for i in INVARIANTS}}


def artifact(graded: dict, counts: dict[str, int], slo: Comparison, label: str, manifest_digest: str, origin: dict[str, str]) -> dict[str, Any]:
    """The published document; ``counts`` are those that ``graded`` came from."""
    done = graded["completeness"]
    per_class = {}
    for name, c in graded["classes"].items():
        k = c["rule"].lower()
        per_class[name] = {
            "fault_class": name, "rule": c["rule"], "n_faults": counts[f"{k}_faults"], "n_detected": counts[f"{k}_caught"], "n_designed_miss": c["designed_misses"],
            "n_precision_hits": counts[f"{k}_caught"], "n_quarantined_as_rule": counts[f"{k}_quarantined"], "precision": c["precision"].as_dict(), "recall": c["recall"].as_dict(),
        }
    rates = graded["false_quarantine"]
    document = {
        "grade": {
            "bootstrap_b": DRAWS, "seed": SEED, "n_total": done["total"], "n_controls": counts["controls"], "fixture": label, "manifest_digest": manifest_digest,
            "completeness": {
                "n_total": done["total"], "n_valid": done["valid"], "n_quarantine": done["quarantined"], "loss": done["loss"], "duplicate": done["duplicate"],
                "ok": done["loss"] == 0 and done["duplicate"] == 0,
            },
            "false_quarantine_rate": {"all_controls": rates["all_controls"].as_dict(), "near_boundary_controls": rates["boundary_controls"].as_dict()},
            "per_class": per_class,
        },
        "slo": {
            "n_frames": done["total"], "designed_miss_dups": sum(c["designed_misses"] for c in graded["classes"].values()), "bit_identical": slo.bit_identical,
            "thesis_holds": slo.thesis_holds, "fixture": label, "on_digest": slo.on_digest, "reference_digest": slo.expected_digest, "gates_on": _arm(slo.on), "gates_off": _arm(slo.off),
        },
        "provenance": origin,
    }
    assert_publishable(document)
    return document


def _shown(e: dict[str, Any]) -> str:
    return f"{e['point']:.4f} [{e['ci_low']:.4f}, {e['ci_high']:.4f}], n = {e['n']:,}" if e["n"] else "n/a (n = 0)"


def _grid(head: list[str], rows: list[list[Any]]) -> str:
    cell = lambda tag, x: f"<{tag}>{html.escape(str(x))}</{tag}>"
    lines = ["".join(cell("th", h) for h in head), *("".join(cell("td", x) for x in r) for r in rows)]
    return "<table>" + "".join(f"<tr>{x}</tr>" for x in lines) + "</table>"


def render(document: dict[str, Any]) -> str:
    """A static page of the document, which is checked once more."""
    assert_publishable(document)
    g, s, p = document["grade"], document["slo"], document["provenance"]
    classes = [[c["fault_class"], c["rule"], _shown(c["recall"]), _shown(c["precision"]), c["n_designed_miss"]] for c in g["per_class"].values()]
    rates = [[k, _shown(v)] for k, v in g["false_quarantine_rate"].items()]
    arms = [[name, a["n_bars"], a["n_violated_bars"], a["n_violations"], *a["counts_by_invariant"].values()] for name, a in (("on", s["gates_on"]), ("off", s["gates_off"]))]
    parts = [
        "<h1>Data-quality gate</h1>", f"<p>{html.escape(g['fixture'])}</p>", "<h2>Fault classes</h2>", _grid(["class", "rule", "recall", "precision", "designed misses"], classes),
        "<h2>False quarantine</h2>", _grid(["controls", "rate"], rates), "<h2>Completeness</h2>", _grid(list(g["completeness"]), [list(g["completeness"].values())]),
        "<h2>Bars</h2>", _grid(["gates", "bars", "violated", "violations", *INVARIANTS], arms), f"<p>Bit-identical: {s['bit_identical']}. Thesis holds: {s['thesis_holds']}.</p>",
        "<h2>Provenance</h2>", _grid(["field", "value"], [[k, v] for k, v in p.items()]),
    ]
    return '<!doctype html><html lang="en"><meta charset="utf-8"><title>Data-quality gate</title><body>' + "\n".join(parts) + "</body></html>\n"


def text_leaks(text: str) -> list[str]:
    """Market keys in raw text."""
    return re.findall(rf'"({"|".join(sorted(MARKET_NAMES))})"\s*:', text)
