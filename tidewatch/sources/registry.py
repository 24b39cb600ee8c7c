"""The schema registry: its HTTP interface, and the compatibility rule itself for use without one."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from typing import Any, NamedTuple

from tidewatch.functions.codec import canonical_schema

#: The subject of the raw topic's messages, its compatibility level, and the service's media type.
SUBJECT, COMPATIBILITY, MEDIA_TYPE = "trades.raw-value", "BACKWARD", "application/vnd.schemaregistry.v1+json"
#: Seconds before each further attempt at a service that is starting or overloaded.
PAUSES = (0.5, 2.0)

#: What sends a request: method, path below the service's address, and body, to status and answer.
Send = Callable[[str, str, Any], tuple[int, Any]]


class RegistryError(RuntimeError):
    """The service refused a request: its status and answer."""


class Verdict(NamedTuple):
    """Whether a schema may follow the newest registered one, and what the service has against it."""

    fits: bool
    first: bool
    against: tuple[str, ...] = ()


def service(address: str, timeout: float = 10.0) -> Send:
    """Send requests to the service at ``address``."""

    def send(method: str, path: str, body: Any) -> tuple[int, Any]:
        headers = {"Accept": MEDIA_TYPE, "Content-Type": MEDIA_TYPE}
        ask = urllib.request.Request(address.rstrip("/") + path, json.dumps(body).encode(), headers, method=method)
        try:
            with urllib.request.urlopen(ask, timeout=timeout) as answer:
                return answer.status, json.load(answer)
        except urllib.error.HTTPError as refused:
            with refused:
                return refused.code, json.loads(refused.read() or b"{}")

    return send


def _answer(send: Send, method: str, path: str, body: Any, accepted: tuple[int, ...] = (200,), pause: Callable[[float], None] = time.sleep) -> tuple[int, Any]:
    """The first answer that is neither a lost connection nor a fault of the service itself."""
    for wait in (*PAUSES, None):
        try:
            status, found = send(method, path, body)
        except OSError:
            if wait is None:
                raise
        else:
            if status in accepted:
                return status, found
            if wait is None or status < 500:
                raise RegistryError(f"{method} {path}: {status} {found}")
        pause(wait)
    raise AssertionError


def publish_contract(send: Send, schema: str | None = None, subject: str = SUBJECT, level: str = COMPATIBILITY, pause: Callable[[float], None] = time.sleep) -> int:
    """Set the subject's compatibility level and register the schema under it; the schema's id."""
    _answer(send, "PUT", f"/config/{subject}", {"compatibility": level}, pause=pause)
    return int(_answer(send, "POST", f"/subjects/{subject}/versions", {"schema": schema or canonical_schema()}, pause=pause)[1]["id"])


def verdict(send: Send, schema: str | None = None, subject: str = SUBJECT, pause: Callable[[float], None] = time.sleep) -> Verdict:
    """The schema against the newest version; nothing is registered. Any schema may be the first."""
    path = f"/compatibility/subjects/{subject}/versions/latest?verbose=true"
    status, found = _answer(send, "POST", path, {"schema": schema or canonical_schema()}, (200, 404), pause)
    return Verdict(True, True) if status == 404 else Verdict(bool(found["is_compatible"]), False, tuple(found.get("messages", ())))


#: The promotions that the serialisation's resolution rules allow, by written type.
PROMOTIONS = {"int": {"long", "float", "double"}, "long": {"float", "double"}, "float": {"double"}, "string": {"bytes"}, "bytes": {"string"}}


def _base(kind: Any) -> Any:
    return kind["type"] if isinstance(kind, dict) and isinstance(kind.get("type"), str) else kind


def backward_problems(new: dict[str, Any], old: dict[str, Any]) -> list[str]:
    """Why a reader with ``new`` could not read what was written with ``old``: new fields without a default, changed types."""
    written = {f["name"]: f for f in old["fields"]}
    problems = []
    for f in new["fields"]:
        before = written.get(f["name"])
        if before is None:
            if "default" not in f:
                problems.append(f"{f['name']}: new, and has no default")
            continue
        a, b = _base(before["type"]), _base(f["type"])
        readable = b if isinstance(b, list) else [b]
        if a != b and not all(any(x == _base(r) or (isinstance(x, str) and _base(r) in PROMOTIONS.get(x, ())) for r in readable) for x in (map(_base, a) if isinstance(a, list) else [a])):
            problems.append(f"{f['name']}: written as {a}, read as {b}")
    return problems
