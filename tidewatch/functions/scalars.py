"""Scalar column functions; all are built-in expressions and stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BAR_MS = 60_000
MICROS = 1_000_000
#: Canonical symbols and what the second venue calls them.
VENUE_SYMBOLS: dict[str, str] = {"BTC-USD": "BTC/USD", "ETH-USD": "ETH/USD"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_millis(text: str | Column) -> Column:
    """Epoch milliseconds of an ISO-8601 time; fractions beyond microseconds are cut, null where it is no time."""
    trimmed = F.regexp_replace(F.trim(_col(text)), r"(\.\d{6})\d+", "$1")
    return F.unix_millis(F.try_to_timestamp(trimmed))


def normalise_side(side: str | Column) -> Column:
    clean = F.lower(F.trim(_col(side)))
    return F.when(clean.isin("buy", "sell"), clean).otherwise(F.lit("unknown"))


def canonical_symbol(venue_symbol: str | Column) -> Column:
    """The canonical name of a venue's symbol; unknown symbols pass."""
    c = _col(venue_symbol)
    pairs = F.create_map(*[F.lit(x) for k, v in VENUE_SYMBOLS.items() for x in (v, k)])
    return F.coalesce(F.try_element_at(pairs, c), c)


def venue_symbol(symbol: str | Column) -> Column:
    c = _col(symbol)
    pairs = F.create_map(*[F.lit(x) for k, v in VENUE_SYMBOLS.items() for x in (k, v)])
    return F.coalesce(F.try_element_at(pairs, c), c)


def bar_start(ts_ms: str | Column, width_ms: int = BAR_MS) -> Column:
    """Start of the bucket; floors before the epoch too."""
    c = _col(ts_ms)
    return c - F.pmod(c, F.lit(width_ms))


def to_micros(value: str | Column) -> Column:
    """Fixed-point units, half to even: their sums do not depend on order."""
    return F.rint(_col(value) * F.lit(float(MICROS))).cast("long")


def from_micros(micros: str | Column) -> Column:
    return _col(micros) / F.lit(float(MICROS))


def clamp(value: str | Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), _col(value)))


def message_key(exchange: str | Column = "exchange", symbol: str | Column = "symbol", trade_id: str | Column = "trade_id") -> Column:
    return F.concat_ws("|", _col(exchange), _col(symbol), _col(trade_id)).cast("binary")


def stream_name(exchange: str | Column = "exchange", symbol: str | Column = "symbol") -> Column:
    return F.concat_ws(":", _col(exchange), _col(symbol))


def format_estimate(point: Column, low: Column, high: Column, n: Column) -> Column:
    return F.when(n == 0, F.lit("n/a (n=0)")).otherwise(F.format_string("%.4f [%.4f, %.4f]", point, low, high))
