"""The rules of the contract as typed thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

RULE_IDS = ("R1", "R2", "R3", "R4", "R5", "R6")
#: The default reasons and the venues that R6 compares.
REASONS = {"R1": "malformed", "R2": "out-of-range", "R3": "duplicate", "R4": "out-of-order", "R5": "gap", "R6": "divergence"}
VENUES = ("coinbase", "kraken")
QUARANTINING, ALERTING = RULE_IDS[:4], RULE_IDS[4:]


@dataclass(frozen=True)
class Rules:
    """Defaults are the contract's."""

    price_min: float = 0.0
    size_min: float = 0.0
    symbol_bounds: dict[str, tuple[float, float]] = field(default_factory=lambda: {"BTC-USD": (1e3, 1e7), "ETH-USD": (50.0, 1e6)})
    dedup_window: int = 10_000
    tolerance_ms: int = 5_000
    gap_ms: int = 60_000
    deviation_pct: float = 0.5
    sustained_ms: int = 10_000
    staleness_ms: int = 30_000
    reasons: dict[str, str] = field(default_factory=lambda: dict(REASONS))
    venues: tuple[str, str] = VENUES

    def __post_init__(self):
        if self.dedup_window < 1 or self.tolerance_ms < 0:
            raise ValueError("the dedup window must be positive and the tolerance not negative")

    @classmethod
    def from_dict(cls, data: dict[str, Any]) -> Rules:
        """All six rules have to be there; the first four quarantine, the last two only alert."""
        rules = {r["id"]: r for r in data.get("rules", [])}
        if missing := [r for r in RULE_IDS if r not in rules]:
            raise ValueError(f"missing rules: {missing}")
        for ids, action in ((QUARANTINING, "quarantine"), (ALERTING, "alert")):
            if wrong := [r for r in ids if rules[r].get("on_violation") != action]:
                raise ValueError(f"rules {wrong} must {action}")
        r2, r3, r4, r5, r6 = (rules[r].get("params", {}) for r in RULE_IDS[1:])
        return cls(
            price_min=float(r2["price_min"]),
            size_min=float(r2["size_min"]),
            symbol_bounds={s: (float(lo), float(hi)) for s, (lo, hi) in r2.get("symbol_bounds", {}).items()},
            dedup_window=int(r3["lru_size"]),
            tolerance_ms=int(r4["tolerance_ms"]),
            gap_ms=int(r5["threshold_ms"]),
            deviation_pct=float(r6["deviation_pct"]),
            sustained_ms=int(r6["sustained_ms"]),
            staleness_ms=int(r6["staleness_ms"]),
            reasons={r: rules[r]["reason"] for r in RULE_IDS},
        )

    @classmethod
    def from_yaml(cls, path: str | Path) -> Rules:
        import yaml

        return cls.from_dict(yaml.safe_load(Path(path).read_text()))
