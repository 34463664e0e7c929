"""Declared recipes of long CSV deliveries, read from JSON and checked before anything runs."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Indicator:
    table: str
    unit: str | None = None
    multiplier: float = 1.0
    least: float | None = None
    most: float | None = None


@dataclass(frozen=True)
class Recipe:
    """How a delivery's columns and codes map to tables: columns, indicators, what is ignored, what means missing."""

    indicators: dict[str, Indicator]
    columns: dict[str, str] = field(default_factory=lambda: {c: c for c in ("code", "indicator", "year", "value", "unit")})
    ignored_indicators: tuple[str, ...] = ()
    ignored_codes: tuple[str, ...] = ()
    missing: tuple[str, ...] = ()
    missing_numeric: tuple[float, ...] = ()
    policy: str = "prefer_new_non_null"

    def __post_init__(self) -> None:
        if self.policy not in ("prefer_new_non_null", "replace", "keep_old", "hold"):
            raise ValueError(f"unknown policy {self.policy}")
        if not self.indicators:
            raise ValueError("a recipe needs an indicator")
        if any(t.strip() in ("0", "0.0", "-0") for t in self.missing) or 0 in self.missing_numeric:
            raise ValueError("zero is an observation and can't be declared missing")
        for name, i in self.indicators.items():
            numbers = [x for x in (i.multiplier, i.least, i.most) if x is not None]
            if any(isinstance(x, bool) or not math.isfinite(x) for x in numbers) or i.multiplier == 0:
                raise ValueError(f"{name}: numbers must be finite and the multiplier not zero")
        if set(self.indicators) & set(self.ignored_indicators):
            raise ValueError("an indicator is both mapped and ignored")

    @classmethod
    def parse(cls, text: str) -> Recipe:
        """A recipe from JSON; unknown keys are errors."""
        raw = json.loads(text)
        known = set(cls.__dataclass_fields__)
        if set(raw) - known:
            raise ValueError(f"unknown keys {sorted(set(raw) - known)}")
        raw["indicators"] = {k: Indicator(**v) for k, v in raw.get("indicators", {}).items()}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})
