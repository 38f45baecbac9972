"""Run parameters, passed explicitly to every job that needs them."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields

# The event, outcome and tier vocabularies and the default settings.
EVENT_TYPES = (
    "booking_requested",
    "booking_confirmed",
    "booking_cancelled",
    "session_started",
    "session_ended",
)
OUTCOMES = ("confirmed_attended", "no_show", "cancelled", "pending")
TIERS = ("Gold", "Silver", "Bronze")

# Where each setting lives in a settings file, as (section, key).
_FILE_KEYS = {
    "default_minutes": ("session", "default_duration_minutes"),
    "group_a": ("rebooking", "tiers_group_a"),
    "group_b": ("rebooking", "tiers_group_b"),
    "window_days": ("rebooking", "window_days"),
    "max_orphan_rate": ("data_quality", "max_orphan_rate"),
    "max_minutes": ("data_quality", "max_duration_minutes"),
    "warehouse": ("database", "path"),
    "known_tiers": (None, "known_tiers"),
    "environment": (None, "environment"),
}


@dataclass(frozen=True)
class Params:
    default_minutes: int = 30
    group_a: tuple[str, ...] = ("Gold",)
    group_b: tuple[str, ...] = ("Silver", "Bronze")
    window_days: int | None = 30
    max_orphan_rate: float = 0.05
    max_minutes: int = 240
    known_tiers: tuple[str, ...] = TIERS
    environment: str = "dev"
    warehouse: str | None = None

    def __post_init__(self):
        for f in fields(self):
            value = getattr(self, f.name)
            if isinstance(value, list):
                object.__setattr__(self, f.name, tuple(value))

    @property
    def label_a(self) -> str:
        return "/".join(self.group_a)

    @property
    def label_b(self) -> str:
        return "/".join(self.group_b)

    @property
    def warehouse_path(self) -> str:
        """The configured root, or the environment's own: only prod is unsuffixed."""
        if self.warehouse:
            return self.warehouse
        suffix = f"_{self.environment}" if self.environment in ("dev", "staging") else ""
        return f"warehouse{suffix}"

    def check(self) -> "Params":
        """Raise ``ValueError`` naming every rule the settings break; else return self."""
        shared = sorted({*self.group_a} & {*self.group_b})
        broken = {
            "group_a names no tier": not self.group_a,
            "group_b names no tier": not self.group_b,
            f"groups must be exclusive but share {shared}": bool(shared),
            f"default_minutes is {self.default_minutes}, not positive": self.default_minutes <= 0,
            f"window_days is {self.window_days}, neither positive nor None": self.window_days is not None
            and self.window_days <= 0,
        }
        found = [rule for rule, holds in broken.items() if holds]
        if found:
            raise ValueError("; ".join(found))
        return self

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_mapping(cls, data: dict) -> "Params":
        """Build from nested settings; a missing section or key keeps its default."""
        found = {}
        for name, (section, key) in _FILE_KEYS.items():
            holder = data if section is None else (data.get(section) or {})
            if key in holder:
                found[name] = holder[key]
        return cls(**found)

    @classmethod
    def from_yaml(cls, path: str) -> "Params":
        """Read a YAML settings file. A file that is named must be there and be readable."""
        import yaml

        with open(path, encoding="utf-8") as handle:
            return cls.from_mapping(yaml.safe_load(handle) or {})
