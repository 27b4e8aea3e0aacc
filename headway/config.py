"""Scoring parameters and weights."""

from __future__ import annotations

from dataclasses import dataclass, fields

# --- fixed values: metric name in the score record -> key in a config file ---
WEIGHT_KEYS = {
    "transit_route_ratio": "transit_route_ratio",
    "service_coverage": "service_coverage",
    "ridership": "ridership",
    "on_time_perf": "on_time_performance",
    "travel_time": "travel_time",
    "transit_auto_time_ratio": "transit_auto_time_ratio",
    "productivity": "productivity",
    "bus_efficiency": "bus_efficiency",
    "bus_effective_travel_distance": "bus_effective_travel_dist",
    "bus_transfer_rate": "bus_transfer",
}
# ------------------------------------------------------------------------------

WEIGHT_TOLERANCE = 1e-9


@dataclass(frozen=True)
class Params:
    coverage_radius: float = 400.0
    early_headway_tolerance: float = 3.0
    late_headway_tolerance: float = 3.0
    travel_time_baseline: float = 54.121
    productivity_baseline: float = 36.0
    bus_types: tuple[str, ...] = ("bus",)
    bus_modes: tuple[str, ...] = ("bus", "pt")


@dataclass(frozen=True)
class Weights:
    transit_route_ratio: float = 0.1
    service_coverage: float = 0.1
    ridership: float = 0.1
    on_time_perf: float = 0.1
    travel_time: float = 0.1
    transit_auto_time_ratio: float = 0.1
    productivity: float = 0.1
    bus_efficiency: float = 0.1
    bus_effective_travel_distance: float = 0.1
    bus_transfer_rate: float = 0.1

    def __post_init__(self):
        total = sum(self.as_dict().values())
        if not abs(total - 1.0) < WEIGHT_TOLERANCE:
            raise ValueError(f"weights must sum to 1.0, got {total}")

    def as_dict(self) -> dict[str, float]:
        return {f.name: float(getattr(self, f.name)) for f in fields(self)}

    @classmethod
    def from_config(cls, section: dict) -> "Weights":
        """Read the ten weights from a config section; integers are fine."""
        return cls(**{name: float(section[key]) for name, key in WEIGHT_KEYS.items()})
