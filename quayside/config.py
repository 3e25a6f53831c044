"""Settings of the five entry points."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, replace
from typing import Any

try:
    import yaml
except ImportError:  # settings can be JSON then
    yaml = None

EARTH_KM = 6371.0
ANCHORAGE_LEVEL, VISIT_LEVEL = 14, 9
THIN_SECONDS = 300
MAX_SPEED = 102.2


# The names of the settings in configuration files.
SETTINGS = {
    "anchorage_entry_distance_km": "entry_km",
    "anchorage_exit_distance_km": "exit_km",
    "min_required_positions": "min_positions",
    "min_unique_vessels_for_anchorage": "min_vessels",
    "minimum_port_gap_duration_minutes": "min_gap",
    "stationary_period_max_distance_km": "stationary_km",
    "stationary_period_min_duration_minutes": "stationary_minutes",
    "stopped_begin_speed_knots": "stop_begin",
    "stopped_end_speed_knots": "stop_end",
    "label_distance_km": "label_km",
    "sublabel_distance_km": "sublabel_km",
    "override_path": "override_path",
    "port_list_paths": "port_lists",
}


@dataclass(frozen=True)
class Config:
    """Distances in km, speeds in knots, times in minutes. The defaults are the production values."""

    entry_km: float = 3.0
    exit_km: float = 4.0
    min_positions: int = 200
    min_vessels: int = 20
    min_gap: int = 240
    stationary_km: float = 0.5
    stationary_minutes: int = 720
    stop_begin: float = 0.2
    stop_end: float = 0.5
    label_km: float = 4.0
    sublabel_km: float = 1.0
    max_interseg_nm: float = 60.0
    max_events: int = 200
    override_source: str = "anchorage_overrides"
    override_path: str | None = None
    port_lists: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        # A level-9 neighbourhood must reach beyond the exit distance on every side.
        if max(self.entry_km, self.exit_km) * 2 >= 2 * 2 ** (13 - VISIT_LEVEL):
            raise ValueError("entry and exit distances are too large for the visit cells")
        if self.min_gap >= 1440:
            raise ValueError("min_gap must be under one day")


def load_config(path: str | None, **more: Any) -> Config:
    """The settings of a YAML or JSON file, the defaults for what it leaves out; an unknown name is an error. Paths in it that are
    not absolute start at the file's folder. more: settings that go before the file's."""
    given: dict[str, Any] = {}
    if path is not None:
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if yaml is None and not path.endswith(".json"):
            raise ValueError("YAML settings need the yaml package; give them as .json")
        read = (json.loads(text) if path.endswith(".json") else yaml.safe_load(text)) or {}
        if unknown := sorted(set(read) - set(SETTINGS)):
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        given = {SETTINGS[k]: v for k, v in read.items()}
        at = lambda p: p if "://" in p else os.path.join(os.path.dirname(os.path.abspath(path)), p)
        if given.get("override_path"):
            given["override_path"] = at(given["override_path"])
        given["port_lists"] = tuple(at(p) for p in given.get("port_lists") or ())
    return replace(Config(), **(given | more))
