"""Typed parameters with their defaults; a YAML file or a dict may override any of them."""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

# Default categories and the classes they are detected as.
CATEGORY_TO_CLASS = {
    "vehicle.car": "car",
    "vehicle.truck": "truck",
    "vehicle.bus.rigid": "bus",
    "vehicle.bus.bendy": "bus",
    "vehicle.trailer": "trailer",
    "vehicle.construction": "construction_vehicle",
    "vehicle.motorcycle": "motorcycle",
    "vehicle.bicycle": "bicycle",
    "human.pedestrian.adult": "pedestrian",
    "human.pedestrian.child": "pedestrian",
    "human.pedestrian.construction_worker": "pedestrian",
    "human.pedestrian.police_officer": "pedestrian",
    "movable_object.trafficcone": "traffic_cone",
    "movable_object.barrier": "barrier",
}
# Evaluation ranges in metres.
CLASS_RANGE = {"car": 50.0, "truck": 50.0, "bus": 50.0, "trailer": 50.0, "construction_vehicle": 50.0, "pedestrian": 40.0, "motorcycle": 40.0, "bicycle": 40.0, "traffic_cone": 30.0, "barrier": 30.0}
# Default sizes (width, length, height) in metres.
SIZE_PRIORS = {
    "car": (1.95, 4.62, 1.73),
    "truck": (2.52, 6.94, 2.84),
    "bus": (2.94, 11.19, 3.47),
    "trailer": (2.92, 12.28, 3.87),
    "construction_vehicle": (2.73, 6.37, 3.19),
    "motorcycle": (0.77, 2.11, 1.47),
    "bicycle": (0.61, 1.70, 1.30),
    "pedestrian": (0.67, 0.73, 1.77),
    "traffic_cone": (0.41, 0.41, 1.07),
    "barrier": (2.49, 0.48, 0.99),
}


@dataclass
class Sensors:
    enabled: list[str] = field(default_factory=lambda: ["CAM_FRONT", "LIDAR_TOP"])
    reference_channel: str = "LIDAR_TOP"
    nominal_hz: dict[str, float] = field(default_factory=lambda: {"camera": 12.0, "lidar": 20.0, "radar": 13.0})


@dataclass
class Etl:
    scenes: list[str] | str = "all"
    include_sweeps: bool = True
    feature_width: int = 320


@dataclass
class Quality:
    sync_tolerance_ms: float = 50.0
    gap_factor: float = 2.5
    min_lidar_points: int = 5000
    min_box_lidar_points: int = 1
    night_max_brightness: float = 90.0
    projection_tolerance: float = 1.3
    max_error_issues: int = 0


@dataclass
class Curation:
    seed: int = 42
    camera_channel: str = "CAM_FRONT"
    val_fraction: float = 0.2
    test_fraction: float = 0.2
    stratify_by: str = "time_of_day"
    min_visibility: int = 2
    min_box_px: float = 6.0
    speed_bins: tuple[float, float] = (0.5, 5.0)
    crowded_min: int = 5
    regression_tags: list[str] = field(default_factory=lambda: ["night", "rain", "has_bicycle", "crowded"])
    categories: dict[str, str] = field(default_factory=lambda: dict(CATEGORY_TO_CLASS))

    @property
    def class_names(self) -> list[str]:
        """Classes in the order in which the categories first name them."""
        return list(dict.fromkeys(self.categories.values()))


@dataclass
class Gate:
    min_map50: float = 0.25
    max_slice_drop: float = 0.10


@dataclass
class Fusion:
    min_score: float = 0.25
    box_shrink: float = 0.1
    ground_clearance: float = 0.3
    min_points: int = 3
    cluster_gap: float = 0.8
    near_percentile: float = 10.0
    depth_sigma: float = 0.2
    mono_factor: float = 0.5
    eval_thresholds: tuple[float, ...] = (0.5, 1.0, 2.0, 4.0)
    tp_threshold: float = 2.0
    class_range: dict[str, float] = field(default_factory=lambda: dict(CLASS_RANGE))

    def __post_init__(self):
        if self.tp_threshold not in self.eval_thresholds:
            raise ValueError(f"tp_threshold {self.tp_threshold} must be one of eval_thresholds {self.eval_thresholds}")


@dataclass
class Params:
    raw_dir: str = "data/raw"
    version: str = "v1.0-mini"
    out_dir: str = "data/out"
    sensors: Sensors = field(default_factory=Sensors)
    etl: Etl = field(default_factory=Etl)
    quality: Quality = field(default_factory=Quality)
    curation: Curation = field(default_factory=Curation)
    gate: Gate = field(default_factory=Gate)
    fusion: Fusion = field(default_factory=Fusion)


def params_from(values: dict[str, Any]) -> Params:
    """Parameters from nested values; an unknown name is an error."""
    sections = {f.name: f for f in dataclasses.fields(Params)}
    made: dict[str, Any] = {}
    for name, value in values.items():
        if name not in sections:
            raise ValueError(f"unknown parameter {name!r}; known: {sorted(sections)}")
        default = getattr(Params(), name)
        if dataclasses.is_dataclass(default):
            known = {f.name for f in dataclasses.fields(default)}
            if unknown := set(value) - known:
                raise ValueError(f"unknown parameter in {name}: {sorted(unknown)}")
            value = type(default)(**{k: tuple(v) if isinstance(getattr(default, k), tuple) else v for k, v in value.items()})
        made[name] = value
    return Params(**made)


def load_params(path: str | None = None) -> Params:
    """From the given file, else from the one FLEETLENS_PARAMS names, else the defaults."""
    path = path or os.environ.get("FLEETLENS_PARAMS")
    if not path:
        return Params()
    import yaml

    return params_from(yaml.safe_load(Path(path).read_text()) or {})
