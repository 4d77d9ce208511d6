"""Settings of the photograph pipeline, in groups, checked together."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, fields

# Names and defaults below are fixed values: those of the public settings that users of such a pipeline know.


@dataclass(frozen=True)
class RunSettings:
    """How a run goes, not what it gives; no part of the hash."""

    RECURSIVE: bool = True
    OVERWRITE: bool = False
    RESUME: bool = True
    CONTINUE_ON_ERROR: bool = True
    SAVE_DEBUG_VISUALIZATION: bool = False


@dataclass(frozen=True)
class OutpaintSettings:
    AI_OUTPAINT_ENABLED: bool = True
    AI_OUTPAINT_PAD_FRAC: float = 0.45
    AI_OUTPAINT_STEP_FRAC: float = 0.12
    AI_OUTPAINT_OVERLAP_PX: int = 96
    AI_OUTPAINT_FEATHER_PX: int = 48
    AI_OUTPAINT_MAX_SIDE: int = 2048
    AI_OUTPAINT_MAX_RETRIES: int = 3
    AI_OUTPAINT_PROGRESSIVE: bool = True


@dataclass(frozen=True)
class CameraSettings:
    ASSUMED_HFOV_DEG: float = 70.0
    ALTITUDE_M: float = 10.0
    TILT_DEGREES: float = 0.0
    CROP_INTERIOR_QUANTILE: float = 0.6
    CAMERA_FRAME_FILL: float = 0.9
    MIN_VIRTUAL_HFOV_DEG: float = 20.0
    MAX_VIRTUAL_HFOV_DEG: float = 52.0


@dataclass(frozen=True)
class RenderSettings:
    BACKPROJECT_STRIDE: int = 2
    SPLAT_RADIUS: int = 2
    FILL_RADIUS: int = 3
    POST_WARP_SUPER_RESOLUTION_ENABLED: bool = True
    POST_WARP_SUPER_RESOLUTION_SCALE: float = 2.0
    POST_WARP_SUPER_RESOLUTION_TILE: int = 256
    POST_WARP_SUPER_RESOLUTION_TILE_PAD: int = 16
    POST_WARP_MAX_OUTPUT_DIMENSION: int = 4096


@dataclass(frozen=True)
class PipelineConfig(RenderSettings, CameraSettings, OutpaintSettings, RunSettings):
    def problems(self) -> list[str]:
        value = asdict(self)
        between = {
            "ASSUMED_HFOV_DEG": (0, 180), "MIN_VIRTUAL_HFOV_DEG": (0, 180), "MAX_VIRTUAL_HFOV_DEG": (0, 180), "ALTITUDE_M": (0, None), "AI_OUTPAINT_MAX_SIDE": (0, None),
            "POST_WARP_MAX_OUTPUT_DIMENSION": (0, None), "POST_WARP_SUPER_RESOLUTION_SCALE": (1, None), "POST_WARP_SUPER_RESOLUTION_TILE": (0, None),
        }
        found = [f"{k} must be above {low}" + (f" and below {high}" if high else "") for k, (low, high) in between.items() if not (value[k] > low and (not high or value[k] < high))]
        least = {"AI_OUTPAINT_PAD_FRAC": 0, "AI_OUTPAINT_OVERLAP_PX": 0, "AI_OUTPAINT_FEATHER_PX": 0, "AI_OUTPAINT_MAX_RETRIES": 0, "SPLAT_RADIUS": 0, "FILL_RADIUS": 0, "BACKPROJECT_STRIDE": 1, "POST_WARP_SUPER_RESOLUTION_TILE_PAD": 0}
        found += [f"{k} must be at least {low}" for k, low in least.items() if not value[k] >= low]
        found += [f"{k} must be above 0 and at most 1" for k in ("AI_OUTPAINT_STEP_FRAC", "CROP_INTERIOR_QUANTILE", "CAMERA_FRAME_FILL") if not 0 < value[k] <= 1]
        if not 0 <= self.TILT_DEGREES < 90:
            found.append("TILT_DEGREES must be at least 0 and below 90")
        if not self.MIN_VIRTUAL_HFOV_DEG < self.MAX_VIRTUAL_HFOV_DEG:
            found.append("MIN_VIRTUAL_HFOV_DEG must be below MAX_VIRTUAL_HFOV_DEG")
        return found

    def validate(self) -> None:
        """Raises ValueError with every problem found."""
        if found := self.problems():
            raise ValueError("; ".join(found))

    def content_hash(self) -> str:
        """The same for settings that give the same results."""
        run_only = {f.name for f in fields(RunSettings)}
        kept = {k: v for k, v in asdict(self).items() if k not in run_only}
        return hashlib.sha256(json.dumps(kept, sort_keys=True).encode()).hexdigest()[:16]

    def part_hash(self, names: tuple[str, ...]) -> str:
        """The same for configurations that agree in these settings."""
        value = asdict(self)
        return hashlib.sha256(json.dumps([[n, value[n]] for n in sorted(names)]).encode()).hexdigest()[:16]
