"""Column expressions for cameras and points. World: +X right, +Y up, +Z forward; camera: X right, Y down, Z forward."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres at normalised depth 1 and 0, the least depth that is rendered, and the focal solver's least depth and extent.
NEAR_M, FAR_M = 0.4, 18.0
NEAR_PLANE = 0.05
LEAST = 1e-3


def _double(x) -> Column:
    return x.cast("double") if isinstance(x, Column) else F.lit(float(x))


def metric_depth(d: Column, near: float = NEAR_M, far: float = FAR_M) -> Column:
    """Metres of a normalised depth, 1 being the nearest."""
    return F.lit(near) + (F.lit(1.0) - d) * F.lit(far - near)


def source_focal(width, hfov_deg) -> Column:
    """Focal length in pixels of a camera with this width and horizontal field of view."""
    return (_double(width) / 2) / F.tan(F.radians(_double(hfov_deg)) / 2)


def source_intrinsics(width, height, hfov_deg) -> Column:
    focal = source_focal(width, hfov_deg)
    return F.struct(focal.alias("fx"), focal.alias("fy"), (_double(width) / 2).alias("cx"), (_double(height) / 2).alias("cy"))


def shifted_principal_point(k: Column, dx, dy) -> Column:
    """Intrinsics of the same camera after padding by dx and dy."""
    return k.withField("cx", k["cx"] + dx).withField("cy", k["cy"] + dy)


def backprojected(u: Column, v: Column, depth_m: Column, fx: Column, cx: Column, cy: Column) -> Column:
    """(x, y, z) of a pixel."""
    return F.struct(((u - cx) * depth_m / fx).alias("x"), (-(v - cy) * depth_m / fx).alias("y"), depth_m.alias("z"))


def is_finite(*columns: Column) -> Column:
    """Whether all are numbers, and neither null nor infinite."""
    out = F.lit(True)
    for c in columns:
        out = out & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))
    return F.coalesce(out, F.lit(False))


def camera_eye(center_x: Column, canopy_top_y: Column, center_z: Column, altitude_m) -> Column:
    return F.struct(center_x.alias("x"), (canopy_top_y + altitude_m).alias("y"), center_z.alias("z"))


def camera_target(eye: Column, altitude_m, tilt_deg) -> Column:
    """What the camera looks at: straight down at tilt 0, towards +Z with more."""
    reach, tilt = F.greatest(_double(altitude_m), F.lit(1.0)), F.radians(_double(tilt_deg))
    return F.struct(eye["x"].alias("x"), (eye["y"] - F.cos(tilt) * reach).alias("y"), (eye["z"] + F.sin(tilt) * reach).alias("z"))


def to_camera(x: Column, y: Column, z: Column, eye: Column, tilt_deg) -> Column:
    """(x, y, z) of a world point before a camera at eye, in closed form of its tilt."""
    tilt = F.radians(_double(tilt_deg))
    dy, dz = y - eye["y"], z - eye["z"]
    return F.struct((-(x - eye["x"])).alias("x"), (F.sin(tilt) * dy + F.cos(tilt) * dz).alias("y"), (-F.cos(tilt) * dy + F.sin(tilt) * dz).alias("z"))


def pixel_of(camera_point: Column, fx: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    """Column and row that a camera point falls on, halves to even; null unless it is in front of the camera."""
    front = camera_point["z"] > NEAR_PLANE
    return tuple(F.when(front, F.rint(camera_point[a] * fx / camera_point["z"] + c)).cast("long") for a, c in (("x", cx), ("y", cy)))


def clamped_focal(extent_x: Column, extent_y: Column, out_w, out_h, frame_fill, min_hfov, max_hfov) -> tuple[Column, Column]:
    """(hfov in degrees, focal length) at which the larger extent fills frame_fill of the frame, with the field of view clamped."""
    wide, high = _double(out_w) / 2, _double(out_h) / 2
    focal = F.least(wide * frame_fill / F.greatest(extent_x, F.lit(LEAST)), high * frame_fill / F.greatest(extent_y, F.lit(LEAST)))
    hfov = F.least(F.greatest(F.degrees(F.atan(wide / focal) * 2), _double(min_hfov)), _double(max_hfov))
    return hfov, wide / F.tan(F.radians(hfov) / 2)


def effective_scale(width: Column, height: Column, requested, max_dimension) -> Column:
    """The upscaling that keeps the longer side within max_dimension; never below 1."""
    return F.greatest(F.lit(1.0), F.least(_double(requested), _double(max_dimension) / F.greatest(width, height)))


def padding(size: Column, fraction) -> Column:
    """Pixels of a fraction of a side, halves to even."""
    return F.rint(size * fraction).cast("long")


def outpaint_steps(width: Column, height: Column, pad_fraction, step_fraction) -> Column:
    """Rings that a progressive outpaint grows until both pads are reached."""
    def steps(side: Column) -> Column:
        return F.ceil(padding(side, pad_fraction) / F.greatest(F.lit(1), padding(side, step_fraction)))

    return F.greatest(steps(width), steps(height), F.lit(0)).cast("long")


def _cross(a: Column, b: Column) -> Column:
    return F.struct((a["y"] * b["z"] - a["z"] * b["y"]).alias("x"), (a["z"] * b["x"] - a["x"] * b["z"]).alias("y"), (a["x"] * b["y"] - a["y"] * b["x"]).alias("z"))


def _length(a: Column) -> Column:
    return F.sqrt(a["x"] * a["x"] + a["y"] * a["y"] + a["z"] * a["z"])


def _with(value: Column, use) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _unit(a: Column) -> Column:
    return _with(_length(a) + F.lit(1e-8), lambda size: F.struct(*((a[k] / size).alias(k) for k in "xyz")))


def _vector(x: float, y: float, z: float) -> Column:
    return F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(z).alias("z"))


def look_at(eye: Column, target: Column) -> Column:
    """(right, down, forward): the axes of a camera at eye that looks at target; what is up is +Z, or +X for a view along +Z."""

    def axes(forward: Column, right: Column) -> Column:
        down = _with(_cross(forward, right), lambda up: F.struct(*((-up[k]).alias(k) for k in "xyz")))
        return F.struct(right.alias("right"), down.alias("down"), forward.alias("forward"))

    def turned(forward: Column) -> Column:
        right = _with(_cross(forward, _vector(0.0, 0.0, 1.0)), lambda r: F.when(_length(r) < 1e-6, _cross(forward, _vector(1.0, 0.0, 0.0))).otherwise(r))
        return _with(_with(right, _unit), lambda r: axes(forward, r))

    away = F.struct(*((target[k] - eye[k]).alias(k) for k in "xyz"))
    return _with(_with(away, _unit), turned)


def transformed(point: Column, eye: Column, axes: Column) -> Column:
    """A world point in the frame of a camera's axes."""
    away = {k: point[k] - eye[k] for k in "xyz"}
    return _with(axes, lambda m: F.struct(*(sum((m[a][k] * away[k] for k in "xyz"), F.lit(0.0)).alias(name) for a, name in (("right", "x"), ("down", "y"), ("forward", "z")))))
