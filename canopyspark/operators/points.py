"""Operators on point clouds: (image_key, point_id, x, y, z, ..., is_original, in_crop_mask, in_crop_interior, is_finite)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopyspark.functions import geometry as g
from canopyspark.operators.quantiles import ranked_quantiles

#: Least counts of interior points and of points in general.
MIN_INTERIOR, MIN_FALLBACK = 50, 10


def backproject(pixels: DataFrame, hfov_deg: float = 70.0, stride: int = 1, depth_m: str = "depth_m") -> DataFrame:
    """Points of every stride-th pixel: x, y, z, point_id in row order, and the pixel relation's flags (a missing origin or crop flag is
    true, a missing interior flag false). pixels has w and h."""
    fx, wide = g.source_focal(F.col("w"), hfov_deg), F.ceil(F.col("w") / stride)
    flags = {"is_original": True, "in_crop_mask": True, "in_crop_interior": False}
    carried = [c for c in pixels.columns if c not in (*flags, "x", "y", "w", "h", depth_m, "image_key")]
    point = g.backprojected(F.col("x"), F.col("y"), F.col(depth_m), fx, F.col("w") / 2.0, F.col("h") / 2.0)
    out = pixels.where((F.col("x") % stride == 0) & (F.col("y") % stride == 0)).withColumn("__p", point)
    known = [(F.coalesce(F.col(k), F.lit(v)) if k in pixels.columns else F.lit(v)).alias(k) for k, v in flags.items()]
    return out.select(
        "image_key", ((F.col("y") / stride).cast("long") * wide + (F.col("x") / stride).cast("long")).cast("long").alias("point_id"), F.col("x").cast("long").alias("u"), F.col("y").cast("long").alias("v"),
        "__p.x", "__p.y", "__p.z", *known, g.is_finite(F.col("__p.x"), F.col("__p.y"), F.col("__p.z")).alias("is_finite"), *carried,
    )


def crop_centre(points: DataFrame, min_interior: int = MIN_INTERIOR, min_fallback: int = MIN_FALLBACK, canopy_quantile: float = 0.9) -> DataFrame:
    """One row per image: center_x, center_z (medians), canopy_top_y (quantile), point_count and fallback_used, over the points of the
    first tier that has enough: interior, full_crop_mask, original_region. An image without an original finite point gets nulls and
    fallback_used 'none'. The tiers' points are counted first, so that statistics are those of the chosen tier alone. Points are dealt by
    image once, or not at all where they lie so already."""
    usable = F.col("is_original") & F.col("is_finite")
    count = lambda what: F.count(F.when(what, 1)).over(Window.partitionBy("image_key"))
    counted = points.withColumns({"n1": count(usable & F.col("in_crop_interior")), "n2": count(usable & F.col("in_crop_mask")), "n3": count(usable)})
    tier = F.when(F.col("n1") >= min_interior, "interior").otherwise("full_crop_mask")
    enough = F.when(F.col("n1") >= min_interior, F.col("n1")).otherwise(F.col("n2")) >= min_fallback
    tiers = counted.withColumn("fallback_used", F.when(F.col("n3") == 0, "none").when(enough, tier).otherwise("original_region"))
    number = F.when(F.col("fallback_used") == "interior", F.col("n1")).when(F.col("fallback_used") == "full_crop_mask", F.col("n2")).otherwise(F.col("n3"))
    chosen = tiers.withColumn("point_count", number).where((F.col("n3") == 0) | (usable & _member()))
    of = lambda c: F.when(F.col("n3") > 0, F.col(c))
    wanted = {"cx": (of("x"), [0.5]), "cz": (of("z"), [0.5]), "top": (of("y"), [canopy_quantile])}
    found = ranked_quantiles(chosen, wanted, [F.max("point_count").alias("point_count"), F.max("fallback_used").alias("fallback_used")])
    return found.select("image_key", F.col("cx")[0].alias("center_x"), F.col("cz")[0].alias("center_z"), F.col("top")[0].alias("canopy_top_y"), "point_count", "fallback_used")


def _member():
    return F.when(F.col("fallback_used") == "interior", F.col("in_crop_interior")).when(F.col("fallback_used") == "full_crop_mask", F.col("in_crop_mask")).otherwise(True)


def selected(points: DataFrame, centres: DataFrame) -> DataFrame:
    """The points that each image's centre was computed from. Centres are one row per image."""
    tier = points.join(centres.select("image_key", "fallback_used"), "image_key")
    return tier.where(F.col("is_original") & F.col("is_finite") & _member())


def placed_cameras(centres: DataFrame, altitude_m: float = 10.0, tilt_deg: float = 0.0) -> DataFrame:
    """centres with eye, target, altitude_m and tilt_deg."""
    eye = g.camera_eye(F.col("center_x"), F.col("canopy_top_y"), F.col("center_z"), F.lit(float(altitude_m)))
    out = centres.withColumn("eye", eye)
    return out.withColumn("target", g.camera_target(F.col("eye"), altitude_m, tilt_deg)).withColumn("altitude_m", F.lit(float(altitude_m))).withColumn("tilt_deg", F.lit(float(tilt_deg)))


def in_camera(points: DataFrame, cameras: DataFrame) -> DataFrame:
    """points with cam, their place before their image's camera."""
    poses = cameras.select("image_key", "eye", "tilt_deg", *(c for c in ("fx", "hfov_deg") if c in cameras.columns))
    return points.join(poses, "image_key").withColumn("cam", g.to_camera(F.col("x"), F.col("y"), F.col("z"), F.col("eye"), F.col("tilt_deg")))


def fitted_cameras(points: DataFrame, cameras: DataFrame, out_w: int, out_h: int, frame_fill: float = 0.8, min_hfov: float = 20.0, max_hfov: float = 52.0, quantile: float = 0.98) -> DataFrame:
    """cameras with fx and hfov_deg, so that the points' robust extent fills frame_fill of the frame."""
    seen = in_camera(points, cameras)
    z = F.greatest(F.col("cam.z"), F.lit(g.LEAST))
    extent = ranked_quantiles(seen, {a: (F.abs(F.col(f"cam.{a}") / z), [quantile]) for a in "xy"})
    hfov, focal = g.clamped_focal(F.col("x")[0], F.col("y")[0], out_w, out_h, frame_fill, min_hfov, max_hfov)
    return cameras.join(extent.select("image_key", hfov.alias("hfov_deg"), focal.alias("fx")), "image_key")


def zbuffer(points: DataFrame, cameras: DataFrame, out_w: int, out_h: int, radius: int = 2, carried: Sequence[str] = ()) -> DataFrame:
    """The nearest point at each pixel (ties: the earlier splat offset, then the smaller point_id): u, v, z, point_id, synthesized, carried.

    Points behind the near plane, or whose splat lies outside the frame, go before the splats are spread; the nearest is kept by a partial
    aggregate before the shuffle, so a pixel under many points is one row per task.
    """
    seen = in_camera(points, cameras)
    u, v = g.pixel_of(F.col("cam"), F.col("fx"), F.lit(out_w / 2.0), F.lit(out_h / 2.0))
    seen = seen.withColumn("u0", u).withColumn("v0", v)
    seen = seen.where(F.col("u0").between(-radius, out_w - 1 + radius) & F.col("v0").between(-radius, out_h - 1 + radius))
    side = 2 * radius + 1
    splat = seen.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(side * side - 1))))
    splat = splat.withColumn("v", F.col("v0") + F.floor(F.col("pass") / side) - radius).withColumn("u", F.col("u0") + F.col("pass") % side - radius)
    splat = splat.where(F.col("u").between(0, out_w - 1) & F.col("v").between(0, out_h - 1))
    order = F.struct(F.col("cam.z").alias("z"), "pass", "point_id")
    kept = F.struct((~F.col("is_original")).alias("synthesized"), *carried)
    best = splat.groupBy("image_key", "u", "v").agg(F.min(F.struct(order.alias("at"), kept.alias("got"))).alias("best"))
    return best.select("image_key", "u", "v", F.col("best.at.z").alias("z"), F.col("best.at.point_id").alias("point_id"), "best.got.*")


def render_coverage(rendered: DataFrame, out_w: int, out_h: int) -> DataFrame:
    """Percentages of the frame that are valid and that are synthesized."""
    share = 100.0 / (out_w * out_h)
    return rendered.groupBy("image_key").agg((F.count("*") * share).alias("valid_pct"), (F.count_if("synthesized") * share).alias("synthesized_pct"))


def seeded_sample(points: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n points of each image, the same ones for the same seed: the first by a hash of image, point and seed. This is the feature asked
    for; nothing else samples."""
    key = F.md5(F.concat_ws(":", F.col("image_key").cast("string"), F.col("point_id").cast("string"), F.lit(str(seed))))
    return points.withColumn("__h", key).withColumn("__n", F.row_number().over(Window.partitionBy("image_key").orderBy("__h"))).where(F.col("__n") <= n).drop("__h", "__n")


def ground_planes(points: DataFrame, trials: int = 32, tolerance: float = 0.05, seed: int = 42) -> DataFrame:
    """image_key, nx, ny, nz, offset, inliers: the plane through three sampled points that most of the image's points lie near (n.p =
    offset; ties go to the earlier trial). Every point is held against every trial's plane; trials are few and fixed."""
    place = Window.partitionBy("image_key").orderBy("point_id")
    drawn = seeded_sample(points.where("is_finite"), 3 * trials, seed).withColumn("__k", F.row_number().over(place) - 1)
    corners = drawn.groupBy("image_key", F.floor(F.col("__k") * 1.0 % trials).cast("int").alias("trial")).agg(F.sort_array(F.collect_list(F.struct("point_id", "x", "y", "z"))).alias("c")).where(F.size("c") == 3)
    a, b, c = (F.col("c")[k] for k in range(3))
    u, v = ({k: p[k] - a[k] for k in "xyz"} for p in (b, c))
    n = {"nx": u["y"] * v["z"] - u["z"] * v["y"], "ny": u["z"] * v["x"] - u["x"] * v["z"], "nz": u["x"] * v["y"] - u["y"] * v["x"]}
    size = F.sqrt(sum((x * x for x in n.values()), F.lit(0.0)))
    planes = corners.select("image_key", "trial", *((x / size).alias(k) for k, x in n.items()), size.alias("__s"), a.alias("a")).where("__s > 1e-12")
    planes = planes.withColumn("offset", F.col("nx") * F.col("a.x") + F.col("ny") * F.col("a.y") + F.col("nz") * F.col("a.z"))
    packed = planes.groupBy("image_key").agg(F.collect_list(F.struct("trial", "nx", "ny", "nz", "offset")).alias("planes"))
    near = F.transform("planes", lambda p: (F.abs(p["nx"] * F.col("x") + p["ny"] * F.col("y") + p["nz"] * F.col("z") - p["offset"]) <= tolerance).cast("long"))
    held = points.where("is_finite").join(packed, "image_key").select("image_key", F.posexplode(F.arrays_zip("planes", near.alias("near"))).alias("k", "v"))
    counted = held.groupBy("image_key", F.col("v.planes").alias("p")).agg(F.sum("v.near").alias("inliers"))
    best = counted.groupBy("image_key").agg(F.max_by(F.struct("p", "inliers"), F.struct("inliers", -F.col("p.trial"))).alias("best"))
    return best.select("image_key", "best.p.nx", "best.p.ny", "best.p.nz", "best.p.offset", "best.inliers")
