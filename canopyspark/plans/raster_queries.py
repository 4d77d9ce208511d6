"""Queries on rasters and point clouds, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyspark.functions import colour
from canopyspark.functions import geometry as g
from canopyspark.operators import components as cc
from canopyspark.operators import pixels as px
from canopyspark.operators import points as pt
from canopyspark.operators import sheets
from canopyspark.plans.inputs import COLOURED, MASKED, NORMALISED, RASTERS, SIDE, coloured, masked, rasters, rounded, table

#: Parameters of the queries: interior share, least counts of the tiers for rasters of 64 pixels, field of view, altitude and tilt, frame.
QUANTILE, MIN_INTERIOR, MIN_FALLBACK, HFOV, ALTITUDE, TILT, FRAME, SPLAT = 0.6, 18, 17, 70.0, 10.0, 7.0, 16, 1


def cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of every raster, its value as depth: the inner 6x6 pixels are original, the mask is what is above the median."""
    marked = px.interior(masked(spark, sf_dir), "mask", "in_crop_interior", QUANTILE)
    flagged = px.min_max_normalised(marked, "v", "d").withColumn("depth_m", g.metric_depth(F.col("d")))
    flagged = flagged.withColumn("is_original", F.col("x").between(1, 6) & F.col("y").between(1, 6)).withColumnRenamed("mask", "in_crop_mask")
    return pt.backproject(flagged.withColumn("w", F.lit(SIDE)).withColumn("h", F.lit(SIDE)).drop("d", "v"), HFOV)


_FX = f"({SIDE} / 2.0 / tan(radians({HFOV}) / 2))"
CLOUD = (
    MASKED
    + f""", ds AS (
    SELECT a.image_key, a.x, a.y, a.mask, CASE WHEN a.mask THEN sqrt(min((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) ELSE 0 END AS dist
    FROM mk a LEFT JOIN mk b ON a.image_key = b.image_key AND NOT b.mask GROUP BY a.image_key, a.x, a.y, a.mask),
lim AS (SELECT image_key, quantile_cont(dist, {1 - QUANTILE}) FILTER (WHERE mask) AS lim FROM ds GROUP BY image_key),
inn AS (SELECT ds.*, mask AND (dist IS NULL OR dist >= lim) AS interior FROM ds JOIN lim USING (image_key)),
nm AS (SELECT *, (v - min(v) OVER (PARTITION BY image_key)) / greatest(max(v) OVER (PARTITION BY image_key) - min(v) OVER (PARTITION BY image_key), 1e-6) AS d FROM px),
pc AS (
    SELECT n.image_key, n.y * {SIDE} + n.x AS point_id, n.x AS u, n.y AS v, (n.x - {SIDE / 2}) * (0.4::DOUBLE + (1 - n.d) * (18.0::DOUBLE - 0.4::DOUBLE)) / {_FX} AS x,
        -(n.y - {SIDE / 2}) * (0.4::DOUBLE + (1 - n.d) * (18.0::DOUBLE - 0.4::DOUBLE)) / {_FX} AS y, 0.4::DOUBLE + (1 - n.d) * (18.0::DOUBLE - 0.4::DOUBLE) AS z,
        n.x BETWEEN 1 AND 6 AND n.y BETWEEN 1 AND 6 AS is_original, i.mask AS in_crop_mask, i.interior AS in_crop_interior
    FROM nm n JOIN inn i USING (image_key, x, y))"""
)
CENTRE = (
    CLOUD
    + f""", tiers AS (
    SELECT image_key, count(*) FILTER (WHERE is_original AND in_crop_interior) AS n1, count(*) FILTER (WHERE is_original AND in_crop_mask) AS n2 FROM pc GROUP BY image_key),
tier AS (SELECT image_key, CASE WHEN (CASE WHEN n1 >= {MIN_INTERIOR} THEN n1 ELSE n2 END) < {MIN_FALLBACK} THEN 'original_region' WHEN n1 >= {MIN_INTERIOR} THEN 'interior' ELSE 'full_crop_mask' END AS tier FROM tiers),
sel AS (SELECT pc.*, tier FROM pc JOIN tier USING (image_key) WHERE is_original AND (tier = 'original_region' OR (tier = 'interior' AND in_crop_interior) OR (tier = 'full_crop_mask' AND in_crop_mask))),
centre AS (
    SELECT image_key, any_value(tier) AS fallback_used, median(x) AS center_x, median(z) AS center_z, quantile_cont(y, 0.9) AS canopy_top_y, count(*) AS point_count FROM sel GROUP BY image_key),
cam AS (SELECT *, center_x AS ex, canopy_top_y + {ALTITUDE} AS ey, center_z AS ez FROM centre)"""
)


def _centres(points: DataFrame) -> DataFrame:
    return pt.crop_centre(points, MIN_INTERIOR, MIN_FALLBACK)


def camera_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    cameras = pt.placed_cameras(_centres(cloud(spark, sf_dir)), ALTITUDE, TILT)
    out = cameras.select("image_key", "fallback_used", "point_count", "center_x", "center_z", "canopy_top_y", F.col("eye.y").alias("eye_y"), F.col("target.y").alias("target_y"), F.col("target.z").alias("target_z"))
    return rounded(out, "center_x", "center_z", "canopy_top_y", "eye_y", "target_y", "target_z")


CAMERA_POSE = f"""WITH {CENTRE}
SELECT image_key, fallback_used, point_count, round(center_x, 6) + 0.0 AS center_x, round(center_z, 6) + 0.0 AS center_z, round(canopy_top_y, 6) + 0.0 AS canopy_top_y,
    round(ey, 6) + 0.0 AS eye_y, round(ey - cos(radians({TILT})) * {ALTITUDE}, 6) + 0.0 AS target_y, round(ez + sin(radians({TILT})) * {ALTITUDE}, 6) + 0.0 AS target_z FROM cam"""


def backproject_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cloud(spark, sf_dir).select("image_key", "point_id", "u", "v", "x", "y", "z", "is_original", "in_crop_mask", "in_crop_interior"), "x", "y", "z")


BACKPROJECT = f"""WITH {CLOUD}
SELECT image_key, point_id, u, v, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(z, 6) + 0.0 AS z, is_original, in_crop_mask, in_crop_interior FROM pc"""


def depth_minmax_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = px.min_max_normalised(rasters(spark, sf_dir), "v", "d")
    return rounded(out.select("image_key", "x", "y", "d", g.metric_depth(F.col("d")).alias("metres")), "d", "metres")


DEPTH_NORM = f"WITH {NORMALISED} SELECT image_key, x, y, round(d, 6) + 0.0 AS d, round(0.4 + (1 - d) * 17.6, 6) + 0.0 AS metres FROM nm"


def affine_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each raster's values aligned to the same cells of the raster turned upside down and halved."""
    both = px.min_max_normalised(rasters(spark, sf_dir), "v", "d")
    pairs = both.select("image_key", "x", "y", "d", (F.lit(1.0) - F.col("d") / 2).alias("t"))
    fit = px.affine_alignment(pairs, "d", "t")
    placed = pairs.join(fit, "image_key").withColumn("aligned", F.least(F.greatest(F.col("a") * F.col("d") + F.col("b"), F.lit(0.0)), F.lit(1.0)))
    return rounded(placed.select("image_key", "x", "y", "a", "b", "aligned"), "a", "b", "aligned", places=5)


AFFINE_ALIGN = f"""WITH {NORMALISED}, pr AS (SELECT image_key, x, y, d, 1 - d / 2 AS t FROM nm),
q AS (SELECT image_key, quantile_cont(d, 0.1) AS s0, quantile_cont(d, 0.9) AS s1, quantile_cont(t, 0.1) AS t0, quantile_cont(t, 0.9) AS t1 FROM pr GROUP BY image_key),
fit AS (SELECT image_key, CASE WHEN abs(s1 - s0) < 1e-6 THEN 1.0 ELSE (t1 - t0) / (s1 - s0) END AS a, s0, t0 FROM q)
SELECT image_key, x, y, round(a, 5) + 0.0 AS a, round(t0 - a * s0, 5) + 0.0 AS b, round(least(greatest(a * d + (t0 - a * s0), 0), 1), 5) + 0.0 AS aligned FROM pr JOIN fit USING (image_key)"""


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    # dealt by image here, so that Spark reuses this shuffle for all that reads the points
    points = cloud(spark, sf_dir).repartition("image_key")
    centres = _centres(points)
    return points, pt.fitted_cameras(pt.selected(points, centres), pt.placed_cameras(centres, ALTITUDE, TILT), FRAME, FRAME)


def virtual_fov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_fitted(spark, sf_dir)[1].select("image_key", "hfov_deg", "fx"), "hfov_deg", "fx", places=5)


_DY, _DZ = "(p.y - c.ey)", "(p.z - c.ez)"
_T = f"radians({TILT})"
_CAM = f"-(p.x - c.ex) AS cx, sin({_T}) * {_DY} + cos({_T}) * {_DZ} AS cy, -cos({_T}) * {_DY} + sin({_T}) * {_DZ} AS cz"
FITTED = (
    CENTRE
    + f""", seen AS (SELECT p.image_key, {_CAM} FROM sel p JOIN cam c USING (image_key)),
ext AS (SELECT image_key, quantile_cont(abs(cx / greatest(cz, 1e-3)), 0.98) AS qx, quantile_cont(abs(cy / greatest(cz, 1e-3)), 0.98) AS qy FROM seen GROUP BY image_key),
foc AS (SELECT image_key, least({FRAME / 2} * 0.8 / greatest(qx, 1e-3), {FRAME / 2} * 0.8 / greatest(qy, 1e-3)) AS f FROM ext),
fov AS (SELECT image_key, least(greatest(degrees(2 * atan({FRAME / 2} / f)), 20), 52) AS hfov_deg FROM foc),
fit AS (SELECT image_key, hfov_deg, {FRAME / 2} / tan(radians(hfov_deg) / 2) AS fx FROM fov)"""
)
VIRTUAL_FOV = f"WITH {FITTED} SELECT image_key, round(hfov_deg, 5) + 0.0 AS hfov_deg, round(fx, 5) + 0.0 AS fx FROM fit"


def zbuffer_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pt.zbuffer(*_fitted(spark, sf_dir), FRAME, FRAME, SPLAT), "z", places=5)


RENDER = (
    FITTED
    + f""", vis AS (
    SELECT p.image_key, p.point_id, p.is_original, f.fx, {_CAM} FROM pc p JOIN cam c USING (image_key) JOIN fit f USING (image_key)),
pix AS (SELECT *, CAST(round_even(cx * fx / cz + {FRAME / 2}, 0) AS BIGINT) AS u0, CAST(round_even(cy * fx / cz + {FRAME / 2}, 0) AS BIGINT) AS v0 FROM vis WHERE cz > {g.NEAR_PLANE}),
spl AS (
    SELECT image_key, point_id, is_original, cz, k AS pass, u0 + k % {2 * SPLAT + 1} - {SPLAT} AS u, v0 + k // {2 * SPLAT + 1} - {SPLAT} AS v
    FROM pix CROSS JOIN (SELECT unnest(range(0, {(2 * SPLAT + 1) ** 2})) AS k)),
zb AS (
    SELECT image_key, u, v, arg_min({{'z': cz, 'id': point_id, 's': NOT is_original}}, {{'z': cz, 'p': pass, 'i': point_id}}) AS b
    FROM spl WHERE u BETWEEN 0 AND {FRAME - 1} AND v BETWEEN 0 AND {FRAME - 1} GROUP BY image_key, u, v)"""
)
ZBUFFER = f"WITH {RENDER} SELECT image_key, u, v, round(b.z, 5) + 0.0 AS z, b.id AS point_id, b.s AS synthesized FROM zb"


def render_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pt.render_coverage(pt.zbuffer(*_fitted(spark, sf_dir), FRAME, FRAME, SPLAT), FRAME, FRAME), "valid_pct", "synthesized_pct")


COVERAGE = f"""WITH {RENDER}
SELECT image_key, round(count(*) * {100.0 / FRAME**2}::DOUBLE, 6) AS valid_pct, round(count(*) FILTER (WHERE b.s) * {100.0 / FRAME**2}::DOUBLE, 6) AS synthesized_pct FROM zb GROUP BY image_key"""


def tilted_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of lineitem as world points (quantity, discount, price) before one tilted camera."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"), F.col("l_discount").alias("y"), (F.col("l_extendedprice") / 1000).alias("z"))
    eye = F.struct(F.lit(25.0).alias("x"), F.lit(12.0).alias("y"), F.lit(1.0).alias("z"))
    seen = rows.withColumn("cam", g.to_camera(F.col("x"), F.col("y"), F.col("z"), eye, 40.0))
    u, v = g.pixel_of(F.col("cam"), F.lit(400.0), F.lit(320.0), F.lit(240.0))
    out = seen.select("l_orderkey", "l_linenumber", F.col("cam.x").alias("cam_x"), F.col("cam.y").alias("cam_y"), F.col("cam.z").alias("cam_z"), u.alias("u"), v.alias("v"))
    return rounded(out.where(F.col("u").between(0, 639) & F.col("v").between(0, 479)), "cam_x", "cam_y", "cam_z", places=5)


TILTED = """WITH p AS (SELECT l_orderkey, l_linenumber, -(l_quantity - 25.0::DOUBLE) AS a, l_discount - 12.0::DOUBLE AS dy, l_extendedprice / 1000 - 1.0::DOUBLE AS dz FROM lineitem),
c AS (SELECT l_orderkey, l_linenumber, a, sin(radians(40.0)) * dy + cos(radians(40.0)) * dz AS b, -cos(radians(40.0)) * dy + sin(radians(40.0)) * dz AS z FROM p),
q AS (SELECT *, CAST(round_even(a * 400 / z + 320, 0) AS BIGINT) AS u, CAST(round_even(b * 400 / z + 240, 0) AS BIGINT) AS v FROM c WHERE z > 0.05)
SELECT l_orderkey, l_linenumber, round(a, 5) + 0.0 AS cam_x, round(b, 5) + 0.0 AS cam_y, round(z, 5) + 0.0 AS cam_z, u, v FROM q WHERE u BETWEEN 0 AND 639 AND v BETWEEN 0 AND 479"""


def hole_fill_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mask's pixels are valid; the others take the nearest value within 2."""
    out = px.holes_filled(masked(spark, sf_dir), "mask", ["v"], 2)
    return rounded(out.select("image_key", "x", "y", F.when(F.col("unsupported"), None).otherwise(F.col("v")).alias("filled"), "newly_filled", "unsupported"), "filled")


HOLE_FILL = f"""WITH {MASKED}, best AS (
    SELECT a.image_key, a.x, a.y, arg_min(b.v, {{'d': (a.x - b.x) ** 2 + (a.y - b.y) ** 2, 'y': b.y, 'x': b.x}}) AS got
    FROM mk a JOIN mk b ON a.image_key = b.image_key AND NOT a.mask AND b.mask AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 4 GROUP BY a.image_key, a.x, a.y)
SELECT mk.image_key, mk.x, mk.y, round(CASE WHEN mask THEN v ELSE got END, 6) + 0.0 AS filled, NOT mask AND got IS NOT NULL AS newly_filled, NOT mask AND got IS NULL AS unsupported
FROM mk LEFT JOIN best USING (image_key, x, y)"""


def border_crop_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a border of an eighth is bad in more than half of its pixels."""
    out = px.border_crop(masked(spark, sf_dir), "mask", 0.125, 0.5)
    return rounded(out.withColumns({c: F.col(c).cast("long") for c in ("x0", "y0", "x1", "y1")}), "bad_share")


BORDER_CROP = f"""WITH {MASKED}, e AS (SELECT image_key, avg(CAST(mask AS DOUBLE)) AS bad_share FROM mk WHERE x IN (0, {SIDE - 1}) OR y IN (0, {SIDE - 1}) GROUP BY image_key)
SELECT image_key, round(bad_share, 6) AS bad_share, bad_share > 0.5 AS did_crop, CAST(bad_share > 0.5 AS BIGINT) AS x0, CAST(bad_share > 0.5 AS BIGINT) AS y0,
    {SIDE} - CAST(bad_share > 0.5 AS BIGINT) AS x1, {SIDE} - CAST(bad_share > 0.5 AS BIGINT) AS y1 FROM e"""


def veg_mask_exg_hsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = coloured(spark, sf_dir)
    r, gr, b = F.col("r"), F.col("g"), F.col("b")
    c = colour.hsv(r, gr, b)
    return rows.select("image_key", "x", "y", c["h"].cast("long").alias("hue"), c["s"].cast("long").alias("saturation"), colour.is_green(r, gr, b).alias("green"), colour.has_excess_green(r, gr, b).alias("excess"), colour.is_vegetation(r, gr, b).alias("vegetation"))


VEGETATION = f"""WITH {COLOURED}, m AS (SELECT *, greatest(r, g, b) AS hi, greatest(r, g, b) - least(r, g, b) AS sp FROM cl),
t AS (SELECT *, CASE WHEN sp = 0 THEN 0.0 WHEN hi = r THEN 60 * (g - b) / sp WHEN hi = g THEN 120 + 60 * (b - r) / sp ELSE 240 + 60 * (r - g) / sp END AS turn FROM m),
h AS (SELECT *, CAST(floor((CASE WHEN turn < 0 THEN turn + 360 ELSE turn END) / 2 + 0.5) AS BIGINT) % 180 AS hue, CASE WHEN hi = 0 THEN 0 ELSE CAST(floor(255 * sp / hi + 0.5) AS BIGINT) END AS saturation FROM t),
f AS (SELECT *, hue BETWEEN 25 AND 100 AND saturation >= 30 AND hi >= 20 AS green, 2 * g - r - b > 15 AS excess FROM h)
SELECT image_key, x, y, hue, saturation, green, excess, green OR excess AS vegetation FROM f"""


def mask_share_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse mask, and the images in which it is too sparse to use."""
    sparse = rasters(spark, sf_dir).withColumn("mask", F.col("v") > 0.2)
    out = px.mask_or_all(sparse, "mask", 0.05)
    return rounded(out.groupBy("image_key").agg((F.avg(F.col("mask").cast("double")) * 100).alias("mask_pct"), F.bool_or("used_fallback").alias("used_fallback")), "mask_pct")


MASK_SHARE = f"""WITH {RASTERS}, s AS (SELECT image_key, avg(CAST(v > 0.2::DOUBLE AS DOUBLE)) AS share FROM px GROUP BY image_key)
SELECT image_key, round(CASE WHEN share < 0.05 THEN 100.0 ELSE share * 100 END, 6) AS mask_pct, share < 0.05 AS used_fallback FROM s"""


def distance_interior(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = px.interior_of(px.squared_distance(masked(spark, sf_dir), "mask", "d2"), "d2", "mask", "interior", QUANTILE)
    return out.select("image_key", "x", "y", F.when(F.col("mask"), F.col("d2")).otherwise(0.0).alias("d2"), "interior")


DISTANCE = f"WITH {CLOUD} SELECT image_key, x, y, round(dist ** 2, 6) AS d2, interior FROM inn"


def morph_open_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a 3x3 cross, as 7x7 would leave nothing of 8x8 pixels; and eroded by 7x7."""
    rows = masked(spark, sf_dir)
    both = px.eroded_by(px.opened_and_closed(rows, "mask", "opened_closed", (0, 1, 0)), "mask", "eroded_7")
    return both.select("image_key", "x", "y", "opened_closed", "eroded_7")


def _cross(source: str, target: str, column: str, function: str) -> str:
    return f"""{target} AS (SELECT a.image_key, a.x, a.y, {function}(b.{column}) AS m FROM {source} a JOIN {source} b ON a.image_key = b.image_key AND abs(a.x - b.x) + abs(a.y - b.y) <= 1 GROUP BY a.image_key, a.x, a.y)"""


MORPH = f"""WITH {MASKED}, m0 AS (SELECT image_key, x, y, mask AS m FROM mk), {_cross("m0", "m1", "m", "bool_and")}, {_cross("m1", "m2", "m", "bool_or")}, {_cross("m2", "m3", "m", "bool_or")}, {_cross("m3", "m4", "m", "bool_and")},
half AS (SELECT unnest([-3, -2, -1, 0, 1, 2, 3]) AS dy, unnest([0, 2, 3, 3, 3, 2, 0]) AS hw),
er AS (
    SELECT a.image_key, a.x, a.y, bool_and(b.mask) AS m FROM mk a CROSS JOIN half h JOIN mk b ON a.image_key = b.image_key AND b.y = a.y + h.dy AND b.x BETWEEN a.x - h.hw AND a.x + h.hw GROUP BY a.image_key, a.x, a.y)
SELECT m4.image_key, m4.x, m4.y, m4.m AS opened_closed, er.m AS eroded_7 FROM m4 JOIN er USING (image_key, x, y)"""


def dilate_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brightest pixels grown by 2."""
    rows = px.min_max_normalised(rasters(spark, sf_dir), "v", "d").withColumn("top", F.col("d") > 0.95)
    return px.dilated(rows, "top", 2, "grown").select("image_key", "x", "y", "top", "grown")


DILATE = f"""WITH {NORMALISED}, t AS (SELECT image_key, x, y, d > 0.95 AS top FROM nm)
SELECT a.image_key, a.x, a.y, a.top, bool_or(b.top) AS grown FROM t a JOIN t b ON a.image_key = b.image_key AND abs(a.x - b.x) <= 2 AND abs(a.y - b.y) <= 2 GROUP BY ALL"""


def gaussian5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(px.convolved(rasters(spark, sf_dir), "v", px.BINOMIAL_5, "blurred").select("image_key", "x", "y", "blurred"), "blurred")


def _blur(source: str, value: str) -> str:
    last = SIDE - 1
    mirrored = f"CASE WHEN p < 0 THEN -p WHEN p > {last} THEN {2 * last} - p ELSE p END"
    return f"""k AS (SELECT unnest([-2, -1, 0, 1, 2]) AS s, unnest([1, 4, 6, 4, 1]) / 16.0::DOUBLE AS w), taps AS (SELECT c AS at, {mirrored} AS src, w FROM (SELECT c, c + s AS p, w FROM range(0, {SIDE}) r(c), k)),
hb AS (SELECT p.image_key, t.at AS x, p.y, sum(p.{value} * t.w) AS v FROM {source} p JOIN taps t ON p.x = t.src GROUP BY ALL),
vb AS (SELECT h.image_key, h.x, t.at AS y, sum(h.v * t.w) AS blurred FROM hb h JOIN taps t ON h.y = t.src GROUP BY ALL)"""


GAUSSIAN = f"WITH {RASTERS}, {_blur('px', 'v')} SELECT image_key, x, y, round(blurred, 6) + 0.0 AS blurred FROM vb"


def components_min_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of 4 pixels or more."""
    return cc.components(masked(spark, sf_dir), "mask").where("area >= 4").select("image_key", "x", "y", "label", "area")


COMPONENTS = f"""WITH RECURSIVE {MASKED}, cells AS (SELECT image_key, x, y, y * {SIDE} + x AS id FROM mk WHERE mask),
reach(image_key, id, root) AS (
    SELECT image_key, id, id FROM cells
    UNION
    SELECT b.image_key, b.id, r.root FROM reach r JOIN cells a ON a.image_key = r.image_key AND a.id = r.id JOIN cells b ON b.image_key = a.image_key AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND r.root < b.id),
low AS (SELECT image_key, id, min(root) AS label FROM reach GROUP BY image_key, id),
sized AS (SELECT *, count(*) OVER (PARTITION BY image_key, label) AS area FROM low)
SELECT s.image_key, c.x, c.y, s.label, s.area FROM sized s JOIN cells c ON c.image_key = s.image_key AND c.id = s.id WHERE area >= 4"""


def reflect_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(px.reflect_padded(rasters(spark, sf_dir), 3, 2).select("image_key", "x", "y", "v", "is_original"), "v")


REFLECT_PAD = f"""WITH {RASTERS}, gx AS (SELECT c AS nx, CASE WHEN c < 3 THEN 3 - c WHEN c - 3 > {SIDE - 1} THEN {2 * (SIDE - 1)} - (c - 3) ELSE c - 3 END AS sx FROM range(0, {SIDE + 6}) r(c)),
gy AS (SELECT c AS ny, CASE WHEN c < 2 THEN 2 - c WHEN c - 2 > {SIDE - 1} THEN {2 * (SIDE - 1)} - (c - 2) ELSE c - 2 END AS sy FROM range(0, {SIDE + 4}) r(c))
SELECT image_key, nx AS x, ny AS y, round(v, 6) + 0.0 AS v, nx BETWEEN 3 AND {SIDE + 2} AND ny BETWEEN 2 AND {SIDE + 1} AS is_original FROM px JOIN gx ON px.x = gx.sx JOIN gy ON px.y = gy.sy"""


def outpaint_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes from part's keys; pads and rings at the default fractions."""
    w, h = F.col("p_partkey") % 900 + 40, F.col("p_size") * 13 + 30
    rows = table(spark, sf_dir, "part").select("p_partkey", w.alias("w"), h.cast("long").alias("h"))
    pad = lambda c: g.padding(F.col(c), 0.45)
    return rows.select("p_partkey", "w", "h", pad("w").alias("pad_x"), pad("h").alias("pad_y"), g.outpaint_steps(F.col("w"), F.col("h"), 0.45, 0.12).alias("steps"))


OUTPAINT_STEPS = """WITH s AS (SELECT p_partkey, p_partkey % 900 + 40 AS w, CAST(p_size AS BIGINT) * 13 + 30 AS h FROM part),
p AS (SELECT *, CAST(round_even(w * 0.45::DOUBLE, 0) AS BIGINT) AS pad_x, CAST(round_even(h * 0.45::DOUBLE, 0) AS BIGINT) AS pad_y, greatest(1, CAST(round_even(w * 0.12::DOUBLE, 0) AS BIGINT)) AS sx, greatest(1, CAST(round_even(h * 0.12::DOUBLE, 0) AS BIGINT)) AS sy FROM s)
SELECT p_partkey, w, h, pad_x, pad_y, CAST(greatest(ceil(pad_x / sx), ceil(pad_y / sy)) AS BIGINT) AS steps FROM p"""


def white_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.white_balanced(coloured(spark, sf_dir)).select("image_key", "x", "y", "r", "g", "b")


def _byte(x: str) -> str:
    return f"CAST(trunc(least(greatest({x}, 0.0), 255.0)) AS INTEGER)"


_GAIN = ", ".join(f"least(greatest((avg(r) + avg(g) + avg(b)) / 3 / greatest(avg({c}), 1.0::DOUBLE), 0.85::DOUBLE), 1.15::DOUBLE) AS g{c}" for c in "rgb")
WHITE_BALANCE = f"""WITH {COLOURED}, gn AS (SELECT image_key, {_GAIN} FROM cl GROUP BY image_key)
SELECT image_key, x, y, {", ".join(f"{_byte(f'{c} * g{c}')} AS {c}" for c in "rgb")} FROM cl JOIN gn USING (image_key)"""


def color_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each raster towards the colours of its halved, brightened copy."""
    rows = coloured(spark, sf_dir)
    reference = px.shrunk(rows, 2, ["r", "g", "b"]).withColumns({c: F.col(c) * 0.5 + 60 for c in "rgb"})
    return px.colour_matched(rows, reference).select("image_key", "x", "y", "r", "g", "b")


_REF = ", ".join(f"avg({c}) * 0.5::DOUBLE + 60 AS {c}" for c in "rgb")
_STATS = ", ".join(f"avg({c}) AS m{c}, stddev_pop({c}) AS s{c}" for c in "rgb")
_MATCH = ", ".join(_byte(f"cl.{c} * 0.75::DOUBLE + least(greatest((cl.{c} - o.m{c}) * ((f.s{c} + 1e-6) / (o.s{c} + 1e-6)) + f.m{c}, 0.0::DOUBLE), 255.0::DOUBLE) * 0.25::DOUBLE") + f" AS {c}" for c in "rgb")
COLOR_MATCH = f"""WITH {COLOURED}, ref AS (SELECT image_key, x // 2 AS x, y // 2 AS y, {_REF} FROM cl GROUP BY image_key, x // 2, y // 2),
o AS (SELECT image_key, {_STATS} FROM cl GROUP BY image_key), f AS (SELECT image_key, {_STATS} FROM ref GROUP BY image_key)
SELECT cl.image_key, cl.x, cl.y, {_MATCH} FROM cl JOIN o ON cl.image_key = o.image_key JOIN f ON cl.image_key = f.image_key"""


def unsharp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.sharpened(coloured(spark, sf_dir), "g", "sharp").select("image_key", "x", "y", "sharp")


UNSHARP = f"""WITH {COLOURED}, {_blur('cl', 'g')} SELECT image_key, x, y, {_byte('g + 0.4::DOUBLE * (g - blurred)')} AS sharp FROM cl JOIN vb USING (image_key, x, y)"""


def resize_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = px.resized_nearest(rasters(spark, sf_dir), SIDE, SIDE, 12, 6)
    return rounded(out.select("image_key", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "v"), "v")


RESIZE_NEAREST = f"""WITH {RASTERS} SELECT image_key, nx AS x, ny AS y, round(v, 6) + 0.0 AS v
FROM px JOIN (SELECT c AS nx, c * {SIDE} // 12 AS sx FROM range(0, 12) r(c)) ON x = sx JOIN (SELECT c AS ny, c * {SIDE} // 6 AS sy FROM range(0, 6) r(c)) ON y = sy"""


def resize_area2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(px.shrunk(rasters(spark, sf_dir), 2, ["v"]), "v")


RESIZE_AREA = f"WITH {RASTERS} SELECT image_key, x // 2 AS x, y // 2 AS y, round(avg(v), 6) + 0.0 AS v FROM px GROUP BY ALL"


def effective_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("p_partkey") * 7 % 6000 + 1, F.col("p_size") * 97
    return rounded(table(spark, sf_dir, "part").select("p_partkey", g.effective_scale(w, h, 2.0, 4096).alias("scale")), "scale")


EFFECTIVE_SCALE = "SELECT p_partkey, round(greatest(1.0, least(2.0, 4096.0::DOUBLE / greatest(p_partkey * 7 % 6000 + 1, p_size * 97))), 6) AS scale FROM part"


def depth_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours of normalised depth."""
    out = px.min_max_normalised(rasters(spark, sf_dir), "v", "d")
    return out.select("image_key", "x", "y", colour.depth_colour(F.round("d", 9)).alias("c")).select("image_key", "x", "y", "c.r", "c.g", "c.b")


def _ramp(channel: int) -> str:
    stops = "[" + ", ".join(f"{c[channel]}.0::DOUBLE" for c in colour.RAMP) + "]"
    return _byte(f"{stops}[k + 1] * (1 - (p - k)) + {stops}[k + 2] * (p - k)")


DEPTH_PREVIEW = f"""WITH {NORMALISED}, pl AS (SELECT image_key, x, y, round(d, 9) * 4 AS p, CAST(least(floor(round(d, 9) * 4), 3) AS INTEGER) AS k FROM nm)
SELECT image_key, x, y, {", ".join(f"{_ramp(n)} AS {c}" for n, c in enumerate("rgb"))} FROM pl"""


def mask_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.outlined(masked(spark, sf_dir), "mask", "edge").select("image_key", "x", "y", "edge")


OUTLINE = f"""WITH {MASKED} SELECT a.image_key, a.x, a.y, a.mask AND count(b.x) < 4 AS edge
FROM mk a LEFT JOIN mk b ON a.image_key = b.image_key AND abs(a.x - b.x) + abs(a.y - b.y) = 1 AND b.mask GROUP BY a.image_key, a.x, a.y, a.mask"""

def mask_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours with the mask's outline and interior drawn in."""
    rows = coloured(spark, sf_dir).join(px.interior(masked(spark, sf_dir), "mask", "interior", QUANTILE).select("image_key", "x", "y", "mask", "interior"), ["image_key", "x", "y"])
    return px.overlaid(rows, "mask", "interior").select("image_key", "x", "y", "r", "g", "b")


_TINT = ", ".join(f"CAST(CASE WHEN o.edge THEN {255 if c == 'r' else 0} WHEN i.interior THEN {_byte(f'cl.{c} * 0.6::DOUBLE + {255 if c == chr(103) else 0} * 0.4::DOUBLE')} ELSE cl.{c} END AS INTEGER) AS {c}" for c in "rgb")
OVERLAY = f"""WITH {COLOURED}{MASKED.removeprefix(RASTERS)}, ds AS (
    SELECT a.image_key, a.x, a.y, a.mask, sqrt(min((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS dist FROM mk a LEFT JOIN mk b ON a.image_key = b.image_key AND NOT b.mask GROUP BY a.image_key, a.x, a.y, a.mask),
lim AS (SELECT image_key, quantile_cont(dist, {1 - QUANTILE}) FILTER (WHERE mask) AS lim FROM ds GROUP BY image_key),
i AS (SELECT ds.image_key, x, y, mask AND (dist IS NULL OR dist >= lim) AS interior FROM ds JOIN lim USING (image_key)),
o AS (SELECT a.image_key, a.x, a.y, a.mask AND count(b.x) < 4 AS edge FROM mk a LEFT JOIN mk b ON a.image_key = b.image_key AND abs(a.x - b.x) + abs(a.y - b.y) = 1 AND b.mask GROUP BY a.image_key, a.x, a.y, a.mask)
SELECT cl.image_key, cl.x, cl.y, {_TINT} FROM cl JOIN i ON cl.image_key = i.image_key AND cl.x = i.x AND cl.y = i.y JOIN o ON cl.image_key = o.image_key AND cl.x = o.x AND cl.y = o.y"""


def look_at_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as world points before a camera placed over them and turned to its target."""
    centre = F.struct(F.lit(50.0).alias("x"), F.lit(12.0).alias("y"), F.lit(3.0).alias("z"))
    axes = g.look_at(centre, g.camera_target(centre, 10.0, 25.0))
    point = F.struct(F.col("s_suppkey").cast("double").alias("x"), (F.col("s_acctbal") / 1000).alias("y"), F.col("s_nationkey").cast("double").alias("z"))
    seen = table(spark, sf_dir, "supplier").select("s_suppkey", g.transformed(point, centre, axes).alias("c"))
    return rounded(seen.select("s_suppkey", F.col("c.x").alias("cam_x"), F.col("c.y").alias("cam_y"), F.col("c.z").alias("cam_z")), "cam_x", "cam_y", "cam_z", places=4)


LOOK_AT = """WITH p AS (SELECT s_suppkey, s_acctbal / 1000 - 12 AS dy, s_nationkey - 3.0 AS dz FROM supplier)
SELECT s_suppkey, round(-(s_suppkey - 50.0), 4) + 0.0 AS cam_x, round(sin(radians(25.0)) * dy + cos(radians(25.0)) * dz, 4) + 0.0 AS cam_y, round(-cos(radians(25.0)) * dy + sin(radians(25.0)) * dz, 4) + 0.0 AS cam_z FROM p"""


def contact_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven rasters a sheet, in tiles of 12 pixels, three in a row."""
    rows = rasters(spark, sf_dir).select((F.floor(F.col("image_key") / 7)).alias("image_key"), (F.col("image_key") % 7).alias("panel"), "x", "y", "v", F.lit(SIDE).alias("w"), F.lit(SIDE).alias("h"))
    return rounded(px.contact_sheet(rows, 12, 3).select("image_key", "panel", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "v"), "v")


CONTACT_SHEET = f"""WITH {RASTERS} SELECT image_key // 7 AS image_key, image_key % 7 AS panel, image_key % 7 % 3 * 12 + nx AS x, image_key % 7 // 3 * 12 + ny AS y, round(v, 6) + 0.0 AS v
FROM px JOIN (SELECT c AS nx, c * {SIDE} // 12 AS sx FROM range(0, 12) r(c)) ON x = sx JOIN (SELECT c AS ny, c * {SIDE} // 12 AS sy FROM range(0, 12) r(c)) ON y = sy"""


def labelled_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven coloured rasters a sheet, in tiles of 24 pixels, three in a row; a tile's label is the name of the nation of its number."""
    rows = coloured(spark, sf_dir).select(F.floor(F.col("image_key") / 7).alias("image_key"), (F.col("image_key") % 7).alias("panel"), "x", "y", "r", "g", "b", F.lit(SIDE).alias("w"), F.lit(SIDE).alias("h"))
    labels = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("panel"), F.col("n_name").alias("label"))
    sheet = sheets.labelled_sheet(rows, labels, 24, 3, 1)
    return sheet.select("image_key", "panel", *(F.col(c).cast("long").alias(c) for c in ("x", "y", "r", "g", "b")))


LABELLED_SHEET = f"""WITH {COLOURED}, gl(letter, gx, gy) AS (VALUES {", ".join(map(str, sheets.lit_cells()))}),
letters AS (SELECT n_nationkey AS panel, upper(n_name) AS label, unnest(range(0, length(n_name))) AS i FROM nation),
dots AS (SELECT panel, i * {sheets.PITCH} + 1 + gx AS dx, 1 + gy AS dy FROM letters JOIN gl ON substr(label, CAST(i + 1 AS BIGINT), 1) = letter)
SELECT image_key // 7 AS image_key, image_key % 7 AS panel, image_key % 7 % 3 * 24 + nx AS x, image_key % 7 // 3 * 24 + ny AS y,
    {", ".join(f"CASE WHEN dx IS NOT NULL THEN 255 WHEN ny < {sheets.BAND} THEN {c} // 4 ELSE {c} END AS {c}" for c in "rgb")}
FROM cl JOIN (SELECT c AS nx, c * {SIDE} // 24 AS sx FROM range(0, 24) r(c)) ON x = sx JOIN (SELECT c AS ny, c * {SIDE} // 24 AS sy FROM range(0, 24) r(c)) ON y = sy
LEFT JOIN dots ON panel = image_key % 7 AND dx = nx AND dy = ny"""


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten points of every raster's cloud."""
    return pt.seeded_sample(cloud(spark, sf_dir), 10).select("image_key", "point_id")


SEEDED = f"""WITH {RASTERS} SELECT image_key, y * {SIDE} + x AS point_id FROM px
QUALIFY row_number() OVER (PARTITION BY image_key ORDER BY md5(image_key || ':' || (y * {SIDE} + x) || ':42')) <= 10"""


def ground_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plane nearest to most points of every raster's cloud."""
    return rounded(pt.ground_planes(cloud(spark, sf_dir), 8, 0.5), "nx", "ny", "nz", "offset")


GROUND_PLANE = f"""WITH {CLOUD},
drawn AS (SELECT * FROM pc QUALIFY row_number() OVER (PARTITION BY image_key ORDER BY md5(image_key || ':' || point_id || ':42')) <= 24),
dealt AS (SELECT *, (row_number() OVER (PARTITION BY image_key ORDER BY point_id) - 1) % 8 AS trial FROM drawn),
corners AS (SELECT image_key, trial, list({{'x': x, 'y': y, 'z': z}} ORDER BY point_id) AS c FROM dealt GROUP BY image_key, trial HAVING count(*) = 3),
sides AS (
    SELECT image_key, trial, c[1] AS a, c[2].x - c[1].x AS ux, c[2].y - c[1].y AS uy, c[2].z - c[1].z AS uz, c[3].x - c[1].x AS vx, c[3].y - c[1].y AS vy, c[3].z - c[1].z AS vz FROM corners),
crossed AS (SELECT image_key, trial, a, uy * vz - uz * vy AS nx, uz * vx - ux * vz AS ny, ux * vy - uy * vx AS nz FROM sides),
sized AS (SELECT *, sqrt(nx * nx + ny * ny + nz * nz) AS size FROM crossed),
planes AS (SELECT image_key, trial, nx / size AS nx, ny / size AS ny, nz / size AS nz, nx / size * a.x + ny / size * a.y + nz / size * a.z AS far FROM sized WHERE size > 1e-12),
counted AS (
    SELECT p.image_key, p.trial, p.nx, p.ny, p.nz, p.far, count(*) FILTER (WHERE abs(p.nx * c.x + p.ny * c.y + p.nz * c.z - p.far) <= 0.5) AS inliers
    FROM planes p JOIN pc c ON p.image_key = c.image_key GROUP BY ALL)
SELECT image_key, round(nx, 6) + 0.0 AS nx, round(ny, 6) + 0.0 AS ny, round(nz, 6) + 0.0 AS nz, round(far, 6) + 0.0 AS "offset", inliers
FROM counted QUALIFY row_number() OVER (PARTITION BY image_key ORDER BY inliers DESC, trial) = 1"""


def seam_feather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster on a mirrored canvas, blurred once in the two pixels next to the original."""
    canvas = px.reflect_padded(rasters(spark, sf_dir), 3, 3)
    return rounded(px.feathered(canvas, "is_original", ["v"], 2, passes=1).select("image_key", "x", "y", "v"), "v")


SEAM = f"""WITH {RASTERS}, g AS (SELECT c AS n, CASE WHEN c < 3 THEN 3 - c WHEN c - 3 > {SIDE - 1} THEN {2 * (SIDE - 1)} - (c - 3) ELSE c - 3 END AS s FROM range(0, {SIDE + 6}) r(c)),
cv AS (SELECT image_key, a.n AS x, b.n AS y, v, a.n BETWEEN 3 AND {SIDE + 2} AND b.n BETWEEN 3 AND {SIDE + 2} AS own, a.n BETWEEN 1 AND {SIDE + 4} AND b.n BETWEEN 1 AND {SIDE + 4} AS near FROM px JOIN g a ON px.x = a.s JOIN g b ON px.y = b.s),
h AS (SELECT *, avg(v) OVER (PARTITION BY image_key, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM cv),
w AS (SELECT *, avg(m) OVER (PARTITION BY image_key, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS mm FROM h)
SELECT image_key, x, y, round(CASE WHEN near AND NOT own THEN mm ELSE v END, 6) + 0.0 AS v FROM w"""

QUERIES = {
    "seam_feather": (seam_feather, SEAM), "mask_overlay": (mask_overlay, OVERLAY), "look_at_projection": (look_at_projection, LOOK_AT), "contact_sheet": (contact_sheet, CONTACT_SHEET), "labelled_sheet": (labelled_sheet, LABELLED_SHEET), "seeded_sample": (seeded_sample, SEEDED),
    "ground_plane": (ground_plane, GROUND_PLANE),
    "camera_pose": (camera_pose, CAMERA_POSE), "backproject_points": (backproject_points, BACKPROJECT), "depth_minmax_norm": (depth_minmax_norm, DEPTH_NORM),
    "affine_align": (affine_align, AFFINE_ALIGN), "virtual_fov": (virtual_fov, VIRTUAL_FOV), "zbuffer_render": (zbuffer_render, ZBUFFER), "render_coverage": (render_coverage, COVERAGE),
    "tilted_projection": (tilted_projection, TILTED), "hole_fill_nearest": (hole_fill_nearest, HOLE_FILL), "border_crop_decision": (border_crop_decision, BORDER_CROP),
    "veg_mask_exg_hsv": (veg_mask_exg_hsv, VEGETATION), "mask_share_fallback": (mask_share_fallback, MASK_SHARE), "distance_interior": (distance_interior, DISTANCE),
    "morph_open_close": (morph_open_close, MORPH), "dilate_square": (dilate_square, DILATE), "gaussian5": (gaussian5, GAUSSIAN), "components_min_area": (components_min_area, COMPONENTS),
    "reflect_pad": (reflect_pad, REFLECT_PAD), "outpaint_steps": (outpaint_steps, OUTPAINT_STEPS), "white_balance": (white_balance, WHITE_BALANCE), "color_match": (color_match, COLOR_MATCH),
    "unsharp": (unsharp, UNSHARP), "resize_nearest": (resize_nearest, RESIZE_NEAREST), "resize_area2": (resize_area2, RESIZE_AREA), "effective_scale": (effective_scale, EFFECTIVE_SCALE),
    "depth_preview": (depth_preview, DEPTH_PREVIEW), "mask_outline": (mask_outline, OUTLINE),
}
