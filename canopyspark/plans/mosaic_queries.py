"""Queries on rasters of 256 x 256, larger than a tile's halo and structuring elements, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyspark.functions import colour
from canopyspark.operators import components as cc
from canopyspark.operators import contrast, finish, resize
from canopyspark.operators import pixels as px
from canopyspark.operators.quantiles import quantiles
from canopyspark.plans.inputs import COLOURED_MOSAICS, MOSAICS, WIDE, coloured_mosaics, mosaics, rounded

#: Side of the tiles of these queries, so that a raster has many.
TILE = 64


def mosaic_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles and tails of every mosaic and of its upper half."""
    values = {"every": (F.col("v"), [0.02, 0.25, 0.5, 0.75, 0.98]), "upper": (F.when(F.col("y") < WIDE // 2, F.col("v")), [0.5])}
    found = quantiles(mosaics(spark, sf_dir), values)
    out = found.select("image_key", *(F.col("every")[k].alias(n) for k, n in enumerate(("q02", "q25", "q50", "q75", "q98"))), F.col("upper")[0].alias("upper50"))
    return rounded(out, "q02", "q25", "q50", "q75", "q98", "upper50", places=9)


MOSAIC_QUANTILES = f"""WITH {MOSAICS}
SELECT image_key, {", ".join(f"round(quantile_cont(v, {q}), 9) + 0.0 AS q{n}" for q, n in ((0.02, "02"), (0.25, "25"), (0.5, "50"), (0.75, "75"), (0.98, "98")))},
    round(quantile_cont(v, 0.5) FILTER (WHERE y < {WIDE // 2}), 9) + 0.0 AS upper50 FROM mo GROUP BY image_key"""


def mosaic_blur(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mosaics blurred with five taps."""
    return rounded(px.convolved(mosaics(spark, sf_dir), "v", px.BINOMIAL_5, "blurred").select("image_key", "x", "y", "blurred"), "blurred")


_MIRROR = f"""taps AS (SELECT c - 2 AS d, [1, 4, 6, 4, 1][c + 1] / 16.0 AS k FROM range(0, 5) r(c)),
near AS (SELECT p, CASE WHEN p + d < 0 THEN -(p + d) WHEN p + d > {WIDE - 1} THEN {2 * (WIDE - 1)} - (p + d) ELSE p + d END AS q, k FROM range(0, {WIDE}) r(p), taps)"""
MOSAIC_BLUR = f"""WITH {MOSAICS}, {_MIRROR},
across AS (SELECT image_key, n.p AS x, y, sum(v * k) AS v FROM mo JOIN near n ON n.q = mo.x GROUP BY ALL),
down AS (SELECT image_key, x, n.p AS y, sum(v * k) AS v FROM across JOIN near n ON n.q = across.y GROUP BY ALL)
SELECT image_key, x, y, round(v, 6) + 0.0 AS blurred FROM down"""


def mosaic_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is above a value, eroded and opened by a cross."""
    rows = mosaics(spark, sf_dir).withColumn("m", F.col("v") > -0.1)
    return px.dilated_by(px.eroded_by(rows, "m", "e", (0, 1, 0)), "e", "opened", (0, 1, 0)).select("image_key", "x", "y", "e", "opened")


def _cross(source: str, value: str, fold: str) -> str:
    moved = f"SELECT image_key, x + dx AS x, y + dy AS y, {value} FROM {source}, steps"
    return f"SELECT image_key, x, y, {fold}({value}) AS m FROM ({moved}) WHERE x BETWEEN 0 AND {WIDE - 1} AND y BETWEEN 0 AND {WIDE - 1} GROUP BY ALL"


MOSAIC_OPENING = f"""WITH {MOSAICS}, steps(dx, dy) AS (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)), mk AS (SELECT image_key, x, y, v > -0.1 AS m FROM mo),
er AS ({_cross("mk", "m", "bool_and")}), op AS ({_cross("er", "m", "bool_or")})
SELECT image_key, x, y, er.m AS e, op.m AS opened FROM er JOIN op USING (image_key, x, y)"""


def mosaic_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the mosaics' high values, over tiles of 64: label and area of each."""
    found = cc.components(mosaics(spark, sf_dir).withColumn("m", F.col("v") > 0.12), "m", TILE)
    return found.groupBy("image_key", "label", "area").agg(F.count("*").alias("pixels"), F.max("x").alias("right"), F.max("y").alias("bottom"))


MOSAIC_COMPONENTS = f"""WITH RECURSIVE {MOSAICS}, high AS (SELECT image_key, x, y, y * {WIDE} + x AS id FROM mo WHERE v > 0.12),
steps(dx, dy) AS (SELECT i.c - 1, j.c - 1 FROM range(0, 3) i(c), range(0, 3) j(c)),
pairs AS (SELECT a.image_key, a.id AS a, b.id AS b FROM high a JOIN steps s ON true JOIN high b ON b.image_key = a.image_key AND b.x = a.x + s.dx AND b.y = a.y + s.dy WHERE a.id <> b.id),
reach(image_key, id, root) AS (
    SELECT image_key, id, id FROM high
    UNION
    SELECT p.image_key, p.b, r.root FROM reach r JOIN pairs p ON p.image_key = r.image_key AND p.a = r.id WHERE r.root < p.b),
low AS (SELECT image_key, id, min(root) AS label FROM reach GROUP BY image_key, id)
SELECT image_key, label, count(*) AS area, count(*) AS pixels, max(id % {WIDE}) AS "right", max(id // {WIDE}) AS bottom FROM low GROUP BY image_key, label"""


def mosaic_denoised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bilateral means of the coloured mosaics."""
    out = finish.denoised(coloured_mosaics(spark, sf_dir))
    return out.select("image_key", "x", "y", *(F.col(c).cast("long").alias(c) for c in "rgb"))


_FOLD = f"CASE WHEN {{0}} < 0 THEN -({{0}}) WHEN {{0}} > {WIDE - 1} THEN {2 * (WIDE - 1)} - ({{0}}) ELSE {{0}} END"
MOSAIC_DENOISED = f"""WITH {COLOURED_MOSAICS}, steps AS (SELECT i.c - 2 AS dx, j.c - 2 AS dy FROM range(0, 5) i(c), range(0, 5) j(c) WHERE (i.c - 2) ** 2 + (j.c - 2) ** 2 <= 4),
asked AS (SELECT image_key, x, y, r, g, b, dx, dy, {_FOLD.format("x + dx")} AS sx, {_FOLD.format("y + dy")} AS sy FROM cm, steps),
weighed AS (
    SELECT a.image_key, a.x, a.y, o.r, o.g, o.b, exp(-((abs(o.r - a.r) + abs(o.g - a.g) + abs(o.b - a.b)) ** 2) / 1250.0::DOUBLE - (dx * dx + dy * dy) / 1250.0::DOUBLE) AS k
    FROM asked a JOIN cm o ON o.image_key = a.image_key AND o.x = a.sx AND o.y = a.sy)
SELECT image_key, x, y, {", ".join(f"CAST(round_even(least(greatest(sum({c} * k) / sum(k), 0), 255), 0) AS BIGINT) AS {c}" for c in "rgb")} FROM weighed GROUP BY image_key, x, y"""


def mosaic_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lightness of the coloured mosaics, before and after adaptive equalisation."""
    seen = coloured_mosaics(spark, sf_dir).withColumn("lab", colour.lab(F.col("r"), F.col("g"), F.col("b"))).withColumn("l", F.col("lab.l"))
    out = contrast.equalised(seen, "l", "equalised")
    return out.select("image_key", "x", "y", *(F.col(c).cast("long").alias(n) for c, n in (("l", "l"), ("lab.a", "a"), ("lab.b", "b"), ("equalised", "equalised"))))


_SHARE = "CASE WHEN {0} / 255.0::DOUBLE <= 0.04045 THEN {0} / 255.0::DOUBLE / 12.92 ELSE pow(({0} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) END"
_SUM = lambda row: " + ".join(f"{k}::DOUBLE * l{c}" for k, c in zip(row, "rgb", strict=True))
_CURVE = "CASE WHEN {0} > 0.008856 THEN cbrt({0}) ELSE 7.787 * {0} + 16.0::DOUBLE / 116 END"
_CELL = WIDE // contrast.TILES
_AT = lambda y, x: f"least(greatest({y}, 0), {contrast.TILES - 1}) * {contrast.TILES} + least(greatest({x}, 0), {contrast.TILES - 1})"
MOSAIC_CONTRAST = f"""WITH {COLOURED_MOSAICS},
light AS (SELECT image_key, x, y, {", ".join(f"{_SHARE.format(c)} AS l{c}" for c in "rgb")} FROM cm),
xyz AS (SELECT image_key, x, y, {", ".join(f"({_SUM(row)}) / {white}::DOUBLE AS {n}" for row, white, n in zip(colour.TO_XYZ, colour.WHITE, ("vx", "vy", "vz"), strict=True))} FROM light),
curved AS (SELECT image_key, x, y, vy, {", ".join(f"{_CURVE.format(v)} AS f{v[1]}" for v in ("vx", "vy", "vz"))} FROM xyz),
lab AS (
    SELECT image_key, x, y, {", ".join(f"CAST(least(greatest(floor({e} + 0.5), 0), 255) AS BIGINT) AS {n}" for e, n in (("(CASE WHEN vy > 0.008856 THEN 116.0 * fy - 16.0 ELSE 903.3 * vy END) * 2.55", "l"), ("500.0 * (fx - fy) + 128.0", "a"), ("200.0 * (fy - fz) + 128.0", "b")))}
    FROM curved),
counted AS (SELECT image_key, y // {_CELL} * {contrast.TILES} + x // {_CELL} AS tile, l AS level, count(*) AS n FROM lab GROUP BY ALL),
dense AS (SELECT t.image_key, t.tile, v.level, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT image_key, tile FROM counted) t CROSS JOIN range(0, 256) v(level) LEFT JOIN counted c ON c.image_key = t.image_key AND c.tile = t.tile AND c.level = v.level),
cut AS (SELECT *, greatest(CAST(floor({contrast.CLIP} * {_CELL * _CELL} / 256) AS BIGINT), 1) AS most FROM dense),
spilt AS (SELECT *, sum(greatest(n - most, 0)) OVER (PARTITION BY image_key, tile) AS excess FROM cut),
even AS (
    SELECT image_key, tile, level, least(n, most) + excess // 256 + CASE WHEN excess % 256 > 0 AND level % greatest(256 // greatest(excess % 256, 1), 1) = 0 AND level // greatest(256 // greatest(excess % 256, 1), 1) < excess % 256 THEN 1 ELSE 0 END AS n
    FROM spilt),
curve AS (SELECT image_key, tile, level, round_even(sum(n) OVER (PARTITION BY image_key, tile ORDER BY level) * (255.0::DOUBLE / {_CELL * _CELL}), 0) AS v FROM even),
lines AS (SELECT image_key, list(v ORDER BY tile, level) AS c FROM curve GROUP BY image_key),
corner AS (SELECT *, x / {_CELL}::DOUBLE - 0.5 AS fx, y / {_CELL}::DOUBLE - 0.5 AS fy FROM lab JOIN lines USING (image_key)),
asked AS (SELECT *, CAST(floor(fx) AS BIGINT) AS x1, CAST(floor(fy) AS BIGINT) AS y1 FROM corner),
four AS (SELECT *, {", ".join(f"c[({_AT(y, x)}) * 256 + l + 1] AS {n}" for n, y, x in (("p", "y1", "x1"), ("q", "y1", "x1 + 1"), ("r", "y1 + 1", "x1"), ("s", "y1 + 1", "x1 + 1")))} FROM asked)
SELECT image_key, x, y, l, a, b, CAST(round_even((p * (1 - (fx - x1)) + q * (fx - x1)) * (1 - (fy - y1)) + (r * (1 - (fx - x1)) + s * (fx - x1)) * (fy - y1), 0) AS BIGINT) AS equalised
FROM four"""


def mosaic_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mosaics at 160 x 96: factors 8 to 5 and 8 to 3."""
    return rounded(resize.resized_area(mosaics(spark, sf_dir), WIDE, WIDE, 160, 96, ["v"]), "v")


_COVER = lambda n: f"SELECT s.c AS s, t.c AS t, least((s.c + 1) * {n}, (t.c + 1) * {WIDE}) - greatest(s.c * {n}, t.c * {WIDE}) AS k FROM range(0, {WIDE}) s(c), range(0, {n}) t(c) WHERE least((s.c + 1) * {n}, (t.c + 1) * {WIDE}) > greatest(s.c * {n}, t.c * {WIDE})"
MOSAIC_AREA = f"""WITH {MOSAICS}, ax AS ({_COVER(160)}), ay AS ({_COVER(96)})
SELECT image_key, ax.t AS x, ay.t AS y, round(sum(v * ax.k * ay.k) / {WIDE * WIDE}, 6) + 0.0 AS v FROM mo JOIN ax ON ax.s = mo.x JOIN ay ON ay.s = mo.y GROUP BY image_key, ax.t, ay.t"""


def mosaic_cubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mosaics at 320 x 192 by cubic taps."""
    return rounded(resize.resized_smooth(mosaics(spark, sf_dir), WIDE, WIDE, 320, 192, ["v"]), "v")


def _taps(n: int) -> str:
    far = "abs(f - floor(f) - d)"
    weight = f"CASE WHEN {far} <= 1 THEN (1.25 * {far} - 2.25) * {far} * {far} + 1 ELSE ((-0.75 * {far} + 3.75) * {far} - 6) * {far} + 3 END"
    return f"SELECT t, least(greatest(CAST(floor(f) AS BIGINT) + d, 0), {WIDE - 1}) AS s, {weight} AS k FROM (SELECT c AS t, (c + 0.5::DOUBLE) * {WIDE} / {n} - 0.5 AS f FROM range(0, {n}) r(c)), (SELECT c - 1 AS d FROM range(0, 4) r(c))"


MOSAIC_CUBIC = f"""WITH {MOSAICS}, ax AS ({_taps(320)}), ay AS ({_taps(192)}),
across AS (SELECT image_key, ax.t AS x, y, sum(v * ax.k) AS v FROM mo JOIN ax ON ax.s = mo.x GROUP BY image_key, ax.t, y)
SELECT image_key, x, ay.t AS y, round(sum(v * ay.k), 6) + 0.0 AS v FROM across JOIN ay ON ay.s = across.y GROUP BY image_key, x, ay.t"""


QUERIES = {
    "mosaic_quantiles": (mosaic_quantiles, MOSAIC_QUANTILES), "mosaic_blur": (mosaic_blur, MOSAIC_BLUR), "mosaic_opening": (mosaic_opening, MOSAIC_OPENING), "mosaic_components": (mosaic_components, MOSAIC_COMPONENTS),
    "mosaic_denoised": (mosaic_denoised, MOSAIC_DENOISED), "mosaic_contrast": (mosaic_contrast, MOSAIC_CONTRAST), "mosaic_area": (mosaic_area, MOSAIC_AREA), "mosaic_cubic": (mosaic_cubic, MOSAIC_CUBIC),
}
