"""Contrast-limited adaptive equalisation as relations: histograms of tiles, clipped cumulative curves, and four curves mixed at each pixel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopyspark.functions import colour

#: Tiles a side, and how far above the mean a histogram's level may rise.
TILES, CLIP = 8, 1.5


def _shown_at(at: Column, size: Column, whole: Column) -> Column:
    """The places of a line that is mirrored up to `whole` pixels (the border not repeated) at which a pixel is seen."""
    period = 2 * (size - 1)
    both = F.array_union(F.sequence(at, whole - 1, period), F.when(period - at < whole, F.sequence(period - at, whole - 1, period)).otherwise(F.array().cast("array<long>")))
    return F.when(size == 1, F.sequence(F.lit(0).cast("long"), whole - 1)).otherwise(both)


def tile_curves(pixels: DataFrame, level: str, tiles: int = TILES, clip: float = CLIP) -> DataFrame:
    """image_key, tile_w, tile_h and curves: for each of tiles x tiles tiles, row by row, the 256 levels that the curve gives.

    An image that tiles don't divide is mirrored at the right and lower border. A level counts up to the limit, what is above it is spread
    evenly over all levels, and the rest of that over levels at equal steps.
    """
    size = pixels.groupBy("image_key").agg((F.max("x") + 1).cast("long").alias("w"), (F.max("y") + 1).cast("long").alias("h"))
    size = size.withColumns({"tile_w": F.ceil(F.col("w") / tiles), "tile_h": F.ceil(F.col("h") / tiles)})
    seen = pixels.select("image_key", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.col(level).cast("int").alias("level")).join(size, "image_key")
    seen = seen.withColumn("px", F.explode(_shown_at(F.col("x"), F.col("w"), F.col("tile_w") * tiles)))
    seen = seen.withColumn("py", F.explode(_shown_at(F.col("y"), F.col("h"), F.col("tile_h") * tiles)))
    tile = (F.floor(F.col("py") / F.col("tile_h")) * tiles + F.floor(F.col("px") / F.col("tile_w"))).cast("int")
    counts = seen.groupBy("image_key", "tile_w", "tile_h", tile.alias("tile"), "level").agg(F.count("*").alias("n"))
    packed = counts.groupBy("image_key", "tile_w", "tile_h", "tile").agg(F.map_from_entries(F.collect_list(F.struct("level", "n"))).alias("counts"))
    every = packed.select("image_key", "tile_w", "tile_h", "tile", "counts", F.explode(F.sequence(F.lit(0), F.lit(255))).alias("level"))
    area = F.col("tile_w") * F.col("tile_h")
    limit = F.greatest(F.floor(F.lit(float(clip)) * area / 256), F.lit(1))
    every = every.select("image_key", "tile_w", "tile_h", "tile", "level", F.coalesce(F.col("counts")[F.col("level")], F.lit(0)).alias("n"), area.alias("area"), limit.alias("limit"))
    whole = Window.partitionBy("image_key", "tile")
    spread = every.withColumn("excess", F.sum(F.greatest(F.col("n") - F.col("limit"), F.lit(0))).over(whole)).withColumn("rest", F.col("excess") % 256)
    step = F.greatest(F.expr("256 div greatest(rest, 1)"), F.lit(1))
    bonus = F.when((F.col("level") % step == 0) & (F.expr("level div greatest(256 div greatest(rest, 1), 1)") < F.col("rest")), 1).otherwise(0)
    spread = spread.withColumn("n", F.least("n", "limit") + F.expr("excess div 256") + bonus)
    upto = F.sum("n").over(whole.orderBy("level"))
    curve = spread.withColumn("to", F.least(F.greatest(F.rint(upto * (255.0 / F.col("area"))), F.lit(0.0)), F.lit(255.0)).cast("int"))
    lines = curve.groupBy("image_key", "tile_w", "tile_h", "tile").agg(F.transform(F.array_sort(F.collect_list(F.struct("level", "to"))), lambda c: c["to"]).alias("curve"))
    return lines.groupBy("image_key", "tile_w", "tile_h").agg(F.transform(F.array_sort(F.collect_list(F.struct("tile", "curve"))), lambda c: c["curve"]).alias("curves"))


def equalised(pixels: DataFrame, level: str, out: str, tiles: int = TILES, clip: float = CLIP) -> DataFrame:
    """pixels with out: level (0 to 255) through the curves of the four tiles around, mixed by distance from their centres."""
    placed = pixels.join(tile_curves(pixels, level, tiles, clip), "image_key")
    fx, fy = F.col("x") / F.col("tile_w") - 0.5, F.col("y") / F.col("tile_h") - 0.5
    inside = lambda c: F.least(F.greatest(c, F.lit(0)), F.lit(tiles - 1)).cast("int")
    x1, y1 = F.floor(fx), F.floor(fy)
    at = lambda y, x: F.col("curves")[inside(y) * tiles + inside(x)][F.col(level).cast("int")].cast("double")
    a, b = fx - x1, fy - y1
    upper, lower = at(y1, x1) * (1.0 - a) + at(y1, x1 + 1) * a, at(y1 + 1, x1) * (1.0 - a) + at(y1 + 1, x1 + 1) * a
    mixed = F.least(F.greatest(F.rint(upper * (1.0 - b) + lower * b), F.lit(0.0)), F.lit(255.0))
    return placed.withColumn(out, mixed.cast("int")).drop("tile_w", "tile_h", "curves")


def locally_contrasted(pixels: DataFrame, tiles: int = TILES, clip: float = CLIP) -> DataFrame:
    """r, g, b with their lightness equalised tile by tile; the colour axes stay."""
    seen = pixels.withColumn("__lab", colour.lab(F.col("r"), F.col("g"), F.col("b"))).withColumn("__l", F.col("__lab.l"))
    fresh = equalised(seen, "__l", "__l", tiles, clip).withColumn("__rgb", colour.from_lab(F.col("__l"), F.col("__lab.a"), F.col("__lab.b")))
    return fresh.withColumns({c: F.col(f"__rgb.{c}") for c in "rgb"}).select(*pixels.columns)
