"""Operators on pixel relations: (image_key, x, y, ...), one row per pixel of a whole grid. An image is the unit of partitioning; rows
and columns of an image are finer units wherever an operator allows it."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopyspark.functions.colour import byte
from canopyspark.operators.groups import run_starts, whole_groups
from canopyspark.operators.quantiles import quantiles
from canopyspark.operators.tiles import by_tiles, separable, swept

#: Half widths of the rows of a 7x7 elliptic structuring element.
ELLIPSE_7 = (0, 2, 3, 3, 3, 2, 0)
#: A 5-tap binomial kernel.
BINOMIAL_5 = (1 / 16, 4 / 16, 6 / 16, 4 / 16, 1 / 16)


def _image(*keys: str):
    return Window.partitionBy("image_key", *keys)


def min_max_normalised(pixels: DataFrame, value: str, out: str) -> DataFrame:
    low, high = F.min(value).over(_image()), F.max(value).over(_image())
    return pixels.withColumn(out, (F.col(value) - low) / F.greatest(high - low, F.lit(1e-6)))


def affine_alignment(pairs: DataFrame, source: str, target: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """image_key, a, b: the line through two quantiles of source and target; without a spread of source, a shift."""
    both = quantiles(pairs, {"s": (F.col(source), [low, high]), "t": (F.col(target), [low, high])})
    spread = F.col("s")[1] - F.col("s")[0]
    a = F.when(F.abs(spread) < 1e-6, 1.0).otherwise((F.col("t")[1] - F.col("t")[0]) / spread)
    return both.withColumn("a", a).select("image_key", "a", (F.col("t")[0] - F.col("a") * F.col("s")[0]).alias("b"))


def mask_or_all(pixels: DataFrame, mask: str, least_share: float = 0.05) -> DataFrame:
    """mask, or true everywhere in images in which it covers less than least_share; and used_fallback."""
    fallback = F.avg(F.col(mask).cast("double")).over(_image()) < least_share
    return pixels.withColumn("used_fallback", fallback).withColumn(mask, F.col(mask) | F.col("used_fallback"))


def _by_image(pixels: DataFrame) -> DataFrame:
    """Dealt by image once: windows over rows and over columns of images then need no further shuffle."""
    return pixels.repartition("image_key")


def _rows(key: str, along: str, back: int, ahead: int):
    return _image(key).orderBy(along).rowsBetween(-back, ahead)


def dilated(pixels: DataFrame, mask: str, k: int, out: str) -> DataFrame:
    """mask grown by a square of 2k + 1 pixels: two one-dimensional windows."""
    wide = _by_image(pixels).withColumn("__wide", F.max(mask).over(_rows("y", "x", k, k)))
    return wide.withColumn(out, F.max("__wide").over(_rows("x", "y", k, k))).drop("__wide")


def eroded_by(pixels: DataFrame, mask: str, out: str, halves: Sequence[int] = ELLIPSE_7) -> DataFrame:
    return by_tiles(pixels, [mask], _reach(halves), lambda a, there: {out: swept(a[mask], there, halves, False)}, {out: "boolean"})


def dilated_by(pixels: DataFrame, mask: str, out: str, halves: Sequence[int] = ELLIPSE_7) -> DataFrame:
    return by_tiles(pixels, [mask], _reach(halves), lambda a, there: {out: swept(a[mask], there, halves, True)}, {out: "boolean"})


def opened_and_closed(pixels: DataFrame, mask: str, out: str, halves: Sequence[int] = ELLIPSE_7) -> DataFrame:
    """Small specks go, small holes fill: four sweeps, for which tiles have halos four times as wide as one needs."""

    def kernel(arrays, there):
        value = arrays[mask]
        for grow in (False, True, True, False):
            value = swept(value, there, halves, grow)
        return {out: value}

    return by_tiles(pixels, [mask], 4 * _reach(halves), kernel, {out: "boolean"})


def _reach(halves: Sequence[int]) -> int:
    return max(*halves, len(halves) // 2)


def convolved(pixels: DataFrame, values: str | Sequence[str], kernel: Sequence[float], out: str | Sequence[str]) -> DataFrame:
    """A separable kernel with mirrored borders (the border itself not repeated) over one column, or over several at once."""
    values, out = ([c] if isinstance(c, str) else list(c) for c in (values, out))
    blur = lambda a, there: {o: separable(a[v], kernel) for v, o in zip(values, out, strict=True)}
    return by_tiles(pixels, values, len(kernel) // 2, blur, dict.fromkeys(out, "double"))


def gaussian_kernel(sigma: float) -> list[float]:
    """Weights of a normalised Gaussian, cut at four sigmas."""
    import math

    half = max(1, round(4 * sigma))
    weights = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-half, half + 1)]
    return [w / sum(weights) for w in weights]


def box_blurred(pixels: DataFrame, values: Sequence[str], radius: int, passes: int = 3) -> DataFrame:
    """Means over squares, repeated; three passes with a radius of sigma come near a Gaussian. Pixels outside the image don't count."""
    pixels = _by_image(pixels)
    for _ in range(passes):
        for key, along in (("y", "x"), ("x", "y")):
            line = _rows(key, along, radius, radius)
            pixels = pixels.withColumns({v: F.avg(v).over(line) for v in values})
    return pixels


def feathered(pixels: DataFrame, original: str, values: Sequence[str], width: int, passes: int = 3) -> DataFrame:
    """values blurred in the band of generated pixels within width of an original one; originals and what is farther off stay."""
    if width < 1:
        return pixels
    kept = pixels.withColumns({f"__{v}": F.col(v).cast("double") for v in values})
    band = dilated(box_blurred(kept, [f"__{v}" for v in values], max(1, round(width / 3)), passes), original, width, "__band")
    inside = F.col("__band") & ~F.col(original)
    kinds = dict(pixels.dtypes)
    fresh = {v: F.when(inside, F.col(f"__{v}").cast(kinds[v])).otherwise(F.col(v)) for v in values}
    return band.withColumns(fresh).drop("__band", *(f"__{v}" for v in values))


def sharpened(pixels: DataFrame, values: str | Sequence[str], out: str | Sequence[str], amount: float = 0.4, kernel: Sequence[float] = BINOMIAL_5) -> DataFrame:
    """Values plus amount of their difference from their blur, as bytes."""
    values, out = ([c] if isinstance(c, str) else list(c) for c in (values, out))
    blurred = convolved(pixels, values, kernel, [f"__blur_{v}" for v in values])
    fresh = {o: byte(F.col(v) + amount * (F.col(v) - F.col(f"__blur_{v}"))) for v, o in zip(values, out, strict=True)}
    return blurred.withColumns(fresh).drop(*(f"__blur_{v}" for v in values))


def squared_distance(pixels: DataFrame, mask: str, out: str) -> DataFrame:
    """Exact squared distance of each mask pixel to the nearest pixel outside the mask, in its image; null where there is none, 0 outside.

    Separable: the nearest one in the column by windows, then the least sum over the row's columns, for whole rows at a time, in steps of
    one column as far as the distances found so far let it matter. A row is the largest unit held.
    """
    up = F.last(F.when(~F.col(mask), F.col("y")), True).over(_image("x").orderBy("y").rowsBetween(Window.unboundedPreceding, 0))
    down = F.first(F.when(~F.col(mask), F.col("y")), True).over(_image("x").orderBy("y").rowsBetween(0, Window.unboundedFollowing))
    near = _by_image(pixels).withColumn("__g", F.least(F.col("y") - up, down - F.col("y")).cast("double"))
    names = near.columns

    def run(batches):
        for rows in whole_groups(batches, ["image_key", "y"]):
            table = pa.Table.from_batches([rows])
            start = run_starts(rows, ["image_key", "y"])
            g = table.column("__g").to_numpy()
            yield rows.append_column(out, pa.array(_least_sums(g * g, start), pa.float64(), from_pandas=True))

    schema = ", ".join(f"`{n}` {t}" for n, t in near.dtypes) + f", `{out}` double"
    return near.select(*names).sortWithinPartitions("image_key", "y", "x").mapInArrow(run, schema).drop("__g")


def _least_sums(column: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each place of each row (rows begin at start), the least of column + squared distance over the row; nan where all are."""
    far = np.where(np.isnan(column), np.inf, column)
    best, size = far.copy(), len(far)
    row = np.repeat(np.arange(len(start)), np.diff(np.append(start, size)))
    step, longest = 1, int(np.diff(np.append(start, size)).max(initial=1))
    while step < longest and (open_places := best > step * step).any():
        same = row[step:] == row[:-step]
        best[:-step] = np.where(same & open_places[:-step], np.minimum(best[:-step], far[step:] + step * step), best[:-step])
        best[step:] = np.where(same & open_places[step:], np.minimum(best[step:], far[:-step] + step * step), best[step:])
        step += 1
    return np.where(np.isinf(best), np.nan, best)


def interior(pixels: DataFrame, mask: str, out: str, quantile: float = 0.6) -> DataFrame:
    """The share of the mask's pixels farthest from its border, ties included; a mask without a border is all interior."""
    return interior_of(squared_distance(pixels, mask, "__d2"), "__d2", mask, out, quantile).drop("__d2")


def interior_of(pixels: DataFrame, distance: str, mask: str, out: str, quantile: float = 0.6) -> DataFrame:
    """interior where squared distances are known. Distances are read once; the limit's buffer counts an image's distinct ones, which are
    roots of whole numbers and so few."""
    far = pixels.withColumn("__d", F.sqrt(distance))
    limit = F.percentile(F.when(F.col(mask), F.col("__d")), 1.0 - quantile).over(_image())
    return far.withColumn("__limit", limit).withColumn(out, F.col(mask) & (F.col("__d").isNull() | (F.col("__d") >= F.col("__limit")))).drop("__d", "__limit")


def holes_filled(pixels: DataFrame, valid: str, values: Sequence[str], radius: int) -> DataFrame:
    """Invalid pixels within radius of a valid one take the nearest one's values (ties: first by row, then by column), flagged
    newly_filled; the others are unsupported. Only invalid pixels are spread over the disc."""
    disc = [(dx, dy) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if 0 < dx * dx + dy * dy <= radius * radius]
    steps = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in disc))
    asked = pixels.where(~F.col(valid)).select("image_key", "x", "y", F.explode(steps).alias("step"))
    asked = asked.select("image_key", F.col("x").alias("ox"), F.col("y").alias("oy"), (F.col("x") + F.col("step.dx")).alias("x"), (F.col("y") + F.col("step.dy")).alias("y"), (F.col("step.dx") * F.col("step.dx") + F.col("step.dy") * F.col("step.dy")).alias("d2"))
    there = pixels.where(F.col(valid)).select("image_key", "x", "y", F.struct(*values).alias("got"))
    found = asked.join(there, ["image_key", "x", "y"]).groupBy("image_key", F.col("ox").alias("x"), F.col("oy").alias("y")).agg(F.min_by("got", F.struct("d2", "y", "x")).alias("got"))
    out = pixels.join(found, ["image_key", "x", "y"], "left")
    for v in values:
        out = out.withColumn(v, F.when(F.col(valid), F.col(v)).otherwise(F.col(f"got.{v}")))
    filled = ~F.col(valid) & F.col("got").isNotNull()
    return out.withColumn("newly_filled", filled).withColumn("unsupported", ~F.col(valid) & F.col("got").isNull()).drop("got")


def fill_smoothed(pixels: DataFrame, values: Sequence[str], kernel: Sequence[float] = BINOMIAL_5) -> DataFrame:
    """values of newly filled pixels blurred, so that copied patches don't show; all others stay."""
    kinds, blurs = dict(pixels.dtypes), [f"__blur_{v}" for v in values]
    fresh = {v: F.when(F.col("newly_filled"), F.floor(F.least(F.greatest(F.col(b) + 0.5, F.lit(0.0)), F.lit(255.0))).cast(kinds[v])).otherwise(F.col(v)) for v, b in zip(values, blurs, strict=True)}
    return convolved(pixels, values, kernel, blurs).withColumns(fresh).drop(*blurs)


def mask_view(pixels: DataFrame, mask: str, out: str) -> DataFrame:
    """A mask as a picture: 255 inside, 0 outside."""
    return pixels.withColumn(out, F.when(F.col(mask), 255).otherwise(0))


def border_crop(pixels: DataFrame, bad: str, border: float = 0.05, most_bad: float = 0.15) -> DataFrame:
    """image_key, bad_share, did_crop, and the part of the frame that stays: x0, y0 and, exclusive, x1, y1."""
    size = pixels.groupBy("image_key").agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("h"))
    size = size.withColumn("bw", F.greatest(F.lit(1), F.floor(F.col("w") * border))).withColumn("bh", F.greatest(F.lit(1), F.floor(F.col("h") * border)))
    framed = pixels.join(size, "image_key")
    edge = (F.col("x") < F.col("bw")) | (F.col("x") >= F.col("w") - F.col("bw")) | (F.col("y") < F.col("bh")) | (F.col("y") >= F.col("h") - F.col("bh"))
    judged = framed.groupBy("image_key", "w", "h", "bw", "bh").agg(F.avg(F.when(edge, F.col(bad).cast("double"))).alias("bad_share"))
    crop = F.col("bad_share") > most_bad
    margin = lambda c: F.when(crop, F.col(c)).otherwise(0)
    return judged.select("image_key", "bad_share", crop.alias("did_crop"), margin("bw").alias("x0"), margin("bh").alias("y0"), (F.col("w") - margin("bw")).alias("x1"), (F.col("h") - margin("bh")).alias("y1"))


def cropped(pixels: DataFrame, frames: DataFrame) -> DataFrame:
    """Pixels within their image's frame, counted from its corner; every column of the relation is cropped together."""
    inside = pixels.join(frames.select("image_key", "x0", "y0", "x1", "y1"), "image_key").where("x >= x0 AND x < x1 AND y >= y0 AND y < y1")
    return inside.withColumn("x", F.col("x") - F.col("x0")).withColumn("y", F.col("y") - F.col("y0")).drop("x0", "y0", "x1", "y1")


def reflect_padded(pixels: DataFrame, pad_x: int, pad_y: int) -> DataFrame:
    """The canvas with mirrored borders (the border itself not repeated) and is_original; pads smaller than the sides. Each pixel is sent
    to the places that show it, so nothing is joined."""
    w, h = F.max("x").over(_image()) + 1, F.max("y").over(_image()) + 1

    def places(at: Column, size: Column, pad: int) -> Column:
        every = F.array(at, -at, 2 * (size - 1) - at)
        return F.array_distinct(F.filter(every, lambda p: (p >= -pad) & (p < size + pad)))

    sized = pixels.withColumn("__w", w).withColumn("__h", h)
    wide = sized.withColumn("__x", F.explode(places(F.col("x"), F.col("__w"), pad_x)))
    both = wide.withColumn("__y", F.explode(places(F.col("y"), F.col("__h"), pad_y)))
    inside = (F.col("__x") == F.col("x")) & (F.col("__y") == F.col("y"))
    return both.withColumn("is_original", inside).withColumn("x", F.col("__x") + pad_x).withColumn("y", F.col("__y") + pad_y).drop("__x", "__y", "__w", "__h")


def embedded(canvas: DataFrame, block: DataFrame, pad_x: int, pad_y: int, values: Sequence[str]) -> DataFrame:
    """The canvas with an original block pasted at (pad_x, pad_y), and is_original."""
    moved = block.select("image_key", (F.col("x") + pad_x).alias("x"), (F.col("y") + pad_y).alias("y"), F.struct(*values).alias("__own"))
    out = canvas.join(moved, ["image_key", "x", "y"], "left").withColumn("is_original", F.col("__own").isNotNull())
    for v in values:
        out = out.withColumn(v, F.coalesce(F.col(f"__own.{v}"), F.col(v)))
    return out.drop("__own")


def _places(at: Column, old, new: int) -> Column:
    low, high = F.ceil(at * new / old).cast("int"), (F.ceil((at + 1) * new / old) - 1).cast("int")
    return F.explode(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>")))


def resized_nearest(pixels: DataFrame, w, h, new_w: int, new_h: int) -> DataFrame:
    """Each source pixel goes to the places whose source it is: an interval on either axis. w and h are numbers or columns."""
    return pixels.withColumn("x", _places(F.col("x"), w, new_w)).withColumn("y", _places(F.col("y"), h, new_h))


def contact_sheet(panels: DataFrame, side: int = 320, columns: int = 5) -> DataFrame:
    """Pixels with panel (from 0), w and h as one sheet for each image: square tiles of a side, row by row."""
    tiles = resized_nearest(panels, F.col("w"), F.col("h"), side, side)
    return tiles.withColumn("x", F.col("panel") % columns * side + F.col("x")).withColumn("y", F.floor(F.col("panel") / columns) * side + F.col("y")).drop("w", "h")


def crossed(pixels: DataFrame, x: str, y: str, size: int = 6) -> DataFrame:
    """r, g, b with a yellow cross at each image's (x, y), which are columns."""
    at = ((F.col("x") == F.col(x)) & (F.abs(F.col("y") - F.col(y)) <= size)) | ((F.col("y") == F.col(y)) & (F.abs(F.col("x") - F.col(x)) <= size))
    return pixels.withColumns({c: F.when(at, 0 if c == "b" else 255).otherwise(F.col(c)) for c in "rgb"})


def overlaid(pixels: DataFrame, mask: str, interior: str, strength: float = 0.4) -> DataFrame:
    """r, g, b with the mask's outline in red and its interior tinted green."""
    edged = outlined(pixels, mask, "__edge")
    tint = {"r": 0, "g": 255, "b": 0}
    fresh = {c: F.when(F.col("__edge"), 255 if c == "r" else 0).when(F.col(interior), byte(F.col(c) * (1 - strength) + tint[c] * strength)).otherwise(F.col(c)) for c in "rgb"}
    return edged.withColumns(fresh).drop("__edge")


def shrunk(pixels: DataFrame, factor: int, values: Sequence[str]) -> DataFrame:
    """Means over squares of factor x factor pixels."""
    key = [F.floor(F.col(a) / factor).alias(a) for a in ("x", "y")]
    return pixels.groupBy("image_key", *key).agg(*(F.avg(v).alias(v) for v in values))


def white_balanced(pixels: DataFrame, channels: Sequence[str] = ("r", "g", "b"), low: float = 0.85, high: float = 1.15) -> DataFrame:
    """Channels scaled towards a common mean, by gains within low and high."""
    means = pixels.groupBy("image_key").agg(*(F.avg(c).alias(f"__{c}") for c in channels))
    grey = sum((F.col(f"__{c}") for c in channels), F.lit(0.0)) / len(channels)
    gains = means.select("image_key", *(F.least(F.greatest(grey / F.greatest(F.col(f"__{c}"), F.lit(1.0)), F.lit(low)), F.lit(high)).alias(f"__{c}") for c in channels))
    out = pixels.join(gains, "image_key")
    return out.withColumns({c: byte(F.col(c) * F.col(f"__{c}")) for c in channels}).drop(*(f"__{c}" for c in channels))


def colour_matched(pixels: DataFrame, reference: DataFrame, channels: Sequence[str] = ("r", "g", "b"), strength: float = 0.25) -> DataFrame:
    """Channels moved by strength towards the mean and deviation of the reference's; two small aggregates, no pixel join."""
    stats = lambda df, name: df.groupBy("image_key").agg(*(f(c).alias(f"__{name}{k}{c}") for c in channels for k, f in (("m", F.avg), ("s", F.stddev_pop))))
    out = pixels.join(stats(pixels, "own"), "image_key").join(stats(reference, "ref"), "image_key")
    fresh = {}
    for c in channels:
        matched = (F.col(c) - F.col(f"__ownm{c}")) * ((F.col(f"__refs{c}") + 1e-6) / (F.col(f"__owns{c}") + 1e-6)) + F.col(f"__refm{c}")
        fresh[c] = byte(F.col(c) * (1 - strength) + F.least(F.greatest(matched, F.lit(0.0)), F.lit(255.0)) * strength)
    return out.withColumns(fresh).select(*pixels.columns)


def outlined(pixels: DataFrame, mask: str, out: str) -> DataFrame:
    """Mask pixels with a 4-neighbour that is outside the mask or the image."""
    same, pixels = F.lit(True), _by_image(pixels)
    for key, along in (("y", "x"), ("x", "y")):
        line = _image(key).orderBy(along)
        same = same & F.coalesce(F.lag(mask).over(line), F.lit(False)) & F.coalesce(F.lead(mask).over(line), F.lit(False))
    return pixels.withColumn(out, F.col(mask) & ~same)
