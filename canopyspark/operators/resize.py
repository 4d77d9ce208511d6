"""Resizing as relations: each pixel is sent to the places that it has a share in, along one axis and then the other, and shares are added up."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resized_area(pixels: DataFrame, w, h, new_w, new_h, values: Sequence[str]) -> DataFrame:
    """image_key, x, y and the means of values over the part of the source that each place covers, for sides that don't grow; sizes are
    numbers or columns. Shares are whole numbers (of 1 / (new side) pixels), so whole values have exact sums."""
    w, h, new_w, new_h = (F.lit(c).cast("long") if isinstance(c, int) else F.col(c).cast("long") if isinstance(c, str) else c.cast("long") for c in (w, h, new_w, new_h))
    sized = pixels.select("image_key", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), *values, w.alias("__w"), h.alias("__h"), new_w.alias("__nw"), new_h.alias("__nh"))
    spread, shares = sized, []
    for axis, old, new in (("x", "__w", "__nw"), ("y", "__h", "__nh")):
        first, last = F.expr(f"({axis} * {new}) div {old}"), F.expr(f"(({axis} + 1) * {new} - 1) div {old}")
        spread = spread.withColumn(f"__{axis}", F.explode(F.sequence(first, last)))
        low, high = F.greatest(F.col(axis) * F.col(new), F.col(f"__{axis}") * F.col(old)), F.least((F.col(axis) + 1) * F.col(new), (F.col(f"__{axis}") + 1) * F.col(old))
        shares.append(high - low)
    share = shares[0] * shares[1]
    spread = spread.withColumn("__share", share)
    sums = [(F.sum(F.col(v) * F.col("__share")) / (F.col("__w") * F.col("__h"))).alias(v) for v in values]
    return spread.groupBy("image_key", F.col("__x").alias("x"), F.col("__y").alias("y"), "__w", "__h").agg(*sums).drop("__w", "__h")


def cubic(far: Column) -> Column:
    """The weight of a tap at a distance: a cubic with the slope -0.75 at 1, none from 2 on."""
    d = F.abs(far)
    near, wide = (1.25 * d - 2.25) * d * d + 1.0, ((-0.75 * d + 3.75) * d - 6.0) * d + 3.0
    return F.when(d <= 1, near).when(d < 2, wide).otherwise(0.0)


def lanczos4(far: Column) -> Column:
    """The weight of a tap at a distance: a sinc within a wider one, none from 4 on."""
    d = F.abs(far)
    turn = math.pi * d
    return F.when(d < 1e-9, 1.0).when(d < 4, 4.0 * F.sin(turn) * F.sin(turn / 4.0) / (turn * turn)).otherwise(0.0)


#: The weights that there are, and how many taps they have to either side.
KERNELS: dict[str, tuple[Callable[[Column], Column], int]] = {"cubic": (cubic, 2), "lanczos4": (lanczos4, 4)}


def resized_smooth(pixels: DataFrame, w, h, new_w: int, new_h: int, values: Sequence[str], kernel: str = "cubic") -> DataFrame:
    """image_key, x, y and values by weighted taps around each place's centre; beyond the border, the border counts. A place's weights are
    divided by their sum. w and h are numbers or columns. Two passes, one for each axis."""
    weight, reach = KERNELS[kernel]
    size = lambda c: F.lit(c) if isinstance(c, int) else F.col(c)
    out = pixels.select("image_key", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), *(F.col(v).cast("double").alias(v) for v in values), size(w).cast("long").alias("__w"), size(h).cast("long").alias("__h"))
    for axis, old, new in (("x", "__w", new_w), ("y", "__h", new_h)):
        ratio = F.col(old) / float(new)
        place = lambda at, ratio=ratio: (at + 0.5) / ratio - 0.5
        low = F.when(F.col(axis) == 0, 0).otherwise(F.greatest(F.ceil(place(F.col(axis) - reach)), F.lit(0)))
        high = F.when(F.col(axis) == F.col(old) - 1, new - 1).otherwise(F.least(F.floor(place(F.col(axis) + reach)), F.lit(new - 1)))
        out = out.withColumn("__to", F.explode(F.when(low <= high, F.sequence(low.cast("long"), high.cast("long"))).otherwise(F.array().cast("array<long>"))))
        centre = (F.col("__to") + 0.5) * ratio - 0.5
        taps = [F.floor(centre) + d for d in range(1 - reach, reach + 1)]
        inside = lambda k, old=old: F.least(F.greatest(k, F.lit(0)), F.col(old) - 1)
        own = sum((F.when(inside(k) == F.col(axis), weight(centre - k)).otherwise(0.0) for k in taps), F.lit(0.0))
        out = out.withColumn("__own", own)
        other = "y" if axis == "x" else "x"
        out = out.groupBy("image_key", F.col("__to").alias(axis), other, "__w", "__h").agg(*((F.sum(F.col(v) * F.col("__own")) / F.sum("__own")).alias(v) for v in values))
    return out.select("image_key", "x", "y", *values)
