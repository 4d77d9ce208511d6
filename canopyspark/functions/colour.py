"""Column expressions for 8-bit colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Green hue in halved degrees, least saturation and value, and least excess green of vegetation.
HUE, LEAST_S, LEAST_V, EXCESS = (25, 100), 30, 20, 15
#: Red, green and blue at equal steps of a dark-to-light ramp for depth previews.
RAMP = ((0, 0, 4), (87, 16, 110), (188, 55, 84), (249, 142, 9), (252, 255, 164))


def byte(x: Column) -> Column:
    """Clamped to 0..255 and truncated."""
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(255.0)).cast("int")


def hsv(r: Column, g: Column, b: Column) -> Column:
    """(h, s, v): hue in degrees halved, saturation and value of 255, each rounded half up."""
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    spread = (high - low).cast("double")
    turn = F.when(spread == 0, 0.0).when(high == r, 60 * (g - b) / spread).when(high == g, 120 + 60 * (b - r) / spread).otherwise(240 + 60 * (r - g) / spread)
    degrees = F.when(turn < 0, turn + 360).otherwise(turn)
    saturation = F.when(high == 0, 0.0).otherwise(255 * spread / high)
    return F.struct((F.floor(degrees / 2 + 0.5) % 180).cast("int").alias("h"), F.floor(saturation + 0.5).cast("int").alias("s"), high.cast("int").alias("v"))


def is_green(r: Column, g: Column, b: Column) -> Column:
    c = hsv(r, g, b)
    return c["h"].between(*HUE) & (c["s"] >= LEAST_S) & (c["v"] >= LEAST_V)


def has_excess_green(r: Column, g: Column, b: Column) -> Column:
    return 2 * g - r - b > EXCESS


def is_vegetation(r: Column, g: Column, b: Column) -> Column:
    return is_green(r, g, b) | has_excess_green(r, g, b)


def depth_colour(d: Column) -> Column:
    """(r, g, b) of a normalised depth on RAMP; black for null."""
    place = F.least(F.greatest(d, F.lit(0.0)), F.lit(1.0)) * (len(RAMP) - 1)
    at = F.least(F.floor(place), F.lit(len(RAMP) - 2)).cast("int")
    share = place - at
    out = []
    for channel, name in enumerate("rgb"):
        stops = F.array(*(F.lit(float(c[channel])) for c in RAMP))
        out.append(F.coalesce(byte(stops[at] * (1 - share) + stops[at + 1] * share), F.lit(0)).alias(name))
    return F.struct(*out)


# Fixed values below: the sRGB curve, its matrix to XYZ for the D65 white, and the LAB curve.
TO_XYZ = ((0.412453, 0.357580, 0.180423), (0.212671, 0.715160, 0.072169), (0.019334, 0.119193, 0.950227))
FROM_XYZ = ((3.240479, -1.53715, -0.498535), (-0.969256, 1.875991, 0.041556), (0.055648, -0.204043, 1.057311))
WHITE = (0.950456, 1.0, 1.088754)


def lab(r: Column, g: Column, b: Column) -> Column:
    """(l, a, b) of bytes as bytes: lightness times 2.55, the two colour axes moved by 128."""

    def linear(c: Column) -> Column:
        share = c / 255.0
        return F.when(share <= 0.04045, share / 12.92).otherwise(F.pow((share + 0.055) / 1.055, F.lit(2.4)))

    light = [linear(c) for c in (r, g, b)]
    xyz = [(row[0] * light[0] + row[1] * light[1] + row[2] * light[2]) / white for row, white in zip(TO_XYZ, WHITE, strict=True)]
    fx, fy, fz = (F.when(t > 0.008856, F.cbrt(t)).otherwise(7.787 * t + 16.0 / 116.0) for t in xyz)
    lightness = F.when(xyz[1] > 0.008856, 116.0 * fy - 16.0).otherwise(903.3 * xyz[1])
    whole = lambda v: F.least(F.greatest(F.floor(v + 0.5), F.lit(0)), F.lit(255)).cast("int")
    return F.struct(whole(lightness * 2.55).alias("l"), whole(500.0 * (fx - fy) + 128.0).alias("a"), whole(200.0 * (fy - fz) + 128.0).alias("b"))


def from_lab(l8: Column, a8: Column, b8: Column) -> Column:
    """(r, g, b) as bytes of what lab gives."""
    lightness = l8 / 2.55
    dark = lightness <= 8.0
    fy = F.when(dark, 7.787 * (lightness / 903.3) + 16.0 / 116.0).otherwise((lightness + 16.0) / 116.0)
    y = F.when(dark, lightness / 903.3).otherwise(fy * fy * fy)
    back = lambda f: F.when(f > 0.206893, f * f * f).otherwise((f - 16.0 / 116.0) / 7.787)
    x, z = back(fy + (a8 - 128.0) / 500.0) * WHITE[0], back(fy - (b8 - 128.0) / 200.0) * WHITE[2]

    def curved(row: tuple[float, float, float]) -> Column:
        v = F.least(F.greatest(row[0] * x + row[1] * y + row[2] * z, F.lit(0.0)), F.lit(1.0))
        share = F.when(v <= 0.0031308, 12.92 * v).otherwise(1.055 * F.pow(v, F.lit(1.0 / 2.4)) - 0.055)
        return F.floor(share * 255.0 + 0.5).cast("int")

    return F.struct(*(curved(row).alias(c) for row, c in zip(FROM_XYZ, "rgb", strict=True)))
