"""Models as plug-ins: objects with one method on arrays, created once in each Python worker. Those here are plain stand-ins, without weights.

A depth model has estimate(h x w x 3 bytes) -> h x w numbers, larger being nearer; an outpaint model has outpaint(image, mask) -> image,
filling where mask is true; an upscale model has upscale(image, scale) -> image. Each is given as a function without arguments that makes it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

_RASTER = "image_key string, ok boolean, error string, w int, h int, data binary"


class RowDepth:
    """Nearer towards the bottom of the image."""

    def estimate(self, image: np.ndarray) -> np.ndarray:
        return np.repeat(np.linspace(0, 1, image.shape[0])[:, None], image.shape[1], axis=1)


class NearestOutpaint:
    """Each masked pixel takes the colour of the nearest kept row and column."""

    def outpaint(self, image: np.ndarray, mask: np.ndarray) -> np.ndarray:
        rows, columns = np.flatnonzero(~mask.all(axis=1)), np.flatnonzero(~mask.all(axis=0))
        if not len(rows):
            return image
        y = np.clip(np.arange(len(image)), rows[0], rows[-1])
        x = np.clip(np.arange(image.shape[1]), columns[0], columns[-1])
        return np.where(mask[:, :, None], image[y][:, x], image)


def _linear(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear, to h x w."""
    y, x = (np.clip((np.arange(n) + 0.5) * old / n - 0.5, 0, old - 1) for n, old in ((h, image.shape[0]), (w, image.shape[1])))
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, image.shape[0] - 1), np.minimum(x0 + 1, image.shape[1] - 1)
    fy, fx = (y - y0)[:, None, None], (x - x0)[None, :, None]
    f = image.astype(float)
    top, low = f[y0][:, x0] * (1 - fx) + f[y0][:, x1] * fx, f[y1][:, x0] * (1 - fx) + f[y1][:, x1] * fx
    return np.clip(np.rint(top * (1 - fy) + low * fy), 0, 255).astype(np.uint8)


class LinearUpscale:
    """Bilinear."""

    def upscale(self, image: np.ndarray, scale: float) -> np.ndarray:
        return _linear(image, *(max(1, round(n * scale)) for n in image.shape[:2]))


def _lanczos(old: int, new: int, lobes: int = 4) -> np.ndarray:
    """new x old weights; borders repeat."""
    centre = (np.arange(new) + 0.5) * old / new - 0.5
    tap = np.floor(centre).astype(int)[:, None] + np.arange(1 - lobes, lobes + 1)
    far = centre[:, None] - tap
    weight = np.sinc(far) * np.sinc(far / lobes)
    out = np.zeros((new, old))
    np.add.at(out, (np.arange(new)[:, None].repeat(2 * lobes, axis=1), np.clip(tap, 0, old - 1)), weight / weight.sum(axis=1, keepdims=True))
    return out


class LanczosUpscale:
    """Separable, four lobes."""

    def upscale(self, image: np.ndarray, scale: float) -> np.ndarray:
        y, x = (_lanczos(n, max(1, round(n * scale))) for n in image.shape[:2])
        return np.clip(np.rint(np.einsum("ai,bj,ijc->abc", y, x, image.astype(float), optimize=True)), 0, 255).astype(np.uint8)


@lru_cache(maxsize=4)
def _loaded(make: Callable):
    return make()


def retried(call: Callable, attempts: int):
    """The first result of at most so many attempts. Only lack of memory is tried again; any other error is final."""
    for k in range(attempts):
        try:
            return call()
        except MemoryError:
            if k == attempts - 1:
                raise


def _image(row) -> np.ndarray:
    return np.frombuffer(row.data, np.uint8).reshape(row.h, row.w, 3)


def _by_row(rasters: DataFrame, make: Callable, work: Callable, extra: str, absent: tuple) -> DataFrame:
    """Raster rows that work(model, row) makes of decoded ones, as (h, w, bytes, *extra); an image that a model fails on, whatever the
    error, has ok false and the error, and stops no other."""

    def run(frames):
        model = _loaded(make)
        names = ["image_key", "ok", "error", "w", "h", "data", *(f.split()[0] for f in extra.split(", "))]
        for frame in frames:
            rows = []
            for row in frame.itertuples():
                try:
                    h, w, data, *more = work(model, row)
                    rows.append((row.image_key, True, None, w, h, data, *more))
                except Exception as e:  # whatever a model raises
                    rows.append((row.image_key, False, f"{type(e).__name__}: {e}"[:500], None, None, None, *absent))
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"w": "Int32", "h": "Int32"})

    return rasters.where("ok").mapInPandas(run, f"{_RASTER}, {extra}")


def estimated_depth(rasters: DataFrame, make: Callable = RowDepth, attempts: int = 1) -> DataFrame:
    """Raster rows with each image's depth scaled to 0..1, as 64-bit numbers. A model that returns other shapes or numbers that aren't
    finite fails."""

    def work(model, row):
        depth = np.asarray(retried(lambda: model.estimate(_image(row)), attempts), float)
        if depth.shape != (row.h, row.w) or not np.isfinite(depth).all():
            raise ValueError(f"the depth model gave {depth.shape} for {(row.h, row.w)}, or numbers that are not finite")
        d = (depth - depth.min()) / max(depth.max() - depth.min(), 1e-6)
        return row.h, row.w, d.tobytes(), attempts

    return _by_row(rasters, make, work, "attempts int", (attempts,)).drop("attempts")


def depth_pixels(depths: DataFrame) -> DataFrame:
    """image_key, x, y, d of the rows of estimated_depth that are ok."""

    def run(frames):
        for frame in frames:
            for row in frame.itertuples():
                d = np.frombuffer(row.data, float).reshape(row.h, row.w)
                for top in range(0, row.h, max(1, (1 << 17) // row.w)):
                    part = d[top : top + max(1, (1 << 17) // row.w)]
                    y, x = np.divmod(np.arange(part.size), row.w)
                    yield pd.DataFrame({"image_key": row.image_key, "x": x, "y": y + top, "d": part.ravel()})

    return depths.where("ok").select("image_key", "w", "h", "data").mapInPandas(run, "image_key string, x long, y long, d double")


def _shares(old: int, new: int) -> np.ndarray:
    """Of each of new places on a line, the part of it that each of old pixels covers."""
    place, pixel = np.arange(new)[:, None] * old / new, np.arange(old)[None]
    return np.clip(np.minimum(place + old / new, pixel + 1) - np.maximum(place, pixel), 0, None) * new / old


def _painted(model, image: np.ndarray, mask: np.ndarray, max_side: int | None) -> np.ndarray:
    """What the model makes of an image, shrunk for it to max_side and enlarged again."""
    h, w = image.shape[:2]
    if not max_side or max(h, w) <= max_side:
        return np.asarray(model.outpaint(image, mask), np.uint8)
    small = [max(1, round(n * max_side / max(h, w))) for n in (h, w)]
    y, x = (((np.arange(n) + 0.5) * old / n).astype(int) for n, old in zip(small, (h, w), strict=True))
    shrunk = np.einsum("ya,xb,abc->yxc", _shares(h, small[0]), _shares(w, small[1]), image.astype(float), optimize=True)
    made = np.asarray(model.outpaint(np.rint(shrunk).astype(np.uint8), mask[y][:, x]), np.uint8)
    return _linear(made, h, w) if made.shape == (*small, 3) else made


def _weights(ring: np.ndarray, more: list[int], inner: tuple[int, int], overlap: int) -> np.ndarray:
    """1 on the ring, less and less within overlap pixels of it, else 0. A side that nothing was added to has no ring."""
    weight = ring.astype(float)
    if overlap > 0:
        far = np.full(inner, np.inf)
        for size, added, shape in ((inner[0], more[1], (-1, 1)), (inner[1], more[0], (1, -1))):
            if added:
                at = np.arange(size)
                far = np.minimum(far, np.minimum(at + 1, size - at).reshape(shape))
        weight[more[1] : more[1] + inner[0], more[0] : more[0] + inner[1]] = np.clip((overlap + 1 - far) / (overlap + 1), 0, None)
    return weight


def outpainted(rasters: DataFrame, pad_fraction: float, step_fraction: float, make: Callable = NearestOutpaint, attempts: int = 4, max_side: int | None = None, overlap: int = 0, progressive: bool = True) -> DataFrame:
    """Raster rows with pad_x and pad_y: each raster grown ring by ring to its pads (halves to even), or in one step. With each ring, what
    was generated before within overlap pixels of it is generated anew and mixed in, the less the farther it is from the ring. What was
    there is pasted back after the last ring, so that no model can change it. A model is given at most max_side pixels a side; only what it
    adds is enlarged."""

    def work(model, row):
        original = _image(row)
        pads = [round(n * pad_fraction) for n in (row.w, row.h)]
        steps = [max(1, round(n * step_fraction) if progressive else p) for n, p in zip((row.w, row.h), pads, strict=True)]
        canvas, done = original, [0, 0]
        while done[0] < pads[0] or done[1] < pads[1]:
            more = [min(s, p - n) for s, p, n in zip(steps, pads, done, strict=True)]
            room = [min(m, s - 1) for m, s in zip(more, (canvas.shape[1], canvas.shape[0]), strict=True)]
            seed = np.pad(canvas, ((room[1],) * 2, (room[0],) * 2, (0, 0)), mode="reflect")
            seed = np.pad(seed, ((more[1] - room[1],) * 2, (more[0] - room[0],) * 2, (0, 0)), mode="edge")
            ring = np.ones(seed.shape[:2], bool)
            ring[more[1] : more[1] + canvas.shape[0], more[0] : more[0] + canvas.shape[1]] = False
            weight = _weights(ring, more, canvas.shape[:2], overlap)
            weight[done[1] + more[1] :, done[0] + more[0] :][: row.h, : row.w] = 0
            filled = np.asarray(retried(lambda seed=seed, weight=weight: _painted(model, seed, weight > 0, max_side), attempts), np.uint8)
            if filled.shape != seed.shape:
                raise ValueError(f"the outpaint model gave {filled.shape} for {seed.shape}")
            canvas = np.rint(seed + (filled.astype(float) - seed) * weight[:, :, None]).astype(np.uint8)
            done = [n + m for n, m in zip(done, more, strict=True)]
        canvas = canvas.copy()
        canvas[pads[1] : pads[1] + row.h, pads[0] : pads[0] + row.w] = original
        return canvas.shape[0], canvas.shape[1], canvas.tobytes(), pads[0], pads[1]

    return _by_row(rasters, make, work, "pad_x int, pad_y int", (0, 0))


#: Least side of a tile that a model is given.
LEAST_TILE = 64


def _tile_places(old: int, new: int, tile: int, pad: int) -> list[tuple[int, int, slice, np.ndarray, np.ndarray]]:
    """Tiles of an axis of old pixels that is enlarged to new: begin and end, the new places that each reaches, where these are in the tile
    (in its pixels) and what they count. Tiles reach pad pixels beyond what is theirs; what a place counts changes evenly within half of
    that on either side of the border between two, and adds up to 1."""
    step = max(1, tile - 2 * pad)
    spans = [(0, old)] if old <= tile else [(max(0, at - pad), min(old, at + step + pad)) for at in range(0, old, step)]
    found, total = [], np.zeros(new)
    for begin, end in spans:
        reach = slice(*(int(np.ceil(edge * new / old - 0.5)) for edge in (begin, end)))
        centre = (np.arange(reach.start, reach.stop) + 0.5) * old / new
        weight = np.ones(len(centre))
        if pad:
            weight *= np.clip((centre - begin) / pad - 0.5, 0, 1) if begin else 1
            weight *= np.clip((end - centre) / pad - 0.5, 0, 1) if end < old else 1
        total[reach] += weight
        found.append((begin, end, reach, centre - begin, weight))
    return [(begin, end, reach, at, weight / total[reach]) for begin, end, reach, at, weight in found]


def _sampled(image: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bilinear at rows y and columns x; whole numbers are taken as they are."""
    for axis, at in ((0, y), (1, x)):
        at = np.clip(np.round(at, 6), 0, image.shape[axis] - 1)
        low = at.astype(int)
        share = (at - low).astype(np.float32).reshape((-1, 1, 1) if axis == 0 else (1, -1, 1))
        near = np.take(image, low, axis).astype(np.float32)
        image = near + share * (np.take(image, np.minimum(low + 1, image.shape[axis] - 1), axis) - near) if share.any() else near
    return image


def upscaled_in_tiles(model, image: np.ndarray, scale: float, tile: int, pad: int) -> np.ndarray:
    """What the model makes of an image, tile by tile; an image that fits in a tile is given whole."""
    h, w = image.shape[:2]
    if max(h, w) <= tile:
        return np.asarray(model.upscale(image, scale), np.uint8)
    pad = min(pad, tile // 4)
    new = [max(1, round(n * scale)) for n in (h, w)]
    out = np.zeros((*new, 3), np.float32)
    for top, bottom, rows, y, wy in _tile_places(h, new[0], tile, pad):
        for left, right, columns, x, wx in _tile_places(w, new[1], tile, pad):
            part = image[top:bottom, left:right]
            made = np.asarray(model.upscale(part, scale), np.uint8)
            _checked_upscale(made, part, scale)
            own = _sampled(made, y * made.shape[0] / part.shape[0] - 0.5, x * made.shape[1] / part.shape[1] - 0.5)
            out[rows, columns] += own * (wy[:, None] * wx[None]).astype(np.float32)[:, :, None]
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def _checked_upscale(made: np.ndarray, image: np.ndarray, scale: float) -> None:
    if made.ndim != 3 or made.shape[2] != 3 or made.shape[0] < image.shape[0] or made.shape[1] < image.shape[1]:
        raise ValueError(f"the upscale model gave {made.shape} for {image.shape} at {scale}")


def upscaled(rasters: DataFrame, scale: float, max_dimension: int, make: Callable = LinearUpscale, attempts: int = 4, tile: int = 256, pad: int = 16) -> DataFrame:
    """Raster rows with scale, requested_scale, model, tile and attempts: each raster enlarged as far as its longer side may grow, never made
    smaller. A model is given tiles of at most tile pixels a side, pads included, which are mixed where they overlap; after each lack of
    memory, tiles have half the side, but LEAST_TILE at least. tile and attempts are those that gave the result."""

    def work(model, row):
        own = max(1.0, min(scale, max_dimension / max(row.w, row.h)))
        sides = [max(min(LEAST_TILE, tile), tile >> k) for k in range(attempts)]
        for k, side in enumerate(sides):
            try:
                image = upscaled_in_tiles(model, _image(row), own, side, pad)
                break
            except MemoryError:
                if k == attempts - 1:
                    raise
        _checked_upscale(image, _image(row), own)
        return image.shape[0], image.shape[1], image.tobytes(), own, float(scale), type(model).__name__, side, k + 1

    return _by_row(rasters, make, work, "scale double, requested_scale double, model string, tile int, attempts int", (1.0, float(scale), None, None, None))
