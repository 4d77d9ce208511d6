"""Neighbourhood operators and components on tiles smaller than the raster, against arrays of the whole raster."""

import numpy as np
import pytest

from canopyspark.operators import components, finish, tiles
from canopyspark.operators import pixels as px


def _frame(spark, images, names):
    """Rows of several rasters (arrays h, w, columns)."""
    rows = []
    for key, image in images.items():
        h, w, _ = image.shape
        rows += [(key, x, y, *(v.item() for v in image[y, x])) for y in range(h) for x in range(w)]
    kinds = {"f": "double", "i": "int", "b": "boolean"}
    kind = kinds[next(iter(images.values())).dtype.kind]
    return spark.createDataFrame(rows, "image_key long, x int, y int, " + ", ".join(f"{n} {kind}" for n in names))


def _grids(df, names):
    out = {}
    for key, part in df.toPandas().groupby("image_key"):
        image = np.zeros((part["y"].max() + 1, part["x"].max() + 1, len(names)))
        image[part["y"], part["x"]] = part[list(names)].to_numpy(float)
        out[key] = image
        assert len(part) == image.shape[0] * image.shape[1]
    return out


@pytest.mark.parametrize("side", [4, 7, 16, 256])
def test_blur_does_not_see_tiles(spark, side, monkeypatch):
    monkeypatch.setattr(tiles.by_tiles, "__defaults__", (side,))
    rng = np.random.default_rng(1)
    images = {k: rng.random((h, w, 2)) for k, (h, w) in {1: (16, 19), 2: (1, 1), 3: (3, 33), 4: (8, 8), 5: (9, 2)}.items()}
    kernel = [1 / 16, 4 / 16, 6 / 16, 4 / 16, 1 / 16]
    got = _grids(px.convolved(_frame(spark, images, "uv"), ["u", "v"], kernel, ["u", "v"]), "uv")
    for key, image in images.items():
        wide = np.pad(image, ((2, 2), (2, 2), (0, 0)), mode="reflect") if min(image.shape[:2]) > 1 else np.stack([tiles.mirrored(image[:, :, c], 2) for c in range(2)], 2)
        h, w, _ = image.shape
        want = sum(wide[i : i + h, j : j + w] * a * b for i, a in enumerate(kernel) for j, b in enumerate(kernel))
        assert np.allclose(got[key], want, atol=1e-12)


@pytest.mark.parametrize("side", [13, 64])
def test_morphology_and_denoising_do_not_see_tiles(spark, side, monkeypatch):
    monkeypatch.setattr(tiles.by_tiles, "__defaults__", (side,))
    rng = np.random.default_rng(2)
    masks = {k: rng.random((h, w, 1)) < 0.7 for k, (h, w) in {1: (30, 41), 2: (5, 5), 3: (14, 13)}.items()}
    got = _grids(px.opened_and_closed(_frame(spark, masks, "m"), "m", "m"), "m")
    for key, mask in masks.items():
        want, there = mask[:, :, 0], np.ones(mask.shape[:2], bool)
        for grow in (False, True, True, False):
            near = np.full(want.shape, not grow)
            for y, x in np.ndindex(want.shape):
                cells = [(y + k - 3, x + d) for k, half in enumerate(px.ELLIPSE_7) for d in range(-half, half + 1)]
                inside = [want[c] for c in cells if 0 <= c[0] < want.shape[0] and 0 <= c[1] < want.shape[1]]
                near[y, x] = any(inside) if grow else all(inside)
            assert (tiles.swept(want, there, px.ELLIPSE_7, grow) == near).all()
            want = near
        assert (got[key][:, :, 0] == want).all()
    colours = {1: rng.integers(0, 256, (20, 31, 3))}
    got = _grids(finish.denoised(_frame(spark, colours, "rgb")), "rgb")
    assert (got[1] == np.rint(finish.bilateral(colours[1].astype(float), 2, 25.0, 25.0))).all()


def _spiral(n):
    grid, x, y, dx, dy = np.zeros((n, n), bool), 0, 0, 1, 0
    grid[0, 0] = True
    while True:
        ahead = [(y + dy * k, x + dx * k) for k in (1, 2)]
        free = 0 <= ahead[0][0] < n and 0 <= ahead[0][1] < n and not grid[ahead[0]] and not (0 <= ahead[1][0] < n and 0 <= ahead[1][1] < n and grid[ahead[1]])
        if not free:
            dx, dy = -dy, dx
            ahead = [(y + dy * k, x + dx * k) for k in (1, 2)]
            if not (0 <= ahead[0][0] < n and 0 <= ahead[0][1] < n) or grid[ahead[0]] or grid[ahead[1]]:
                return grid
        y, x = ahead[0]
        grid[y, x] = True


@pytest.mark.parametrize("side", [3, 8, 256])
def test_components_over_many_tiles(spark, side):
    rng = np.random.default_rng(3)
    masks = {1: _spiral(41), 2: rng.random((37, 29)) < 0.4, 3: rng.random((20, 50)) < 0.6, 4: np.zeros((4, 4), bool), 5: np.ones((17, 17), bool)}
    got = {}
    for r in components.components(_frame(spark, {k: m[:, :, None] for k, m in masks.items()}, "m"), "m", side).collect():
        got.setdefault(r["image_key"], {})[r["y"], r["x"]] = (r["label"], r["area"])
    for key, mask in masks.items():
        want, (h, w) = {}, mask.shape
        for first in zip(*np.nonzero(mask), strict=True):
            if first in want:
                continue
            todo, seen = [first], {first}
            while todo:
                y, x = todo.pop()
                for c in ((y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                    if 0 <= c[0] < h and 0 <= c[1] < w and mask[c] and c not in seen:
                        seen.add(c)
                        todo.append(c)
            want |= dict.fromkeys(seen, (first[0] * w + first[1], len(seen)))
        assert got.get(key, {}) == want
    assert len({v for v in got[1].values()}) == 1


def test_one_shuffle(spark):
    df = spark.range(64).selectExpr("1L AS image_key", "cast(id % 8 AS int) AS x", "cast(id div 8 AS int) AS y", "cast(id AS double) AS v")
    plan = px.sharpened(df, "v", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan
