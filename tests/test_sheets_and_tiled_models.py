"""Labelled sheets, by hand and written by a run; models that are called tile by tile."""

import numpy as np
import pytest

from canopyspark import pipeline
from canopyspark.config import PipelineConfig
from canopyspark.operators import models, sheets
from canopyspark.sources import codecs, tables


def picture(h, w, seed=3):
    y, x = np.mgrid[:h, :w]
    rough = np.random.default_rng(seed).integers(0, 60, (h, w))
    return np.stack([(x * 255 // w), (y * 255 // h), 90 + rough + (x * y) % 40], axis=2).astype(np.uint8)


def test_glyphs_are_complete():
    assert set(sheets.GLYPHS) == set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-")
    assert all([len(row) for row in rows.split()] == [3] * 5 for rows in sheets.GLYPHS.values()) and len(set(sheets.GLYPHS.values())) == len(sheets.GLYPHS)


def test_labels_are_drawn_and_cut(spark):
    labels = spark.createDataFrame([(0, "hi i"), (1, "T" * 50), (2, ""), (3, None)], "panel int, label string")
    dots = sheets.lettered(labels, 1).toPandas()
    art = lambda panel, w: ["".join("#" if ((dots.panel == panel) & (dots.x == x + 1) & (dots.y == y + 1)).any() else "." for x in range(w)) for y in range(5)]
    assert art(0, 15) == ["#.#.###.....###", "#.#..#.......#.", "###..#.......#.", "#.#..#.......#.", "#.#.###.....###"]
    assert set(dots.panel) == {0, 1} and len(sheets.lettered(labels, 3).toPandas()) == 9 * len(dots)
    panels = spark.range(4).selectExpr("'k' AS image_key", "CAST(id AS INT) AS panel", "0 AS x", "0 AS y", "200 AS r", "100 AS g", "40 AS b", "1 AS w", "1 AS h")
    sheet = sheets.labelled_sheet(panels, labels, 20, 3, 1).toPandas()
    assert len(sheet) == 4 * 400 and not sheet.duplicated(["x", "y"]).any() and sheet.x.max() == 59 and sheet.y.max() == 39
    white = sheet[sheet.r == 255]
    assert set(white.panel) == {0, 1} and (white.y % 20 < 7).all()
    assert set(sheet[(sheet.y % 20 < 7) & (sheet.r < 255)].r) == {50} and set(sheet[sheet.y % 20 >= 7].r) == {200}


def test_a_run_writes_a_sheet_for_each_image(spark, tmp_path):
    (tmp_path / "in/farm").mkdir(parents=True)
    (tmp_path / "in/farm/field.png").write_bytes(codecs.encode_png(picture(30, 40)))
    (tmp_path / "in/bad.png").write_bytes(b"no picture")
    config = PipelineConfig(AI_OUTPAINT_PAD_FRAC=0.2, BACKPROJECT_STRIDE=1, AI_OUTPAINT_FEATHER_PX=3, POST_WARP_SUPER_RESOLUTION_SCALE=1.5, SAVE_DEBUG_VISUALIZATION=True)
    pipeline.run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), config, frame=(32, 24))
    path = tmp_path / "out" / tables.SHEETS / "farm/field.png.diagnostic.png"
    sheet = codecs.decode(path.read_bytes())
    assert sheet.shape == (3 * 320, 5 * 320, 3) and [p.name for p in path.parent.parent.rglob("*.png")] == [path.name]
    # the source's panel, below the band, is the picture by nearest pixels; every panel has a label
    at = np.arange(320)
    source = picture(30, 40)
    assert (sheet[21:320, :320] == source[at * 30 // 320][:, at * 40 // 320][21:]).all()
    for k in range(len(pipeline.PANELS)):
        band = sheet[k // 5 * 320 :, k % 5 * 320 :][:21, :320]
        lit = (band == 255).all(axis=2).sum()
        assert lit == 9 * sum(sheets.GLYPHS[c].count("1") for c in pipeline.PANELS[k].upper() if c != " ")
    found = pipeline.diagnostic_sheet(spark, str(tmp_path / "out"), "field").collect()
    assert [r["image_key"] for r in found] == ["farm/field.png"] and bytes(found[0]["content"]) == path.read_bytes()
    assert pipeline.diagnostic_sheet(spark, str(tmp_path / "out"), "fiel").count() == 0
    assert spark.read.json(str(tmp_path / "out/log")).where("layer = 'sheets'").count() == 1
    # a second run with nothing to do and one without sheets write none
    path.unlink()
    pipeline.run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), config, frame=(32, 24))
    assert not path.exists()


def small():
    """A model that has memory for 64 pixels a side alone; defined here, so that tasks needn't import this module."""

    class Small(models.LinearUpscale):
        def upscale(self, image, scale):
            if max(image.shape[:2]) > 64:
                raise MemoryError
            return super().upscale(image, scale)

    return Small


@pytest.mark.parametrize("h,w,scale", [(150, 201, 2.0), (65, 40, 3.0), (64, 64, 2.0), (300, 9, 2.0)])
def test_tiles_leave_no_seams(spark, h, w, scale):
    image = picture(h, w)
    raster = spark.createDataFrame([("k", True, None, w, h, image.tobytes())], codecs.RASTER)
    row = models.upscaled(raster, scale, 4096, small()).first()
    whole = models.LinearUpscale().upscale(image, scale)
    made = np.frombuffer(row["data"], np.uint8).reshape(row["h"], row["w"], 3)
    assert row["ok"] and made.shape == whole.shape and np.abs(made.astype(int) - whole).max() <= 1
    assert row["tile"] == (256 if max(h, w) <= 64 else 64) and row["model"] == "Small" and row["requested_scale"] == row["scale"] == scale
    assert row["attempts"] == (1 if max(h, w) <= 64 else 3)


def test_tiles_with_a_scale_that_is_no_whole_number(spark):
    y, x = np.mgrid[:120, :170]
    image = np.stack([x + 20, y * 2, x // 2 + y], axis=2).astype(np.uint8)  # even, so that what is resampled is the same
    raster = spark.createDataFrame([("k", True, None, 170, 120, image.tobytes())], codecs.RASTER)
    row = models.upscaled(raster, 2.0, 250, small()).first()
    whole = models.LinearUpscale().upscale(image, 250 / 170)
    made = np.frombuffer(row["data"], np.uint8).reshape(row["h"], row["w"], 3).astype(int)
    assert row["scale"] == pytest.approx(250 / 170) and made.shape == whole.shape and np.abs(made - whole)[2:-2, 2:-2].max() <= 2


def test_weights_of_tiles_add_up():
    for old, new, tile, pad in ((100, 250, 40, 8), (41, 41, 40, 10), (7, 14, 3, 0), (64, 100, 64, 16), (129, 258, 64, 16)):
        total = np.zeros(new)
        for begin, end, reach, at, weight in models._tile_places(old, new, tile, pad):
            total[reach] += weight
            assert end - begin <= max(tile, 1) and len(at) == len(weight) and (weight >= 0).all()
        assert np.allclose(total, 1)


def test_a_model_without_memory_fails_its_image(spark):
    raster = spark.createDataFrame([("k", True, None, 9, 9, bytearray(243))], codecs.RASTER)

    class Scarce:
        def upscale(self, image, scale):
            raise MemoryError

    row = models.upscaled(raster, 2.0, 64, Scarce).first()
    assert not row["ok"] and row["error"].startswith("MemoryError") and row["requested_scale"] == 2.0


def test_tile_settings_are_checked():
    with pytest.raises(ValueError, match="SUPER_RESOLUTION_TILE must be above 0; .*TILE_PAD must be at least 0"):
        PipelineConfig(POST_WARP_SUPER_RESOLUTION_TILE=0, POST_WARP_SUPER_RESOLUTION_TILE_PAD=-1).validate()
