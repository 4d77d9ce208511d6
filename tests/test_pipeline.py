"""The photograph pipeline end to end on small synthetic pictures, and its parts."""

import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopyspark import pipeline
from canopyspark.config import PipelineConfig
from canopyspark.functions import colour
from canopyspark.operators import components, contrast, finish, manifest, models, resize
from canopyspark.operators import pixels as px
from canopyspark.operators import points as pt
from canopyspark.sources import codecs, images, tables
from canopyspark.streaming import ingest


def field_picture(h=40, w=56):
    image = np.full((h, w, 3), 40, np.uint8)
    y, x = np.mgrid[:h, :w]
    image[((x - 0.55 * w) / (0.35 * w)) ** 2 + ((y - 0.5 * h) / (0.35 * h)) ** 2 < 1] = (30, 150, 30)
    return image


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("photos")
    (root / "farm_2").mkdir()
    (root / "canopy_views").mkdir()
    (root / "a.png").write_bytes(codecs.encode_png(field_picture()))
    (root / "farm_2/b.PNG").write_bytes(codecs.encode_png(field_picture(32, 48)))
    (root / "broken.png").write_bytes(b"no picture")
    (root / "empty.jpg").write_bytes(b"")
    (root / ".hidden.jpg").write_bytes(b"x")
    (root / "notes.txt").write_text("x")
    (root / "canopy_views/old.png").write_bytes(codecs.encode_png(field_picture()))
    return root


SMALL = PipelineConfig(AI_OUTPAINT_PAD_FRAC=0.2, BACKPROJECT_STRIDE=1, AI_OUTPAINT_FEATHER_PX=3, POST_WARP_SUPER_RESOLUTION_SCALE=1.5)


def test_discovery(spark, folder):
    assert [r["image_key"] for r in images.discovered(spark, str(folder)).collect()] == ["a.png", "broken.png", "empty.jpg", "farm_2/b.PNG"]
    assert [r["image_key"] for r in images.discovered(spark, str(folder), recursive=False).collect()] == ["a.png", "broken.png", "empty.jpg"]
    with pytest.raises(NotADirectoryError):
        images.discovered(spark, str(folder / "none"))


def test_folders_of_any_name_and_relative_roots(spark, tmp_path, monkeypatch):
    """A root whose name stands again in a file's path, folders with leading underscores and dots, files without content or readable by
    nobody."""
    for name in ("in/main/b.png", "in/in/c.PNG", "in/_x/d.png", "in/.d/e.jpg", "in/_x/.f.png", "in/canopy_views/g.png"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "in/empty.webp").write_bytes(b"")
    (tmp_path / "in/gone.png").symlink_to(tmp_path / "nowhere")
    keys = {".d/e.jpg", "_x/d.png", "in/c.PNG", "main/b.png"}
    # Spark resolves a relative root by the JVM's folder
    here = spark._jvm.java.lang.System.getProperty("user.dir")
    for root in (str(tmp_path / "in"), f"file:{tmp_path}/in/", os.path.relpath(tmp_path / "in", here)):
        got = {r["image_key"]: r for r in images.checked(spark, root).collect()}
        assert keys | {"empty.webp"} <= set(got) <= keys | {"empty.webp", "gone.png"}
        assert all(got[k]["error"] is None and got[k]["source_size"] == len(f"in/{k}") for k in keys) and got["empty.webp"]["error"] == images.EMPTY
        assert {r["image_key"]: bytes(r["content"]) for r in images.contents(spark, root).collect()} == {k: f"in/{k}".encode() for k in keys}
    assert images.ImageReader(str(tmp_path / "in"), True, False).partitions()[0].prefix == "" and len(images.ImageReader(str(tmp_path / "in"), True, False).partitions()) == 5


def test_whole_pipeline_and_resume(spark, folder, tmp_path, monkeypatch):
    first = {r["image_key"]: r for r in pipeline.run_pipeline(spark, str(folder), str(tmp_path), SMALL, frame=(32, 24)).collect()}
    assert {k: r["status"] for k, r in first.items()} == {"a.png": "done", "farm_2/b.PNG": "done", "broken.png": "failed", "empty.jpg": "failed"}
    assert first["empty.jpg"]["error"] == "file is empty"
    again = {r["image_key"]: r for r in pipeline.run_pipeline(spark, str(folder), str(tmp_path), SMALL, frame=(32, 24)).collect()}
    assert again["a.png"]["run_id"] == first["a.png"]["run_id"] and again["broken.png"]["run_id"] != first["broken.png"]["run_id"]
    finals = spark.read.parquet(str(tmp_path / "finals")).where(F.col("image_key") == "a.png").first()
    assert finals["w"] * finals["h"] * 3 == len(finals["data"]) and finals["w"] > 32
    summary = spark.read.parquet(str(tmp_path / "summaries")).where(F.col("image_key") == "a.png").first()
    assert summary["hfov_deg"] <= 52 and summary["valid_pct"] > 20 and summary["eye"]["y"] - summary["target"]["y"] == pytest.approx(10)
    assert all(first["a.png"][f"{stage}_status"] == "done" for stage in manifest.STAGES) and first["a.png"]["final_width"] == finals["w"] and first["a.png"]["crop_mask_pct"] > 10
    assert first["broken.png"]["validate_status"] == "failed" and first["broken.png"]["initial_depth_status"] == "pending"
    # pictures are under their sources' names
    assert codecs.decode((tmp_path / "canopy_views/a.png").read_bytes()).shape == (finals["h"], finals["w"], 3) and len(list((tmp_path / "canopy_views/farm_2").iterdir())) == 1
    table = spark.read.option("header", "true").csv(str(tmp_path / "summary_csv"))
    assert {r["image_key"]: r["status"] for r in table.where(F.col("run_id") == again["a.png"]["run_id"]).collect()}["a.png"] == "done"
    assert spark.read.json(str(tmp_path / "log")).where("layer = 'finals' AND seconds > 0").count() == 2
    gone = tables.clean_run(spark, str(tmp_path), first["a.png"]["run_id"])
    assert "points" in gone and tables.is_complete(spark, str(tmp_path), "finals", first["a.png"]["run_id"])


def test_a_failing_model_fails_its_image_alone(spark, tmp_path, monkeypatch):
    class Picky(models.RowDepth):
        def estimate(self, image):
            if image.shape[0] == 32:
                raise RuntimeError("no depth for this one")
            return super().estimate(image)

    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "good.png").write_bytes(codecs.encode_png(field_picture()))
    (source / "bad.png").write_bytes(codecs.encode_png(field_picture(32, 48)))
    got = {r["image_key"]: r for r in pipeline.run_pipeline(spark, str(source), target, SMALL, pipeline.Models(depth=Picky), frame=(32, 24)).collect()}
    assert got["good.png"]["status"] == "done" and got["bad.png"]["status"] == "failed" and "no depth for this one" in got["bad.png"]["error"]
    assert (got["bad.png"]["validate_status"], got["bad.png"]["initial_depth_status"], got["bad.png"]["finalize_status"]) == ("done", "failed", "pending")
    # the failed one alone is computed again, and now succeeds
    (source / "good.png").rename(source / "kept.png")
    got = {r["image_key"]: r for r in pipeline.run_pipeline(spark, str(source), target, SMALL, frame=(32, 24)).collect()}
    assert {k: (r["status"], r["present"]) for k, r in got.items()} == {"bad.png": ("done", True), "kept.png": ("done", True), "good.png": ("done", False)}


def test_an_unfinished_run_is_taken_up(spark, tmp_path, monkeypatch):
    broken = finish.finished

    def fails(*_):
        raise KeyboardInterrupt

    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.png").write_bytes(codecs.encode_png(field_picture()))
    monkeypatch.setattr(finish, "finished", fails)
    with pytest.raises(KeyboardInterrupt):
        pipeline.run_pipeline(spark, str(source), target, SMALL, frame=(32, 24))
    monkeypatch.setattr(finish, "finished", broken)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out/points").iterdir()}
    first = next(p.name for p in (tmp_path / "out/runs").iterdir() if p.name.startswith("run_id="))
    got = pipeline.run_pipeline(spark, str(source), target, SMALL, frame=(32, 24)).first()
    assert got["status"] == "done" and f"run_id={got['run_id']}" == first
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out/points").iterdir()} == before
    assert pipeline._unfinished(spark, target, SMALL, 1) is None


def test_a_changed_setting_computes_what_it_reaches_alone(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.png").write_bytes(codecs.encode_png(field_picture()))
    rows = lambda layer: spark.read.parquet(str(target / layer))
    first = pipeline.run_pipeline(spark, str(source), str(target), SMALL, frame=(32, 24)).first()["run_id"]
    changed = replace(SMALL, FILL_RADIUS=1)
    second = pipeline.run_pipeline(spark, str(source), str(target), changed, frame=(32, 24)).first()
    has = lambda run: {d.name for d in target.iterdir() if (d / f"run_id={run}").exists()}
    assert second["status"] == "done" and second["run_id"] != first
    fresh = {"frames", "cropped", "upscaled", "finals"}
    assert has(second["run_id"]) & set(pipeline.MADE_OF) == fresh and set(pipeline.MADE_OF) <= has(first)
    # a new image needs all stages, and the old one is taken over as it is
    (source / "b.png").write_bytes(codecs.encode_png(field_picture(32, 48)))
    third = {r["image_key"]: r for r in pipeline.run_pipeline(spark, str(source), str(target), replace(SMALL, FILL_RADIUS=2), frame=(32, 24)).collect()}
    run = third["b.png"]["run_id"]
    assert {r["status"] for r in third.values()} == {"done"} and third["a.png"]["run_id"] == run
    assert {r["image_key"] for r in rows("depth").where(F.col("run_id") == run).collect()} == {"b.png"}
    assert {r["image_key"] for r in rows("finals").where(F.col("run_id") == run).collect()} == {"a.png", "b.png"}
    # the same pictures as a run from the start gives
    whole = pipeline.run_pipeline(spark, str(source), str(tmp_path / "again"), replace(SMALL, FILL_RADIUS=2), frame=(32, 24)).first()["run_id"]
    picture = lambda path, run: {r["image_key"]: bytes(r["data"]) for r in spark.read.parquet(str(path / "finals")).where(F.col("run_id") == run).collect()}
    assert picture(target, run) == picture(tmp_path / "again", whole)


def test_a_replacement_stopped_at_any_step_loses_nothing(spark, tmp_path):
    root = str(tmp_path)
    read = lambda: tables.read_layer(spark, root, "numbers", "id long, run_id string").count()
    held, old = tmp_path / "numbers/run_id=r", tmp_path / "_numbers-r-old"
    tables.write_layer(spark.range(3), root, "numbers", "r")
    # the old table is set aside, and the new one isn't there yet
    held.rename(old)
    assert read() == 3 and tables.is_complete(spark, root, "numbers", "r") and not old.exists()
    held.rename(old)
    assert tables.is_complete(spark, root, "numbers", "r")
    # the new one is there, and the old one isn't gone yet
    held.rename(old)
    spark.range(5).write.parquet(str(held))
    assert read() == 5 and not old.exists()
    held.rename(old)
    tables.write_layer(spark.range(7), root, "numbers", "r")
    assert read() == 7 and not old.exists()
    tables.write_layer(spark.range(2), root, "numbers", "s")
    tables.moved_layer(spark, root, "numbers", "s", "r")
    assert read() == 2 and not (tmp_path / "numbers/run_id=s").exists()


def test_layers_are_replaced_whole(spark, tmp_path):
    tables.write_layer(spark.range(3), str(tmp_path), "numbers", "r")
    with pytest.raises(Exception):  # noqa: B017
        tables.write_layer(spark.range(3).select(F.raise_error(F.lit("stop"))), str(tmp_path), "numbers", "r")
    assert tables.read_layer(spark, str(tmp_path), "numbers", "id long, run_id string").count() == 3 and tables.is_complete(spark, str(tmp_path), "numbers", "r")
    tables.write_layer(spark.range(5), str(tmp_path), "numbers", "r")
    assert tables.read_layer(spark, str(tmp_path), "numbers", "id long, run_id string").count() == 5
    assert tables.clean_run(spark, str(tmp_path), "r") == ["numbers"]


def test_command_line_has_every_setting():
    import argparse

    from canopyspark import __main__ as command

    parser = argparse.ArgumentParser()
    command._settings(parser)
    args = vars(parser.parse_args(["--no-resume", "--altitude-m", "4.5", "--splat-radius", "1"]))
    config = PipelineConfig(**args)
    assert (config.RESUME, config.ALTITUDE_M, config.SPLAT_RADIUS, config.TILT_DEGREES) == (False, 4.5, 1, 0.0)


def test_fill_smoothing_and_views(spark):
    rows = [(1, x, y, x * 20 + y, x != 4, x == 4) for x in range(9) for y in range(9)]
    frame = spark.createDataFrame(rows, "image_key int, x int, y int, r int, valid boolean, newly_filled boolean")
    got = {(r["x"], r["y"]): r["r"] for r in px.fill_smoothed(frame.withColumn("r", F.when(F.col("valid"), F.col("r")).otherwise(0)), ["r"]).collect()}
    plain = {(x, y): (x * 20 + y if x != 4 else 0) for x in range(9) for y in range(9)}
    mirrored = lambda k: abs(k) if abs(k) < 9 else 16 - k
    blur = sum(w * v * plain[4 + dx, mirrored(4 + dy)] for dx, w in zip(range(-2, 3), px.BINOMIAL_5, strict=True) for dy, v in zip(range(-2, 3), px.BINOMIAL_5, strict=True))
    assert got[4, 4] == int(blur + 0.5) and all(got[k] == plain[k] for k in plain if k[0] != 4)
    assert {r["m"] for r in px.mask_view(frame, "valid", "m").collect()} == {0, 255}
    cross = px.crossed(frame.selectExpr("image_key", "x", "y", "r", "r AS g", "r AS b", "3 AS cx", "5 AS cy"), "cx", "cy", 2)
    assert {(r["x"], r["y"]) for r in cross.collect() if (r["r"], r["g"], r["b"]) == (255, 255, 0)} == {(3, k) for k in range(3, 8)} | {(k, 5) for k in range(1, 6)}


def test_distances_of_a_larger_raster(spark):
    rng = np.random.default_rng(7)
    mask = rng.random((70, 256)) < 0.97
    mask[20:60, 40:200] = True
    rows = [(k, int(x), int(y), bool(mask[y, x]) or k == 2) for k in (1, 2) for y in range(70) for x in range(256)]
    got = {(r["image_key"], r["x"], r["y"]): r["d"] for r in px.squared_distance(spark.createDataFrame(rows, "image_key int, x int, y int, mask boolean"), "mask", "d").collect()}
    ys, xs = np.nonzero(~mask)
    for y in range(0, 70, 7):
        for x in range(0, 256, 5):
            assert got[1, x, y] == ((xs - x) ** 2 + (ys - y) ** 2).min() and got[2, x, y] is None


def test_png_and_ppm_round_trip():
    image = np.random.default_rng(1).integers(0, 255, (9, 7, 3), dtype=np.uint8)
    assert (codecs.decode(codecs.encode_png(image)) == image).all()
    assert (codecs.decode(b"P6\n# note\n7 9\n255\n" + image.tobytes()) == image).all()


def test_png_filters():
    raw = np.random.default_rng(2).integers(0, 255, (5, 13), dtype=np.uint8)
    raw[:, 0] = [0, 1, 2, 3, 4]
    out = codecs._unfiltered(raw, 3)
    assert (out[0] == raw[0, 1:]).all() and out[1, 3] == (int(raw[1, 4]) + int(out[1, 0])) % 256 and out[3, 0] == (int(raw[3, 1]) + int(out[2, 0]) // 2) % 256


def test_config_reports_every_problem():
    with pytest.raises(ValueError) as e:
        PipelineConfig(ALTITUDE_M=0, TILT_DEGREES=90, MIN_VIRTUAL_HFOV_DEG=60, SPLAT_RADIUS=-1).validate()
    assert all(k in str(e.value) for k in ("ALTITUDE_M", "TILT_DEGREES", "MIN_VIRTUAL_HFOV_DEG", "SPLAT_RADIUS"))
    assert PipelineConfig(RESUME=False).content_hash() == PipelineConfig().content_hash() != PipelineConfig(ALTITUDE_M=3).content_hash()


def _points(spark, rows):
    return spark.createDataFrame(rows, "image_key int, point_id long, x double, y double, z double, is_original boolean, in_crop_mask boolean, in_crop_interior boolean, is_finite boolean")


@pytest.mark.parametrize(("interior", "mask", "original", "tier", "count"), [(50, 60, 60, "interior", 50), (49, 60, 70, "full_crop_mask", 60), (9, 9, 40, "original_region", 40), (0, 0, 0, "none", 0)])
def test_fallback_tiers(spark, interior, mask, original, tier, count):
    rows = [(1, k, float(k), 1.0, 2.0, k < original, k < mask, k < interior, True) for k in range(80)]
    r = pt.crop_centre(_points(spark, rows)).first()
    assert (r["fallback_used"], r["point_count"]) == (tier, count)


def _camera(spark):
    return spark.range(1).selectExpr("1 AS image_key", "named_struct('x', 0D, 'y', 0D, 'z', 0D) AS eye", "0D AS tilt_deg", "10D AS fx")


def test_zbuffer_ties_and_near_plane(spark):
    # straight down: the camera's depth is -y
    rows = [(1, 2, 0.0, -5.0, 0.0, True, True, True, True), (1, 0, 0.0, -5.0, 0.0, True, True, True, True), (1, 1, -0.5, -4.0, 0.0, False, True, True, True), (1, 3, 0.0, -0.05, 0.0, True, True, True, True)]
    got = {(r["u"], r["v"]): r for r in pt.zbuffer(_points(spark, rows), _camera(spark), 8, 8, 0).collect()}
    assert {k: r["point_id"] for k, r in got.items()} == {(4, 4): 0, (5, 4): 1} and got[5, 4]["synthesized"]
    wide = {(r["u"], r["v"]): r["point_id"] for r in pt.zbuffer(_points(spark, rows), _camera(spark), 8, 8, 1).collect()}
    assert wide[4, 4] == 1 and wide[3, 4] == 0


def _mask(spark, cells, w=9, h=9):
    return spark.createDataFrame([(1, x, y, (x, y) in cells, x * 10 + y) for x in range(w) for y in range(h)], "image_key int, x int, y int, mask boolean, v int")


def test_hole_fill(spark):
    disc = {(x, y) for x in range(9) for y in range(9) if (x - 4) ** 2 + (y - 4) ** 2 <= 16}
    frame = _mask(spark, disc).withColumn("valid", ~F.col("mask"))
    got = {(r["x"], r["y"]): r for r in px.holes_filled(frame, "valid", ["v"], 2).collect()}
    assert got[4, 4]["unsupported"] and not got[4, 4]["newly_filled"] and got[0, 4]["newly_filled"] and got[0, 4]["v"] == 3


def test_components_area(spark):
    cells = {(0, 0), (1, 1), (5, 5), (5, 6), (6, 5), (8, 0)}
    got = {(r["x"], r["y"]): r["area"] for r in components.components(_mask(spark, cells), "mask").collect()}
    assert got == {(0, 0): 2, (1, 1): 2, (5, 5): 3, (5, 6): 3, (6, 5): 3, (8, 0): 1}
    kept = {(r["x"], r["y"]) for r in components.without_small_components(_mask(spark, cells), "mask", 3 / 81).where("mask").collect()}
    assert kept == {(5, 5), (5, 6), (6, 5)}


def test_spiral_is_one_component(spark):
    ring = {(x, y) for x in range(9) for y in range(9) if (x in (0, 8) or y in (0, 8)) and (x, y) != (0, 1)} | {(2, y) for y in range(1, 9)}
    assert {r["label"] for r in components.components(_mask(spark, ring), "mask").collect()} == {0}


def test_interior_without_border(spark):
    everything = {(x, y) for x in range(9) for y in range(9)}
    assert px.interior(_mask(spark, everything), "mask", "inside").where("NOT inside").count() == 0


def test_border_crop_limit(spark):
    edge = [(x, y) for x in range(9) for y in range(9) if x in (0, 8) or y in (0, 8)]
    for bad, crops in ((4, False), (5, True)):
        assert px.border_crop(_mask(spark, set(edge[:bad])), "mask", 0.05, 4 / 32).first()["did_crop"] == crops


def test_local_contrast_is_gentle(spark):
    grid = [(1, x, y, 100, 100, 100) for x in range(33) for y in range(20)] + [(2, x, y, 4 * x, 4 * x, 4 * x) for x in range(64) for y in range(9)]
    rows = spark.createDataFrame(grid, "image_key int, x int, y int, r int, g int, b int")
    got = {(r["image_key"], r["x"], r["y"]): (r["r"], r["g"], r["b"]) for r in contrast.locally_contrasted(rows).collect()}
    assert len({v for (k, _, _), v in got.items() if k == 1}) == 1
    assert all(max(v) - min(v) <= 3 for v in got.values())


@pytest.mark.parametrize(("w", "h", "tiles", "clip"), [(33, 20, 8, 1.5), (64, 64, 8, 1.5), (7, 5, 8, 2.0), (50, 41, 3, 4.0), (1, 9, 4, 1.0)])
def test_equalisation_by_definition(spark, w, h, tiles, clip):
    image = np.clip(np.random.default_rng(6).normal(90, 30, (h, w)), 0, 255).astype(int)
    rows = spark.createDataFrame([(1, x, y, int(image[y, x])) for x in range(w) for y in range(h)], "image_key int, x int, y int, v int")
    got = {(r["y"], r["x"]): r["e"] for r in contrast.equalised(rows, "v", "e", tiles, clip).collect()}
    tw, th = -(-w // tiles), -(-h // tiles)
    fold = lambda n, size: [0 if size == 1 else min(k % (2 * size - 2), 2 * size - 2 - k % (2 * size - 2)) for k in range(n)]
    wide = image[np.ix_(fold(th * tiles, h), fold(tw * tiles, w))]
    curves = np.zeros((tiles, tiles, 256))
    for i, j in np.ndindex(tiles, tiles):
        counts = np.bincount(wide[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel(), minlength=256)
        limit = max(1, int(clip * tw * th / 256))
        excess = int(np.maximum(counts - limit, 0).sum())
        counts = np.minimum(counts, limit) + excess // 256
        rest = excess % 256
        for k in range(0, 256, max(1, 256 // rest) if rest else 256):
            if rest:
                counts[k] += 1
                rest -= 1
        curves[i, j] = np.clip(np.rint(np.cumsum(counts) * (255.0 / (tw * th))), 0, 255)
    for y, x in np.ndindex(h, w):
        fy, fx = y / th - 0.5, x / tw - 0.5
        y1, x1 = int(np.floor(fy)), int(np.floor(fx))
        value = lambda a, b, y=y, x=x: curves[min(max(a, 0), tiles - 1), min(max(b, 0), tiles - 1), image[y, x]]
        a, b = fx - x1, fy - y1
        upper, lower = value(y1, x1) * (1 - a) + value(y1, x1 + 1) * a, value(y1 + 1, x1) * (1 - a) + value(y1 + 1, x1 + 1) * a
        assert got[y, x] == np.rint(upper * (1 - b) + lower * b)


def test_lab_and_back(spark):
    rows = spark.createDataFrame([(r, g, b) for r in range(0, 256, 15) for g in range(0, 256, 17) for b in range(0, 256, 51)], "r int, g int, b int")
    back = rows.withColumn("lab", colour.lab(F.col("r"), F.col("g"), F.col("b"))).withColumn("rgb", colour.from_lab(F.col("lab.l"), F.col("lab.a"), F.col("lab.b"))).toPandas()
    rgb, found = back[["r", "g", "b"]].to_numpy(), np.array([[row[c] for c in "lab"] for row in back["lab"]], float)
    light = np.where(rgb / 255 <= 0.04045, rgb / 255 / 12.92, ((rgb / 255 + 0.055) / 1.055) ** 2.4)
    xyz = light @ np.array(colour.TO_XYZ).T / colour.WHITE
    f = np.where(xyz > 0.008856, np.cbrt(xyz), 7.787 * xyz + 16 / 116)
    lightness = np.where(xyz[:, 1] > 0.008856, 116 * f[:, 1] - 16, 903.3 * xyz[:, 1])
    exact = np.stack([lightness * 2.55, 500 * (f[:, 0] - f[:, 1]) + 128, 200 * (f[:, 1] - f[:, 2]) + 128], axis=1)
    assert np.abs(found - exact).max() <= 0.5 + 1e-6
    # the way back, of what was not rounded, is the way there
    whole = spark.createDataFrame([tuple(map(float, e)) for e in exact], "l double, a double, b double").select(colour.from_lab(F.col("l"), F.col("a"), F.col("b")).alias("rgb")).toPandas()
    assert np.abs(np.array([[row[c] for c in "rgb"] for row in whole["rgb"]]) - rgb).max() <= 1
    known = {(255, 255, 255): (255, 128, 128), (0, 0, 0): (0, 128, 128), (255, 0, 0): (136, 208, 195), (0, 255, 0): (224, 42, 211), (0, 0, 255): (82, 207, 20)}
    assert all(tuple(row.lab) == known[row.r, row.g, row.b] for row in back.itertuples() if (row.r, row.g, row.b) in known)


@pytest.mark.parametrize(("w", "h", "new_w", "new_h"), [(8, 8, 5, 3), (9, 4, 9, 1), (7, 7, 2, 7), (6, 4, 3, 2)])
def test_area_resize(spark, w, h, new_w, new_h):
    image = np.random.default_rng(4).integers(0, 256, (h, w))
    rows = spark.createDataFrame([(1, x, y, int(image[y, x])) for x in range(w) for y in range(h)], "image_key int, x int, y int, v int")
    got = {(r["y"], r["x"]): r["v"] for r in resize.resized_area(rows, w, h, new_w, new_h, ["v"]).collect()}
    want = models._shares(h, new_h) @ image @ models._shares(w, new_w).T
    assert len(got) == new_w * new_h and all(got[c] == pytest.approx(want[c]) for c in np.ndindex(new_h, new_w))


@pytest.mark.parametrize("kernel", ["cubic", "lanczos4"])
@pytest.mark.parametrize(("w", "h", "new_w", "new_h"), [(8, 6, 13, 9), (5, 5, 3, 5), (1, 4, 3, 4)])
def test_smooth_resize(spark, kernel, w, h, new_w, new_h):
    import math

    image = np.random.default_rng(5).random((h, w))
    rows = spark.createDataFrame([(1, x, y, float(image[y, x])) for x in range(w) for y in range(h)], "image_key int, x int, y int, v double")
    got = {(r["y"], r["x"]): r["v"] for r in resize.resized_smooth(rows, w, h, new_w, new_h, ["v"], kernel).collect()}

    def weight(d):
        d = abs(d)
        if kernel == "lanczos4":
            return 1.0 if d < 1e-9 else math.sin(math.pi * d) * math.sin(math.pi * d / 4) * 4 / (math.pi * d) ** 2 if d < 4 else 0.0
        return (1.25 * d - 2.25) * d * d + 1 if d <= 1 else ((-0.75 * d + 3.75) * d - 6) * d + 3 if d < 2 else 0.0

    def line(old, new):
        out, reach = np.zeros((new, old)), 2 if kernel == "cubic" else 4
        for t in range(new):
            s = (t + 0.5) * old / new - 0.5
            for k in range(math.floor(s) + 1 - reach, math.floor(s) + reach + 1):
                out[t, min(max(k, 0), old - 1)] += weight(s - k)
        return out / out.sum(axis=1, keepdims=True)

    want = line(h, new_h) @ image @ line(w, new_w).T
    assert len(got) == new_w * new_h and all(got[c] == pytest.approx(want[c], abs=1e-9) for c in np.ndindex(new_h, new_w))


def test_denoising_keeps_edges(spark):
    rows = spark.createDataFrame([(1, x, y, 200 if x > 4 else 20, 90, 90) for x in range(9) for y in range(9)], "image_key int, x int, y int, r int, g int, b int")
    got = {(r["x"], r["y"]): r["r"] for r in finish.denoised(rows).collect()}
    assert got[4, 4] <= 22 and got[5, 4] >= 198


def test_outpaint_keeps_the_original(spark):
    image = field_picture(10, 14)
    raster = spark.createDataFrame([("k", True, None, 14, 10, bytearray(image.tobytes()))], codecs.RASTER)
    r = models.outpainted(raster, 0.45, 0.12).first()
    wide = np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"], 3)
    assert (r["pad_x"], r["pad_y"], wide.shape) == (6, 4, (18, 26, 3)) and (wide[4:14, 6:20] == image).all()


def test_outpaint_blends_into_what_it_generated(spark):
    class CountingOutpaint(models.NearestOutpaint):
        """Paints what is asked for in the shade of the step."""

        steps = 0

        def outpaint(self, image, mask):
            self.steps += 1
            return np.where(mask[:, :, None], np.uint8(self.steps * 50), image).astype(np.uint8)

    image = np.full((20, 20, 3), 7, np.uint8)
    raster = spark.createDataFrame([("k", True, None, 20, 20, bytearray(image.tobytes()))], codecs.RASTER)

    def row(*rest):
        r = models.outpainted(raster, 0.3, 0.15, CountingOutpaint, 1, None, *rest).first()
        wide = np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"], 3)
        assert wide.shape == (32, 32, 3) and (wide[6:26, 6:26] == image).all()
        return wide[16, :6, 0].tolist()

    # two rings of three; the inner one is mixed with the second step's shade, and the original is untouched
    assert row() == [100] * 3 + [50] * 3
    assert row(3) == [100] * 3 + [88, 75, 62] and row(1) == [100] * 3 + [75, 50, 50] and row(9)[3:] == [95, 90, 85]
    assert row(3, False) == [50] * 6


def test_outpaint_side_limit(spark):
    class Limited(models.NearestOutpaint):
        def outpaint(self, image, mask):
            assert max(image.shape) <= 32 and mask.shape == image.shape[:2] and mask.any()
            return super().outpaint(image, mask)

    image = field_picture(40, 56)
    raster = spark.createDataFrame([("a", True, None, 56, 40, image.tobytes())], models._RASTER)
    r = models.outpainted(raster, 0.45, 0.12, Limited, 1, 32).first()
    got = np.frombuffer(r.data, np.uint8).reshape(r.h, r.w, 3)
    assert (got[r.pad_y : r.pad_y + 40, r.pad_x : r.pad_x + 56] == image).all() and (r.w, r.h) == (56 + 2 * r.pad_x, 40 + 2 * r.pad_y)


def test_masks_and_side_limit_reach_the_run(spark, tmp_path, monkeypatch):
    sides, plain = [], models.outpainted
    monkeypatch.setattr(models, "outpainted", lambda *a, **more: sides.append(a[-1]) or plain(*a, **more))
    image = field_picture(40, 56)
    raster = spark.createDataFrame([("a", True, None, 56, 40, image.tobytes())], models._RASTER)
    left = lambda rasters: codecs.pixels_of(rasters).select("image_key", "x", "y", (F.col("x") < 20).alias("mask"))
    run = pipeline.Run(spark, str(tmp_path), PipelineConfig(AI_OUTPAINT_MAX_SIDE=64), pipeline.Models(masks=left))
    out = pipeline.extended_layers(run, raster, codecs.pixels_of(raster)).where("is_original").toPandas()
    assert sides == [64] and set(out.x[out.in_crop_mask] - out.x.min()) == set(range(20))


def test_models_are_checked(spark):
    class Wrong:
        def estimate(self, image):
            return image[:1, :1, 0] * np.nan

        def outpaint(self, image, mask):
            return image[:1]

        def upscale(self, image, scale):
            return image[:1]

    raster = spark.createDataFrame([("k", True, None, 2, 2, bytearray(12))], codecs.RASTER)
    for made, told in ((models.estimated_depth(raster, Wrong), "depth model"), (models.outpainted(raster, 0.5, 0.5, Wrong), "outpaint model"), (models.upscaled(raster, 2.0, 64, Wrong), "upscale model")):
        r = made.first()
        assert not r["ok"] and told in r["error"] and r["data"] is None
    calls = []

    def scarce():
        calls.append(1)
        if len(calls) < 3:
            raise MemoryError
        return 7

    assert models.retried(scarce, 3) == 7
    with pytest.raises(ZeroDivisionError):
        models.retried(lambda: calls.append(1) or 1 / 0, 3)
    assert len(calls) == 4


def test_stage_marks(spark):
    row = spark.sql("SELECT map('validate', named_struct('status', 'done', 'runtime_seconds', 1D, 'error', cast(null AS string)), 'crop_mask', named_struct('status', 'done', 'runtime_seconds', 1D, 'error', cast(null AS string))) AS s")
    done = row.select(manifest.with_stage(F.col("s"), "initial_depth", "done", F.lit(2), F.lit(None)).alias("s")).first()["s"]
    assert {k: v["status"] for k, v in done.items()} == {"validate": "done", "crop_mask": "pending", "initial_depth": "done"}
    failed = row.select(manifest.with_stage(F.col("s"), "initial_depth", "failed", F.lit(2), F.lit("x")).alias("s")).first()["s"]
    assert failed["crop_mask"]["status"] == "done" and failed["initial_depth"]["error"] == "x"


def test_colours(spark):
    r = spark.sql("SELECT 30 AS r, 150 AS g, 30 AS b").select(colour.hsv(F.col("r"), F.col("g"), F.col("b")).alias("c"), colour.is_vegetation(F.col("r"), F.col("g"), F.col("b")).alias("v")).first()
    assert (r["c"]["h"], r["c"]["s"], r["c"]["v"], r["v"]) == (60, 204, 150, True)


def test_ingest_sees_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.png", "b.jpg", "c.txt"):
        (tmp_path / "in" / name).write_bytes(b"x" + name.encode())
    for want in (2, 3):
        ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == want
        (tmp_path / "in/d.webp").write_bytes(b"new")
    assert ingest.arrivals_by_hour(spark.read.parquet(str(tmp_path / "out"))).agg(F.sum("images")).first()[0] == 3


def test_ground_plane(spark):
    rows = [(1, k, float(k % 10), 2.0 if k % 5 else 7.0 + k, float(k // 10), True, True, True, True) for k in range(100)]
    r = pt.ground_planes(_points(spark, rows), 24, 0.05).first()
    assert abs(r["ny"]) == pytest.approx(1) and r["inliers"] == 80 and abs(r["offset"]) == pytest.approx(2)


def test_lanczos_keeps_flat_pictures():
    out = models.LanczosUpscale().upscale(np.full((7, 9, 3), 77, np.uint8), 2.0)
    assert out.shape == (14, 18, 3) and (out == 77).all()


def test_external_masks_and_stems(spark):
    rows = spark.createDataFrame([("k", x, y, 40, 40, 40) for x in range(20) for y in range(20)], "image_key string, x long, y long, r int, g int, b int")
    given = spark.createDataFrame([("k", x, y, x < 10) for x in range(20) for y in range(20)], "image_key string, x long, y long, mask boolean")
    assert pipeline.vegetation(rows, given).where("mask").count() == 200
    files = spark.createDataFrame([("b/x.png",), ("a/x.jpg",), ("a/xy.jpg",)], "image_key string")
    assert images.first_with_stem(files, "x").first()[0] == "a/x.jpg"
