"""Photographs to centred top-down views: the stages as one plan over pixel relations, with Parquet layers between them and a run record.

Each stage is a function of relations; a stage whose results other stages share is written as a layer, which is where a plan's lineage
ends. A layer's key is a hash of its settings and of the keys of the layers that it is made of: rows of the same key and content are taken
over from earlier runs, and a run that ended early is taken up under its own id in the same way. An image that fails stays in the records with its error and stops no other.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from canopyspark.config import PipelineConfig
from canopyspark.functions import colour
from canopyspark.functions import geometry as g
from canopyspark.operators import components as cc
from canopyspark.operators import finish, models
from canopyspark.operators import manifest as mf
from canopyspark.operators import pixels as px
from canopyspark.operators import points as pt
from canopyspark.operators.sheets import labelled_sheet
from canopyspark.sources import codecs, images, tables

RECORD = "image_key string, stage string, status string, runtime_seconds double, error string, config_hash string, source_sha256 string, source_size long, finished_at timestamp, run_id string"
_RUNS = "config_hash string, inputs_hash long, chain map<string,string>, started_at timestamp, run_id string"
_SOURCES = "image_key string, source_sha256 string, run_id string"
#: The layer that each stage's result is in; a stage whose layer has a row of an image (with ok, if there is such a column) is done for it.
LAYER_OF = {
    "validate": "rasters", "initial_depth": "depth", "crop_mask": "masks", "ai_outpaint": "canvas", "extended_depth": "canvas_depth", "extended_crop_mask": "extended", "backprojection": "points",
    "camera": "centres", "camera_fitting": "cameras", "render": "rendered", "fill": "frames", "post_warp_super_resolution": "upscaled", "finalize": "finals",
}
#: Of each layer, the layers that it is made of and the settings and models that it depends on itself.
MADE_OF: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "rasters": ((), ()), "depth": (("rasters",), ("depth",)), "masks": (("rasters",), ("CROP_INTERIOR_QUANTILE", "masks")),
    "canvas": (("rasters",), ("AI_OUTPAINT_ENABLED", "AI_OUTPAINT_PAD_FRAC", "AI_OUTPAINT_STEP_FRAC", "AI_OUTPAINT_OVERLAP_PX", "AI_OUTPAINT_PROGRESSIVE", "AI_OUTPAINT_MAX_SIDE", "AI_OUTPAINT_MAX_RETRIES", "outpaint")), "canvas_depth": (("canvas",), ("depth",)),
    "extended": (("depth", "masks", "canvas", "canvas_depth"), ()), "points": (("extended",), ("AI_OUTPAINT_FEATHER_PX", "ASSUMED_HFOV_DEG", "BACKPROJECT_STRIDE")), "centres": (("points",), ()),
    "cameras": (("centres",), ("ALTITUDE_M", "TILT_DEGREES", "CAMERA_FRAME_FILL", "MIN_VIRTUAL_HFOV_DEG", "MAX_VIRTUAL_HFOV_DEG", "frame")), "rendered": (("points", "cameras"), ("SPLAT_RADIUS", "frame")),
    "frames": (("rendered",), ("FILL_RADIUS",)), "cropped": (("frames",), ()), "upscaled": (("cropped",), ("POST_WARP_SUPER_RESOLUTION_ENABLED", "POST_WARP_SUPER_RESOLUTION_SCALE", "POST_WARP_SUPER_RESOLUTION_TILE", "POST_WARP_SUPER_RESOLUTION_TILE_PAD", "POST_WARP_MAX_OUTPUT_DIMENSION", "upscale")),
    "finals": (("upscaled", "cropped"), ()),
}
#: Errors of stages that give an image no row.
NO_ROW = {"backprojection": "no finite points", "camera": "no original points to centre on"}


@dataclass(frozen=True)
class Models:
    """Functions that make the three models; masks, if given, makes (image_key, x, y, mask) of raster rows, in place of vegetation."""

    depth: Callable = models.RowDepth
    outpaint: Callable = models.NearestOutpaint
    upscale: Callable = models.LinearUpscale
    masks: Callable[[DataFrame], DataFrame] | None = None


@dataclass
class Run:
    spark: SparkSession
    root: str
    config: PipelineConfig
    models: Models
    run_id: str = field(default_factory=lambda: time.strftime("run_%Y%m%d_%H%M%S_") + uuid.uuid4().hex[:6])
    #: The frame's width and height.
    frame: tuple[int, int] = (640, 480)
    #: Layers by name, seconds that each took, those that were written, and the images with the content that they are made of.
    layers: dict[str, DataFrame] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    written: list[str] = field(default_factory=list)
    work: DataFrame | None = None
    #: The chains of all runs by id, once they are asked for.
    runs: dict[str, dict[str, str]] | None = None

    def chain(self) -> dict[str, str]:
        """Of each layer, a hash of its settings and models and of the hashes of the layers that it is made of."""
        own = {"frame": str(self.frame)} | {k: self._identity(getattr(self.models, k)) for k in ("depth", "outpaint", "upscale", "masks")}
        found: dict[str, str] = {}
        for name, (made_of, needs) in MADE_OF.items():
            parts = [self.config.part_hash(tuple(n for n in needs if n not in own)), *(own[n] for n in needs if n in own), *(found[m] for m in made_of)]
            found[name] = hashlib.sha256("|".join(parts).encode()).hexdigest()[:16]
        return found

    def _identity(self, model: Callable | None) -> str:
        """A model's name and version; one that is defined within a function has no name that others can't have, and is this run's alone."""
        name = f"{getattr(model, '__module__', '')}.{getattr(model, '__qualname__', type(model).__name__)}:{getattr(model, 'version', '')}"
        return name if "<" not in name or hasattr(model, "version") else name + self.run_id

    def known(self, schema: StructType, name: str) -> DataFrame | None:
        """Rows of the layer, with their run_id, that an earlier run, or attempt, has made of the same content with the same settings; of
        each image, the last run's. None if nothing can be taken over."""
        if self.work is None or not self.config.RESUME or self.config.OVERWRITE or name not in MADE_OF:
            return None
        if self.runs is None:
            self.runs = {r["run_id"]: r["chain"] or {} for r in tables.read_layer(self.spark, self.root, "runs", _RUNS).select("run_id", "chain").collect()}
        own = self.chain()[name]
        alike = [run for run, chain in self.runs.items() if chain.get(name) == own and tables.is_complete(self.spark, self.root, name, run)]
        if not alike:
            return None
        of_those = F.col("run_id").isin(alike)
        rows = tables.read_layer(self.spark, self.root, name, StructType([*schema.fields, StructField("run_id", StringType())])).where(of_those)
        good = rows.where("ok") if "ok" in schema.names else rows
        same = tables.read_layer(self.spark, self.root, "sources", _SOURCES).where(of_those).join(self.work.select("image_key", "source_sha256"), ["image_key", "source_sha256"])
        last = good.select("image_key", "run_id").distinct().join(same.select("image_key", "run_id"), ["image_key", "run_id"]).groupBy("image_key").agg(F.max("run_id").alias("run_id"))
        return good.join(last, ["image_key", "run_id"], "left_semi")

    def layer(self, df: DataFrame, name: str) -> DataFrame:
        """df as the layer of this run. What is known of it is taken over and not written again; only images that lack are computed."""
        began = time.time()
        known = self.known(df.schema, name)
        lacks = None if known is None else self.work.select("image_key").join(known.select("image_key").distinct(), "image_key", "left_anti")
        if lacks is not None and lacks.isEmpty():
            self.layers[name] = known.drop("run_id")
        else:
            others = None
            if lacks is not None:
                # a run's layer is replaced whole, so what it has of an earlier attempt is written again
                own, others = (known.where(F.col("run_id") == self.run_id).drop("run_id"), known.where(F.col("run_id") != self.run_id).drop("run_id"))
                df = df.join(lacks, "image_key", "left_semi").unionByName(own)
            tables.write_layer(df, self.root, name, self.run_id)
            self.written.append(name)
            fresh = self.spark.read.schema(df.schema).parquet(tables.layer_path(self.root, name, self.run_id))
            self.layers[name] = fresh if others is None else fresh.unionByName(others)
        self.seconds[name] = time.time() - began
        return self.layers[name]


def vegetation(pixels: DataFrame, masks: DataFrame | None = None) -> DataFrame:
    """pixels with mask: vegetation, opened and closed, without tiny components, or all of an image that has too little. masks
    (image_key, x, y, mask) takes the place of vegetation in the images it knows."""
    green = pixels.withColumn("mask", colour.is_vegetation(F.col("r"), F.col("g"), F.col("b")))
    if masks is not None:
        known = masks.select("image_key", "x", "y", F.col("mask").alias("__own"))
        green = green.join(known, ["image_key", "x", "y"], "left").withColumn("mask", F.coalesce("__own", "mask")).drop("__own")
    clean = px.opened_and_closed(green, "mask", "__m").withColumn("mask", F.col("__m")).drop("__m")
    return px.mask_or_all(cc.without_small_components(clean, "mask"), "mask")


def canvas(run: Run, rasters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raster rows of the extended images, and their pads."""
    pad = run.config.AI_OUTPAINT_PAD_FRAC if run.config.AI_OUTPAINT_ENABLED else 0.0
    c = run.config
    grown = models.outpainted(rasters, pad, c.AI_OUTPAINT_STEP_FRAC, run.models.outpaint, c.AI_OUTPAINT_MAX_RETRIES + 1, c.AI_OUTPAINT_MAX_SIDE, overlap=c.AI_OUTPAINT_OVERLAP_PX, progressive=c.AI_OUTPAINT_PROGRESSIVE)
    grown = run.layer(grown, "canvas")
    return grown, grown.select("image_key", "pad_x", "pad_y")


def extended_layers(run: Run, rasters: DataFrame, pixels: DataFrame) -> DataFrame:
    """The canvas's pixels with depth d, is_original, in_crop_mask and in_crop_interior: what the original has is kept where it is, and the
    canvas's depth is aligned to it."""
    masks = run.models.masks(rasters) if run.models.masks else None
    depth = run.layer(models.estimated_depth(rasters, run.models.depth), "depth")
    own = px.interior(vegetation(pixels, masks), "mask", "interior", run.config.CROP_INTERIOR_QUANTILE).select("image_key", "x", "y", "mask", "interior")
    own = run.layer(own, "masks")
    own = own.join(models.depth_pixels(depth), ["image_key", "x", "y"]).withColumnRenamed("d", "own_d")
    grown, pads = canvas(run, rasters)
    wide_depth = run.layer(models.estimated_depth(grown, run.models.depth), "canvas_depth")
    wide = vegetation(codecs.pixels_of(grown)).select("image_key", "x", "y", "r", "g", "b", "w", "h", F.col("mask").alias("wide_mask"))
    wide = wide.join(models.depth_pixels(wide_depth), ["image_key", "x", "y"])
    moved = own.join(pads, "image_key").select("image_key", (F.col("x") + F.col("pad_x")).alias("x"), (F.col("y") + F.col("pad_y")).alias("y"), "mask", "interior", "own_d")
    both = wide.join(moved, ["image_key", "x", "y"], "left")
    both = run.layer(both.join(own.select("image_key").distinct(), "image_key", "left_semi"), "extended")
    fit = px.affine_alignment(both.where(F.col("own_d").isNotNull()), "d", "own_d")
    aligned = F.least(F.greatest(F.col("a") * F.col("d") + F.col("b_"), F.lit(0.0)), F.lit(1.0))
    placed = both.join(fit.withColumnRenamed("b", "b_"), "image_key")
    out = placed.select(
        "image_key", "x", "y", "r", "g", "b", "w", "h", F.coalesce("own_d", aligned).alias("d"), F.col("own_d").isNotNull().alias("is_original"),
        F.coalesce("mask", "wide_mask").alias("in_crop_mask"), F.coalesce("interior", F.lit(False)).alias("in_crop_interior"),
    )
    return px.feathered(out, "is_original", ["r", "g", "b", "d"], run.config.AI_OUTPAINT_FEATHER_PX).withColumn("depth_m", g.metric_depth(F.col("d"))).drop("d")


def rendered(run: Run, pixels: DataFrame, out_w: int, out_h: int) -> tuple[DataFrame, DataFrame]:
    """The filled frame of each image, and its camera."""
    c = run.config
    points = run.layer(pt.backproject(pixels, c.ASSUMED_HFOV_DEG, c.BACKPROJECT_STRIDE), "points")
    centres = pt.crop_centre(points)
    run.layer(centres.where("fallback_used <> 'none'").select("image_key"), "centres")
    cameras = pt.placed_cameras(centres.where("fallback_used <> 'none'"), c.ALTITUDE_M, c.TILT_DEGREES)
    cameras = run.layer(pt.fitted_cameras(pt.selected(points, centres), cameras, out_w, out_h, c.CAMERA_FRAME_FILL, c.MIN_VIRTUAL_HFOV_DEG, c.MAX_VIRTUAL_HFOV_DEG), "cameras")
    hit = pt.zbuffer(points, cameras, out_w, out_h, c.SPLAT_RADIUS, ["r", "g", "b"])
    grid = cameras.select("image_key", F.explode(F.sequence(F.lit(0), F.lit(out_h - 1))).alias("y")).select("image_key", "y", F.explode(F.sequence(F.lit(0), F.lit(out_w - 1))).alias("x"))
    found = hit.select("image_key", F.col("u").alias("x"), F.col("v").alias("y"), "r", "g", "b", "z", "synthesized")
    frame = grid.withColumns({"x": F.col("x").cast("long"), "y": F.col("y").cast("long")}).join(found, ["image_key", "x", "y"], "left")
    frame = frame.withColumns({"valid": F.col("z").isNotNull(), "synthesized": F.coalesce("synthesized", F.lit(False)), **{k: F.coalesce(k, F.lit(0)) for k in "rgb"}})
    frame = run.layer(frame, "rendered")
    filled = run.layer(px.fill_smoothed(px.holes_filled(frame, "valid", ["r", "g", "b"], c.FILL_RADIUS), ["r", "g", "b"]), "frames")
    return px.cropped(filled, px.border_crop(filled, "unsupported")), cameras


def run_images(run: Run, content: DataFrame, out_w: int = 640, out_h: int = 480) -> DataFrame:
    """One row per image (image_key, content): status, error, original size, camera figures, shares of the frame, final size. Results are
    in the layer finals, as raster rows."""
    run.config.validate()
    run.frame = (out_w, out_h)
    rasters = run.layer(codecs.decoded(content), "rasters")
    pixels = codecs.pixels_of(rasters)
    frame, cameras = rendered(run, extended_layers(run, rasters, pixels), out_w, out_h)
    frame = run.layer(frame, "cropped")
    small = codecs.rasters_of(frame)
    if run.config.POST_WARP_SUPER_RESOLUTION_ENABLED:
        c = run.config
        small = models.upscaled(small, c.POST_WARP_SUPER_RESOLUTION_SCALE, c.POST_WARP_MAX_OUTPUT_DIMENSION, run.models.upscale, tile=c.POST_WARP_SUPER_RESOLUTION_TILE, pad=c.POST_WARP_SUPER_RESOLUTION_TILE_PAD)
    else:
        small = small.withColumn("scale", F.lit(1.0))
    large = run.layer(small, "upscaled")
    finals = run.layer(codecs.rasters_of(finish.finished(codecs.pixels_of(large), frame)), "finals")
    shares = frame.groupBy("image_key").agg(*((F.avg(F.col(k).cast("double")) * 100).alias(f"{k}_pct") for k in ("valid", "synthesized", "newly_filled", "unsupported")))
    masks = run.layers["masks"].groupBy("image_key").agg((F.avg(F.col("mask").cast("double")) * 100).alias("crop_mask_pct"))
    ended = stage_records(run, rasters.select("image_key"))
    status = ended.groupBy("image_key").agg(F.max(F.when(F.col("status") == mf.FAILED, F.col("error"))).alias("error"), F.bool_or(F.col("status") == mf.FAILED).alias("failed"), F.sum("runtime_seconds").alias("runtime_seconds"))
    out = rasters.select("image_key", F.col("w").alias("original_width"), F.col("h").alias("original_height"))
    out = out.join(status, "image_key").withColumn("status", F.when(F.col("failed"), mf.FAILED).otherwise(mf.DONE)).drop("failed")
    out = out.join(masks, "image_key", "left").join(cameras.select("image_key", "point_count", "fallback_used", "eye", "target", "hfov_deg"), "image_key", "left").join(shares, "image_key", "left")
    return out.join(large.select("image_key", F.col("scale").alias("effective_scale")), "image_key", "left").join(finals.select("image_key", F.col("w").alias("final_width"), F.col("h").alias("final_height")), "image_key", "left")


#: What a sheet shows, panel by panel.
PANELS = ("source", "depth", "crop mask", "canvas", "canvas depth", "canvas mask", "rendered", "validity", "filled", "upscaled", "final")


def panels(run: Run) -> DataFrame:
    """image_key, panel, x, y, r, g, b, w, h: pictures of what the stages made of each image that has a final result. The layers must be
    written; each is read once."""
    layers, key = run.layers, ["image_key", "x", "y"]
    sizes = lambda rasters: rasters.where("ok").select("image_key", F.col("w").cast("long").alias("w"), F.col("h").cast("long").alias("h"))
    coloured = lambda depth: models.depth_pixels(depth).withColumn("c", colour.depth_colour(F.col("d"))).select(*key, "c.r", "c.g", "c.b").join(sizes(depth), "image_key")
    source, wide = codecs.pixels_of(layers["rasters"]), layers["extended"]
    wide_masks = wide.select(*key, "r", "g", "b", "w", "h", F.coalesce("mask", "wide_mask").alias("mask"), F.coalesce("interior", F.lit(False)).alias("interior"))
    w, h = (F.lit(n).cast("long") for n in run.frame)
    frame = lambda df: df.withColumns({"w": w, "h": h})
    white = F.when(F.col("valid"), 255).otherwise(0)
    shown = {
        "source": source, "depth": coloured(layers["depth"]), "crop mask": px.overlaid(source.join(layers["masks"].select(*key, "mask", "interior"), key), "mask", "interior"),
        "canvas": codecs.pixels_of(layers["canvas"]), "canvas depth": coloured(layers["canvas_depth"]), "canvas mask": px.overlaid(wide_masks, "mask", "interior"),
        "rendered": frame(layers["rendered"]), "validity": frame(layers["rendered"].withColumns({c: white for c in "rgb"})), "filled": frame(layers["frames"]),
        "upscaled": codecs.pixels_of(layers["upscaled"]), "final": codecs.pixels_of(layers["finals"]),
    }
    out = None
    for k, name in enumerate(PANELS):
        own = shown[name].select(*key, *(F.col(c).cast("int").alias(c) for c in "rgb"), "w", "h", F.lit(k).alias("panel"))
        out = own if out is None else out.unionByName(own)
    return out.join(layers["finals"].where("ok").select("image_key"), "image_key", "left_semi")


def diagnostic_sheets(run: Run) -> DataFrame:
    """Raster rows of one labelled sheet for each image that has a final result; image_key is the sheet's file name."""
    labels = run.spark.createDataFrame(list(enumerate(PANELS)), "panel int, label string")
    sheets = codecs.rasters_of(labelled_sheet(panels(run), labels))
    return sheets.withColumn("image_key", F.concat("image_key", F.lit(SHEET_ENDING)))


#: Behind a source's name in that of its sheet.
SHEET_ENDING = ".diagnostic.png"


def diagnostic_sheet(spark: SparkSession, output_folder: str, stem: str) -> DataFrame:
    """image_key, path and content of the first sheet, by path, of a source whose name without its extension is stem; no row if there is
    none."""
    files = images.contents(spark, f"{output_folder.rstrip('/')}/{tables.SHEETS}")
    named = files.withColumn("image_key", F.regexp_replace("image_key", SHEET_ENDING.replace(".", r"\.") + "$", ""))
    return images.first_with_stem(named, stem)


def stage_records(run: Run, images: DataFrame) -> DataFrame:
    """image_key, stage, status, runtime_seconds and error of all thirteen stages of the run's images.

    An image's first stage without a good result is failed, with the error, and the later ones are pending; stages that are switched off
    are skipped. runtime_seconds is an image's share of what its stage's layer took for all of them.
    """
    config = run.config
    off = {"ai_outpaint": not config.AI_OUTPAINT_ENABLED, "post_warp_super_resolution": not config.POST_WARP_SUPER_RESOLUTION_ENABLED}
    found = None
    for place, (stage, name) in enumerate(LAYER_OF.items()):
        layer = run.layers[name]
        own = layer.select("image_key", "ok", "error") if "ok" in layer.columns else layer.select("image_key", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error")).distinct()
        own = own.withColumns({"place": F.lit(place), "stage": F.lit(stage)})
        found = own if found is None else found.unionByName(own)
    number = max(1, images.count())
    told = F.create_map(*(x for s, e in NO_ROW.items() for x in (F.lit(s), F.lit(e))))
    stages = F.array(*(F.struct(F.lit(k).alias("place"), F.lit(s).alias("stage"), F.lit(run.seconds[name] / number).alias("seconds"), F.lit(off.get(s, False)).alias("off")) for k, (s, name) in enumerate(LAYER_OF.items())))
    every = images.select("image_key", F.explode(stages).alias("s")).select("image_key", "s.*")
    joined = every.join(found.drop("stage"), ["image_key", "place"], "left").withColumn("good", F.coalesce("ok", F.lit(False)))
    first = F.min(F.when(~F.col("good"), F.col("place"))).over(Window.partitionBy("image_key"))
    judged = joined.withColumn("first", first)
    reached = F.col("first").isNull() | (F.col("place") <= F.col("first"))
    status = F.when(F.col("place") == F.col("first"), mf.FAILED).when(~reached, mf.PENDING).when(F.col("off"), mf.SKIPPED).otherwise(mf.DONE)
    error = F.when(F.col("place") == F.col("first"), F.coalesce("error", F.element_at(told, F.col("stage")), F.concat("stage", F.lit(" gave no result"))))
    return judged.select("image_key", "stage", status.alias("status"), F.when(reached, F.col("seconds")).alias("runtime_seconds"), error.alias("error"))


def _records(spark: SparkSession, root: str) -> DataFrame:
    return mf.latest_runs(tables.read_layer(spark, root, "stage_runs", RECORD))


def _manifest(records: DataFrame) -> DataFrame:
    """One row per image: its stages, and the configuration and content that its last stage was computed from."""
    record = F.struct("status", "runtime_seconds", "error")
    last = {k: F.max_by(k, F.struct("finished_at", "run_id")).alias(k) for k in ("config_hash", "source_sha256", "source_size")}
    return records.groupBy("image_key").agg(F.map_from_entries(F.collect_list(F.struct("stage", record))).alias("stages"), *last.values())


def _unfinished(spark: SparkSession, root: str, config: PipelineConfig, inputs_hash: int) -> str | None:
    """The last run, if it had the same configuration and inputs and left no records."""
    last = tables.read_layer(spark, root, "runs", _RUNS).orderBy(F.desc("started_at")).first()
    same = last and config.RESUME and not config.OVERWRITE and (last["config_hash"], last["inputs_hash"]) == (config.content_hash(), inputs_hash)
    return last["run_id"] if same and not tables.is_complete(spark, root, "stage_runs", last["run_id"]) else None


def run_pipeline(spark: SparkSession, input_folder: str, output_folder: str, config: PipelineConfig | None = None, parts: Models | None = None, frame: tuple[int, int] = (640, 480)) -> DataFrame:
    """The summary of all images below input_folder: one row each, with every stage's status. Images whose stages are all done with the same
    content and settings are not computed again, unless the configuration says so, and of the others, stages that a changed setting doesn't
    reach are taken over from earlier runs; records of files that are gone stay, with present false.

    Layers of the output folder: finals (raster rows), canopy_views (the same as files, under the sources' names), canopy_sheets (one
    labelled sheet of the stages' pictures for each source, as files), stage_runs, summaries and summary_csv, runs and log, and the
    intermediate ones.
    """
    config = config or PipelineConfig()
    config.validate()
    began, events = time.time(), []
    content = images.contents(spark, input_folder, config.RECURSIVE)
    run = Run(spark, output_folder, config, parts or Models())
    seen = run.layer(images.checked(spark, input_folder, config.RECURSIVE), "sources")
    before = _records(spark, output_folder)
    asked = lambda seen: mf.work_list(seen.where("error IS NULL").select("image_key", "source_sha256", "source_size"), _manifest(before), mf.STAGES[-1], config.content_hash(), config.RESUME, config.OVERWRITE)
    todo = asked(seen)
    inputs_hash = todo.agg(F.coalesce(F.bit_xor(F.xxhash64("image_key", "source_sha256")), F.lit(0).cast("long"))).first()[0]
    run.frame = frame
    if earlier := _unfinished(spark, output_folder, config, inputs_hash):
        tables.moved_layer(spark, output_folder, "sources", run.run_id, earlier)
        run.run_id = earlier
        seen = spark.read.schema(seen.schema).parquet(tables.layer_path(output_folder, "sources", earlier))
        todo = asked(seen)
    else:
        row = spark.createDataFrame([(config.content_hash(), inputs_hash, run.chain())], "config_hash string, inputs_hash long, chain map<string,string>").withColumn("started_at", F.current_timestamp())
        tables.write_layer(row, output_folder, "runs", run.run_id)
    fingerprints = seen.select("image_key", "source_sha256")
    tables.write_layer(todo.select("image_key").join(fingerprints, "image_key"), output_folder, "work", run.run_id)
    todo = run.work = spark.read.parquet(tables.layer_path(output_folder, "work", run.run_id))
    summary = run_images(run, content.join(todo.select("image_key"), "image_key", "left_semi"), *frame)
    tables.write_layer(summary, output_folder, "summaries", run.run_id)
    records = stage_records(run, run.layers["rasters"].select("image_key"))
    unread = seen.where("error IS NOT NULL").select("image_key", F.lit(mf.STAGES[0]).alias("stage"), F.lit(mf.FAILED).alias("status"), F.lit(0.0).alias("runtime_seconds"), "error")
    prints = seen.select("image_key", "source_sha256", F.coalesce("source_size", "length").alias("source_size"))
    records = records.unionByName(unread).join(prints, "image_key").withColumns({"config_hash": F.lit(config.content_hash()), "finished_at": F.current_timestamp()})
    codecs.exported(run.layers["finals"], f"{output_folder.rstrip('/')}/{tables.EXPORTS}").write.format("noop").mode("overwrite").save()
    if config.SAVE_DEBUG_VISUALIZATION and not run.layers["finals"].isEmpty():
        began_sheets = time.time()
        codecs.exported(diagnostic_sheets(run), f"{output_folder.rstrip('/')}/{tables.SHEETS}").write.format("noop").mode("overwrite").save()
        run.seconds["sheets"] = time.time() - began_sheets
    tables.write_layer(records, output_folder, "stage_runs", run.run_id)
    events += [(name, float(seconds)) for name, seconds in run.seconds.items()] + [("all", time.time() - began)]
    tables.write_layer(spark.createDataFrame(events, "layer string, seconds double").withColumn("logged_at", F.current_timestamp()), output_folder, "log", run.run_id, "json")
    if not config.CONTINUE_ON_ERROR and (bad := records.where(F.col("status") == mf.FAILED).select("image_key", "error").first()):
        raise RuntimeError(bad)
    out = full_summary(spark, output_folder, seen)
    flat = out.withColumns({k: F.to_json(k) for k, kind in out.dtypes if kind.startswith("struct")})
    tables.write_layer(flat, output_folder, "summary_csv", run.run_id, "csv", header="true")
    return out


def full_summary(spark: SparkSession, output_folder: str, seen: DataFrame) -> DataFrame:
    """One row per image that any run has a record of: status, error, seconds, fingerprint, base figures, and every stage's status and seconds."""
    records = _records(spark, output_folder)
    last = records.groupBy("image_key").agg(
        F.max_by("run_id", F.struct("finished_at", "run_id")).alias("run_id"), F.max(F.when(F.col("status") == mf.FAILED, F.col("error"))).alias("error"),
        *(F.max_by(k, F.struct("finished_at", "run_id")).alias(k) for k in ("config_hash", "source_sha256", "source_size")),
    )
    stages = mf.summary(records, mf.STAGES).withColumnsRenamed({"overall_status": "status", "total_seconds": "runtime_seconds"})
    path = f"{output_folder.rstrip('/')}/summaries"
    base = spark.read.parquet(path).drop("status", "error", "runtime_seconds") if tables.read_layer(spark, output_folder, "summaries", "image_key string").take(1) else None
    out = last.join(stages, "image_key")
    if base is not None:
        out = out.join(base, ["image_key", "run_id"], "left")
    present = seen.select("image_key", F.lit(True).alias("present"))
    return out.join(present, "image_key", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def process_single_image(spark: SparkSession, path: str, output_folder: str, config: PipelineConfig | None = None, parts: Models | None = None) -> DataFrame:
    """The same plan for one file."""
    content = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("image_key"), "content")
    return run_images(Run(spark, output_folder, config or PipelineConfig(), parts or Models()), content)
