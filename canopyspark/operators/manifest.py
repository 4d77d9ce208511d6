"""Run records as relations: resume work lists, upserts, invalidation and summaries.

stages is MAP<STRING, STRUCT<status, runtime_seconds, error>>; a manifest has one row per image.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The stages in order, and the statuses.
STAGES = (
    "validate", "initial_depth", "crop_mask", "ai_outpaint", "extended_depth", "extended_crop_mask", "backprojection", "camera", "camera_fitting", "render", "fill",
    "post_warp_super_resolution", "finalize",
)
PENDING, RUNNING, DONE, SKIPPED, FAILED = "pending", "running", "done", "skipped", "failed"


def _status(stages: Column, stage: str) -> Column:
    return F.element_at(stages, F.lit(stage))["status"]


def _finished(stages: Column, stage: str) -> Column:
    return F.coalesce(_status(stages, stage).isin(DONE, SKIPPED), F.lit(False))


def upstream_finished(stages: Column, stage: str, order: Sequence[str] = STAGES) -> Column:
    """Whether every earlier stage is done or skipped."""
    out = F.lit(True)
    for earlier in order[: order.index(stage)]:
        out = out & _finished(stages, earlier)
    return out


def can_skip(stages: Column, stage: str, same_config: Column, same_source: Column, outputs_complete: Column, resume: bool = True, overwrite: bool = False, order: Sequence[str] = STAGES) -> Column:
    """Whether a stage's earlier result holds: done before, all before it done, same configuration and source, outputs there."""
    if overwrite or not resume:
        return F.lit(False)
    return _finished(stages, stage) & upstream_finished(stages, stage, order) & F.coalesce(same_config & same_source & outputs_complete, F.lit(False))


def work_list(images: DataFrame, manifest: DataFrame, stage: str, config_hash: str, resume: bool = True, overwrite: bool = False, order: Sequence[str] = STAGES) -> DataFrame:
    """Images (image_key, source_sha256, source_size) whose stage has to run: all that the manifest doesn't let skip it."""
    known = manifest.select("image_key", "stages", "config_hash", F.col("source_sha256").alias("__sha"), F.col("source_size").alias("__size"))
    joined = images.join(known, "image_key", "left")
    same = (F.col("source_sha256") == F.col("__sha")) & (F.col("source_size") == F.col("__size"))
    skip = can_skip(F.col("stages"), stage, F.col("config_hash") == config_hash, same, F.lit(True), resume, overwrite, order)
    return joined.where(~skip).select(*images.columns)


def latest_runs(stage_runs: DataFrame) -> DataFrame:
    """The last record of each image and stage (ties: the larger run_id)."""
    last = Window.partitionBy("image_key", "stage").orderBy(F.desc("finished_at"), F.desc("run_id"))
    return stage_runs.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def with_stage(stages: Column, stage: str, status: str, runtime: Column, error: Column, order: Sequence[str] = STAGES) -> Column:
    """stages after a stage ended: its record set and, if it is done anew, the later ones that were known back to pending."""
    record = F.struct(F.lit(status).alias("status"), runtime.cast("double").alias("runtime_seconds"), error.cast("string").alias("error"))
    later = F.array(*(F.lit(s) for s in order[order.index(stage) + 1 :])) if stage != order[-1] else F.array().cast("array<string>")
    others = F.map_filter(stages, lambda k, _: k != stage)
    if status == DONE:
        others = F.transform_values(others, lambda k, v: F.when(F.array_contains(later, k), v.withField("status", F.lit(PENDING))).otherwise(v))
    return F.map_concat(others, F.create_map(F.lit(stage), record))


def invalidated(stage_rows: DataFrame, recomputed: DataFrame, order: Sequence[str] = STAGES) -> DataFrame:
    """stage_rows (image_key, stage, status, ...) with every stage after the earliest recomputed (image_key, stage) one back to pending."""
    place = F.array_position(F.array(*(F.lit(s) for s in order)), F.col("stage"))
    first = recomputed.select("image_key", place.alias("__p")).groupBy("image_key").agg(F.min("__p").alias("__first"))
    joined = stage_rows.join(first, "image_key", "left")
    return joined.withColumn("status", F.when(place > F.col("__first"), PENDING).otherwise(F.col("status"))).drop("__first")


def upserted(manifest: DataFrame, images: DataFrame) -> DataFrame:
    """A full outer join: new images are pending, known ones take the new fingerprint, and records without a file stay with present false."""
    seen = images.select("image_key", F.col("source_sha256").alias("__sha"), F.col("source_size").alias("__size"), F.lit(True).alias("__here"))
    out = manifest.join(seen, "image_key", "full_outer")
    return out.withColumns(
        {"status": F.coalesce("status", F.lit(PENDING)), "changed": F.coalesce(F.col("source_sha256") != F.col("__sha"), F.lit(False)), "source_sha256": F.coalesce("__sha", "source_sha256"), "source_size": F.coalesce("__size", "source_size"), "present": F.coalesce("__here", F.lit(False))}
    ).drop("__sha", "__size", "__here")


def summary(stage_rows: DataFrame, order: Sequence[str] = STAGES) -> DataFrame:
    """One row per image: each stage's status and seconds, the total, the number of failures and the overall status. The stages are given,
    so no pass over the data is needed to find the columns."""
    columns = []
    for s in order:
        own = F.col("stage") == s
        columns += [F.max(F.when(own, F.col("status"))).alias(f"{s}_status"), F.sum(F.when(own, F.col("runtime_seconds"))).alias(f"{s}_seconds")]
    failed = F.count_if(F.col("status") == FAILED)
    overall = F.when(failed > 0, FAILED).when(F.count_if(F.col("status").isin(DONE, SKIPPED)) == len(order), DONE).otherwise(PENDING)
    return stage_rows.groupBy("image_key").agg(*columns, F.sum("runtime_seconds").alias("total_seconds"), failed.alias("n_failed"), overall.alias("overall_status"))


def fingerprint_matches(stored: DataFrame, current: DataFrame) -> DataFrame:
    """image_key and matches: whether sha256 and size are as stored; an image that isn't stored doesn't match."""
    old = stored.select("image_key", F.col("source_sha256").alias("__sha"), F.col("source_size").alias("__size"))
    same = (F.col("source_sha256") == F.col("__sha")) & (F.col("source_size") == F.col("__size"))
    return current.join(old, "image_key", "left").select("image_key", F.coalesce(same, F.lit(False)).alias("matches"))


def missing_outputs(images: DataFrame, *outputs: DataFrame) -> DataFrame:
    """Images that an earlier stage gave no row: each output (image_key, ...) is needed before the next stage can run."""
    missing = images.select("image_key").limit(0)
    for output in outputs:
        missing = missing.unionByName(images.select("image_key").join(output.select("image_key"), "image_key", "left_anti"))
    return missing.distinct()


def as_json(manifest: DataFrame) -> DataFrame:
    """image_key and record: each row as JSON, absent values included."""
    return manifest.select("image_key", F.to_json(F.struct(*manifest.columns), {"ignoreNullFields": "false"}).alias("record"))


def from_json(records: DataFrame, schema) -> DataFrame:
    """Rows of a schema from JSON records; fields that the schema doesn't have are left out, and broken records are rows of nulls."""
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")
