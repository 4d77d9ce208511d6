"""Queries on run records and file lists, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyspark.operators import manifest as mf
from canopyspark.plans.inputs import rounded, table
from canopyspark.sources import images as im

#: Stages that the events table is read as, five of them in order, and the statuses that its event types stand for.
STEPS = ("validate", "initial_depth", "crop_mask", "ai_outpaint", "finalize")
STATUS = {"click": mf.DONE, "view": mf.DONE, "purchase": mf.SKIPPED, "signup": mf.FAILED}


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of paths made from part: image and other files, hidden ones, and ones in owned folders."""
    ends = F.array(*(F.lit(e) for e in (".jpg", ".JPEG", ".png", ".txt", ".TIFF", ".webp", ".gif", "")))
    folder = F.when(F.col("p_partkey") % 11 == 0, f"{im.OWNED[0]}/").when(F.col("p_partkey") % 13 == 0, ".cache/").otherwise(F.concat(F.lit("farm_"), (F.col("p_partkey") % 4).cast("string"), F.lit("/")))
    name = F.concat(F.when(F.col("p_partkey") % 7 == 0, ".").otherwise(""), F.lit("f"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select(F.concat(folder, name, ends[(F.col("p_partkey") % 8).cast("int")]).alias("image_key"))


def discover_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return im.processable(paths(spark, sf_dir)).select("image_key", im.extension(F.col("image_key")).alias("extension"))


DISCOVER = f"""WITH p AS (
    SELECT (CASE WHEN p_partkey % 11 = 0 THEN '{im.OWNED[0]}/' WHEN p_partkey % 13 = 0 THEN '.cache/' ELSE 'farm_' || (p_partkey % 4) || '/' END) || (CASE WHEN p_partkey % 7 = 0 THEN '.' ELSE '' END)
        || 'f' || p_partkey || list_extract(['.jpg', '.JPEG', '.png', '.txt', '.TIFF', '.webp', '.gif', ''], CAST(p_partkey % 8 + 1 AS INTEGER)) AS image_key FROM part)
SELECT image_key, lower(regexp_extract(image_key, '(\\.[^./]+)$', 1)) AS extension FROM p
WHERE lower(regexp_extract(image_key, '(\\.[^./]+)$', 1)) IN ({", ".join(f"'{e}'" for e in im.EXTENSIONS)}) AND NOT starts_with(list_extract(string_split(image_key, '/'), -1), '.')
    AND NOT list_has_any(string_split(image_key, '/'), [{", ".join(f"'{d}'" for d in im.OWNED)}])"""


def stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last record of each image (user) and stage (event number) of events."""
    stage = F.array(*(F.lit(s) for s in STEPS))[(F.col("event_id") % len(STEPS)).cast("int")]
    status = F.coalesce(*(F.when(F.col("event_type") == k, v) for k, v in STATUS.items()), F.lit(mf.PENDING))
    runs = table(spark, sf_dir, "events").select(F.col("user_id").alias("image_key"), stage.alias("stage"), status.alias("status"), F.col("value").alias("runtime_seconds"), F.col("ts").alias("finished_at"), F.col("event_id").alias("run_id"))
    return mf.latest_runs(runs)


_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS.items())
_NAMES = "[" + ", ".join(f"'{s}'" for s in STEPS) + "]"
STAGE_ROWS = f"""sr AS (
    SELECT user_id AS image_key, list_extract({_NAMES}, CAST(event_id % {len(STEPS)} + 1 AS INTEGER)) AS stage, CASE event_type {_CASE} ELSE '{mf.PENDING}' END AS status, value AS runtime_seconds
    FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_id % {len(STEPS)} ORDER BY ts DESC, event_id DESC) = 1)"""


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage maps of the images, their configuration and stored fingerprint."""
    record = F.struct("status", "runtime_seconds", F.lit(None).cast("string").alias("error"))
    maps = stage_rows(spark, sf_dir).groupBy("image_key").agg(F.map_from_entries(F.collect_list(F.struct("stage", record))).alias("stages"))
    config = F.when(F.col("image_key") % 10 == 0, "old").otherwise("new")
    return maps.select("image_key", "stages", config.alias("config_hash"), F.sha2(F.col("image_key").cast("string"), 256).alias("source_sha256"), (F.col("image_key") % 100).alias("source_size"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the images that are there; every seventh has changed."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key.alias("image_key"), F.sha2(key.cast("string"), 256).alias("source_sha256"), F.when(key % 7 == 0, key % 100 + 1).otherwise(key % 100).alias("source_size"))


def resume_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images whose third stage has to run."""
    return mf.work_list(_images(spark, sf_dir), _manifest(spark, sf_dir), STEPS[2], "new", order=STEPS)


_IMAGES = "im AS (SELECT c_custkey AS image_key, sha256(CAST(c_custkey AS VARCHAR)) AS source_sha256, CASE WHEN c_custkey % 7 = 0 THEN c_custkey % 100 + 1 ELSE c_custkey % 100 END AS source_size FROM customer)"
WORKLIST = f"""WITH {STAGE_ROWS}, {_IMAGES},
ok AS (SELECT image_key FROM sr WHERE stage IN ('{STEPS[0]}', '{STEPS[1]}', '{STEPS[2]}') AND status IN ('done', 'skipped') GROUP BY image_key HAVING count(*) = 3)
SELECT im.* FROM im LEFT JOIN ok USING (image_key) WHERE ok.image_key IS NULL OR im.image_key % 10 = 0 OR im.image_key % 7 = 0"""


def invalidate_downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth image recomputes its second stage, every third its fourth."""
    rows = stage_rows(spark, sf_dir).select("image_key", "stage", "status")
    keys = rows.select("image_key").distinct()
    again = keys.where("image_key % 5 = 0").withColumn("stage", F.lit(STEPS[1])).union(keys.where("image_key % 3 = 0").withColumn("stage", F.lit(STEPS[3])))
    return mf.invalidated(rows, again, STEPS)


INVALIDATE = f"""WITH {STAGE_ROWS}
SELECT image_key, stage, CASE WHEN list_position({_NAMES}, stage) > (CASE WHEN image_key % 5 = 0 THEN 2 WHEN image_key % 3 = 0 THEN 4 ELSE 99 END) THEN 'pending' ELSE status END AS status FROM sr"""


def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All images of events as the old records, all customers as the files that are there."""
    old = _manifest(spark, sf_dir).select("image_key", "source_sha256", "source_size", F.lit("done").alias("status"))
    return mf.upserted(old, _images(spark, sf_dir))


UPSERT = f"""WITH {_IMAGES}, new AS (SELECT * FROM im),
old AS (SELECT DISTINCT user_id AS image_key, sha256(CAST(user_id AS VARCHAR)) AS source_sha256, user_id % 100 AS source_size, 'done' AS status FROM events)
SELECT coalesce(new.image_key, old.image_key) AS image_key, coalesce(new.source_sha256, old.source_sha256) AS source_sha256, coalesce(new.source_size, old.source_size) AS source_size, coalesce(old.status, 'pending') AS status,
    coalesce(old.source_sha256 <> new.source_sha256, false) AS changed, new.image_key IS NOT NULL AS present FROM old FULL OUTER JOIN new ON old.image_key = new.image_key"""


def manifest_summary_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mf.summary(stage_rows(spark, sf_dir), STEPS)
    return rounded(out, *(f"{s}_seconds" for s in STEPS), "total_seconds", places=4)


_PIVOT = ", ".join(f"max(status) FILTER (WHERE stage = '{s}') AS {s}_status, round(sum(runtime_seconds) FILTER (WHERE stage = '{s}'), 4) + 0.0 AS {s}_seconds" for s in STEPS)
SUMMARY = f"""WITH {STAGE_ROWS}
SELECT image_key, {_PIVOT}, round(sum(runtime_seconds), 4) + 0.0 AS total_seconds, count(*) FILTER (WHERE status = 'failed') AS n_failed,
    CASE WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed' WHEN count(*) FILTER (WHERE status IN ('done', 'skipped')) = {len(STEPS)} THEN 'done' ELSE 'pending' END AS overall_status
FROM sr GROUP BY image_key"""


def fingerprint_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: stored fingerprints of the even ones, one in six of them outdated."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("image_key"), F.sha2("text", 256).alias("source_sha256"), F.length("text").cast("long").alias("source_size"))
    stored = docs.where("image_key % 2 = 0").withColumn("source_size", F.when(F.col("image_key") % 6 == 0, -1).otherwise(F.col("source_size")))
    return mf.fingerprint_matches(stored, docs)


FINGERPRINT = "SELECT doc_id AS image_key, doc_id % 2 = 0 AND doc_id % 6 <> 0 AS matches FROM documents"

def missing_stage_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order, or without an order of over 200,000."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("image_key"), "o_totalprice")
    return mf.missing_outputs(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("image_key")), orders, orders.where("o_totalprice > 200000"))


MISSING = "SELECT c_custkey AS image_key FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)"


def record_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage records to JSON and back."""
    rows = stage_rows(spark, sf_dir).select("image_key", "stage", "status", "runtime_seconds")
    return mf.from_json(mf.as_json(rows), rows.schema)


ROUND_TRIP = f"WITH {STAGE_ROWS} SELECT image_key, stage, status, runtime_seconds FROM sr"

QUERIES = {
    "missing_stage_outputs": (missing_stage_outputs, MISSING), "record_round_trip": (record_round_trip, ROUND_TRIP),
    "discover_filter": (discover_filter, DISCOVER), "resume_worklist": (resume_worklist, WORKLIST), "invalidate_downstream": (invalidate_downstream, INVALIDATE),
    "manifest_upsert": (manifest_upsert, UPSERT), "manifest_summary_pivot": (manifest_summary_pivot, SUMMARY), "fingerprint_match": (fingerprint_match, FINGERPRINT),
}
