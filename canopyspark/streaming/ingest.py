"""New images as a stream: each file is fingerprinted once, and the checkpoint remembers which have been seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from canopyspark.sources.images import processable, qualified

_FILES = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    """image_key, path, seen, source_sha256 and source_size of the images that arrive below root."""
    base = qualified(spark, root).rstrip("/") + "/"
    read = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).load(root)
    named = read.select(F.substring("path", len(base) + 1, 1 << 30).alias("image_key"), "path", F.col("modificationTime").alias("seen"), F.sha2("content", 256).alias("source_sha256"), F.col("length").alias("source_size"))
    return processable(named)


def ingest(spark: SparkSession, root: str, table: str, checkpoint: str) -> StreamingQuery:
    """Appends what has arrived since the last call to a Parquet table, then ends."""
    return arriving(spark, root).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals_by_hour(arrivals: DataFrame, late: str = "2 hours") -> DataFrame:
    """Images and bytes for each hour of a stream (or table) of arrivals; rows later than the watermark are left out of a stream."""
    return arrivals.withWatermark("seen", late).groupBy(F.window("seen", "1 hour").alias("hour")).agg(F.count("*").alias("images"), F.sum("source_size").alias("bytes"))
