"""Helpers shared by the training-data operators: table reading, durable intermediate tables, batch limits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes in one Arrow batch; with whole texts, the default of 10,000 rows could hold hundreds of MB in a Python worker.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of Arrow batches to BATCH_BYTES, as text operators exchange whole texts with Python; the limit is read
    when a plan runs, so it can't be set for one operator alone. A smaller limit, in whatever unit, stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < held <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def shared_root(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset, one in the warehouse. Raises ValueError if that is a folder of one
    machine and the session has others."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/canopyspark-scratch").rstrip("/")
    if not named and not spark.sparkContext.master.startswith("local") and root.startswith(("file:", "/")):
        raise ValueError(f"{root} is on one machine: spark.checkpoint.dir must name a folder that the driver and all executors share")
    return root


class Scratch:
    """One run's intermediate tables, in a folder of its own below the shared root. They cut lineage, survive lost executors and keep
    column pruning. The folder goes with drop, or at the latest when the driver's JVM ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.held = spark, 0
        self.folder = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._store = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._store.mkdirs(self._path)
        self._store.deleteOnExit(self._path)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """df as a Parquet table of the run."""
        self.held += 1
        path = f"{self.folder}/{self.held}-{name}.parquet"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        self._store.delete(self._path, True)

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """df as a table of another folder, when nothing else of the run is needed any more."""
        out = Scratch(self.spark, name).written(df, "result")
        self.drop()
        return out
