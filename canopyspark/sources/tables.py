"""Intermediate layers as Parquet tables by run: whole writes, guarded reads, cleaning up, unfinished runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Layers that stay when a run's others are deleted, and the folders of exported pictures and of sheets that show how they came about.
EXPORTS, SHEETS = "canopy_views", "canopy_sheets"
KEPT = ("finals", "stage_runs", "summaries", "summary_csv", "runs", "log", EXPORTS, SHEETS)


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def layer_path(root: str, layer: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{layer}/run_id={run_id}"


def _old(root: str, layer: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/_{layer}-{run_id}-old"


def _recovered(spark: SparkSession, root: str, layer: str, run_id: str) -> None:
    """Ends a replacement that was stopped: without a new table the old one takes its place again, and else it goes."""
    old, store = _store(spark, _old(root, layer, run_id))
    if store.exists(old):
        target, _ = _store(spark, layer_path(root, layer, run_id))
        if store.exists(target):
            store.delete(old, True)
        else:
            store.rename(old, target)


def write_layer(df: DataFrame, root: str, layer: str, run_id: str, format: str = "parquet", **options: str) -> None:
    """Replaces the layer of one run. The new table is written beside the old one; the old one is set aside, the new one takes its place,
    and the old one goes. After a stop between any two of these steps, this module's readers find the old table or the new one."""
    spark, path = df.sparkSession, layer_path(root, layer, run_id)
    beside = f"{root.rstrip('/')}/_{layer}-{run_id}-{uuid.uuid4().hex}"
    df.write.format(format).options(**options).save(beside)
    _recovered(spark, root, layer, run_id)
    (target, store), (fresh, _), (old, _) = (_store(spark, p) for p in (path, beside, _old(root, layer, run_id)))
    store.mkdirs(target.getParent())
    if store.exists(target) and not store.rename(target, old):
        raise OSError(f"{path} could not be set aside")
    if not store.rename(fresh, target):
        raise OSError(f"{beside} could not be renamed to {path}")
    store.delete(old, True)


def moved_layer(spark: SparkSession, root: str, layer: str, source: str, target: str) -> None:
    """The layer of the run source becomes that of the run target, in place of what that had."""
    _recovered(spark, root, layer, target)
    (held, store), (fresh, _), (old, _) = (_store(spark, p) for p in (layer_path(root, layer, target), layer_path(root, layer, source), _old(root, layer, target)))
    if store.exists(held):
        store.rename(held, old)
    store.rename(fresh, held)
    store.delete(old, True)


def is_complete(spark: SparkSession, root: str, layer: str, run_id: str) -> bool:
    _recovered(spark, root, layer, run_id)
    where, store = _store(spark, layer_path(root, layer, run_id) + "/_SUCCESS")
    return store.exists(where)


def read_layer(spark: SparkSession, root: str, layer: str, schema: StructType | str) -> DataFrame:
    """The layer of all runs with its run_id; an empty table if there is none yet."""
    top, store = _store(spark, root)
    for status in store.listStatus(top) if store.exists(top) else ():
        name = status.getPath().getName()
        if name.startswith(f"_{layer}-") and name.endswith("-old"):
            _recovered(spark, root, layer, name.removeprefix(f"_{layer}-").removesuffix("-old"))
    where, _ = _store(spark, f"{root.rstrip('/')}/{layer}")
    if not store.exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(where.toString())


def clean_run(spark: SparkSession, root: str, run_id: str, keep: tuple[str, ...] = KEPT) -> list[str]:
    """Deletes a run's intermediate layers, but those to keep, and what writes that ended early have left; returns the layers that went."""
    top, store = _store(spark, root)
    gone = []
    for status in store.listStatus(top):
        layer = status.getPath().getName()
        if layer.startswith("_") and f"-{run_id}-" in layer:
            store.delete(status.getPath(), True)
            continue
        where, _ = _store(spark, layer_path(root, layer, run_id))
        if layer not in keep and store.exists(where):
            store.delete(where, True)
            gone.append(layer)
    return sorted(gone)
