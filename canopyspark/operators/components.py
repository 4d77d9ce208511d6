"""Connected components of masks: labels within tiles, joined where tiles meet, and contracted by image over what meets only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyspark.operators.groups import run_starts, whole_groups
from canopyspark.operators.tiles import SIDE, with_halos


def _roots(image: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """For each run, the first run of its component; runs are sorted by image, y and x0, and images are swept in one go."""
    # rows of two images never follow each other
    line = (y + image * (int(y.max(initial=0)) + 2)).tolist()
    left, right = x0.tolist(), x1.tolist()
    parent = list(range(len(line)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    above = 0
    for k in range(len(line)):
        while above < k and (line[above] < line[k] - 1 or line[above] == line[k] - 1 and right[above] < left[k] - 1):
            above += 1
        other = above
        while other < k and line[other] == line[k] - 1 and left[other] <= right[k] + 1:
            a, b = root(k), root(other)
            parent[max(a, b)] = min(a, b)
            other += 1
    return np.array([root(k) for k in range(len(line))], np.int64)


def _runs_of(x: np.ndarray, y: np.ndarray, tile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of horizontal runs of pixels that are sorted by tile, y and x."""
    new = np.ones(len(x), bool)
    new[1:] = (tile[1:] != tile[:-1]) | (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1)
    begin = np.flatnonzero(new)
    return begin, np.append(begin[1:], len(x)) - 1


def _labelled(side: int, borders: bool):
    """Of each tile, its own runs (y, x0, x1) with the label of their component there, the first own pixel as y and x in one number; or, for
    borders, the pixels (y, x0) within one step of the tile's border, on either side of it, with the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["image_key", "__ty", "__tx"]
        for rows in whole_groups(batches, keys):
            x, y, tx, ty = (np.asarray(rows.column(rows.schema.get_field_index(c))).astype(np.int64) for c in ("x", "y", "__tx", "__ty"))
            start = run_starts(rows, keys)
            tile = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(x))))
            begin, end = _runs_of(x, y, tile)
            root = _roots(tile[begin], y[begin], x[begin], x[end])
            x0, x1 = np.maximum(x[begin], tx[begin] * side), np.minimum(x[end], tx[begin] * side + side - 1)
            own = (y[begin] // side == ty[begin]) & (x0 <= x1)
            label = np.full(len(begin), np.iinfo(np.int64).max)
            np.minimum.at(label, root[own], (y[begin][own] << 32) + x0[own])
            label = label[root]
            if borders:
                of_run = np.repeat(np.arange(len(begin)), end - begin + 1)
                near = np.logical_or.reduce([v % side == 0 for v in (x, y, x + 1, y + 1)]) & (label[of_run] < np.iinfo(np.int64).max)
                picked, columns = np.flatnonzero(near), (y[near], x[near], x[near], label[of_run][near])
            else:
                picked, columns = begin[own], (y[begin][own], x0[own], x1[own], label[own])
            yield pa.record_batch([rows.column(rows.schema.get_field_index("image_key")).take(pa.array(picked)), *(pa.array(c) for c in columns)], ["image_key", "y", "x0", "x1", "label"])

    return run


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """image_key, label, root: the smallest label that each label reaches over the edges (a, b) of its image."""
    for rows in whole_groups(batches, ["image_key"]):
        start = run_starts(rows, ["image_key"])
        a, b = (np.asarray(rows.column(rows.schema.get_field_index(c))) for c in ("a", "b"))
        for i, j in zip(start, [*start[1:], rows.num_rows], strict=True):
            label, place = np.unique(np.concatenate([a[i:j], b[i:j]]), return_inverse=True)
            one, two = place[: j - i], place[j - i :]
            root = np.arange(len(label))
            while True:
                low = np.minimum(root[one], root[two])
                new = root.copy()
                for side in (root[one], root[two], one, two):
                    np.minimum.at(new, side, low)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            image = rows.column(rows.schema.get_field_index("image_key")).take(pa.array(np.full(len(label), i)))
            yield pa.record_batch([image, pa.array(label), pa.array(label[root])], ["image_key", "label", "root"])


def components(pixels: DataFrame, mask: str, side: int = SIDE) -> DataFrame:
    """image_key, x, y, label, area of each mask pixel, 8-connected; the label is the first pixel in row order, as y * width + x.

    A tile is labelled with a halo of one pixel, so the pixels near borders have a label in each tile that sees them; those labels are one
    component. Only they are grouped by image.
    """
    key = dict(pixels.dtypes)["image_key"]
    width = pixels.groupBy("image_key").agg((F.max("x") + 1).cast("long").alias("__w"))
    dealt = with_halos(pixels.where(F.col(mask)).select("image_key", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")), 1, side)
    schema = f"image_key {key}, y long, x0 long, x1 long, label long"
    seen = dealt.mapInArrow(_labelled(side, True), schema)
    edges = seen.groupBy("image_key", "y", "x0").agg(F.min("label").alias("a"), F.collect_set("label").alias("every")).select("image_key", "a", F.explode("every").alias("b")).where("a <> b").distinct()
    roots = edges.repartition("image_key").sortWithinPartitions("image_key").mapInArrow(_contracted, f"image_key {key}, label long, root long")
    runs = dealt.mapInArrow(_labelled(side, False), schema).join(roots, ["image_key", "label"], "left").withColumn("root", F.coalesce("root", "label"))
    areas = runs.groupBy("image_key", "root").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("area"))
    named = runs.join(areas, ["image_key", "root"]).join(width, "image_key")
    label = F.shiftright("root", 32) * F.col("__w") + F.col("root").bitwiseAND(F.lit((1 << 32) - 1))
    return named.select("image_key", F.explode(F.sequence("x0", "x1")).alias("x"), "y", label.alias("label"), "area")


def without_small_components(pixels: DataFrame, mask: str, least_share: float = 0.0005) -> DataFrame:
    """pixels with the mask's components below least_share of the image's pixels gone from it."""
    size = pixels.groupBy("image_key").agg(F.count("*").alias("__n"))
    found = components(pixels, mask).join(size, "image_key").where(F.col("area") >= F.col("__n") * least_share)
    kept = found.select("image_key", F.col("x").alias("__x"), F.col("y").alias("__y"), F.lit(True).alias("__kept"))
    out = pixels.join(kept.withColumnRenamed("image_key", "__k"), (F.col("image_key") == F.col("__k")) & (F.col("x") == F.col("__x")) & (F.col("y") == F.col("__y")), "left")
    return out.withColumn(mask, F.coalesce("__kept", F.lit(False))).drop("__k", "__x", "__y", "__kept")
