"""Groups compared in tiles of bounded size, so that no task holds a whole group, and a reader of sorted runs for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyspark.llm.shared import Scratch

#: Makes, of a tile's rows, the function that tells which of some rows (by number) are near one row.
Nearness = Callable[[pa.Table], Callable[[int, np.ndarray], np.ndarray]]
#: Blocks of a group up to which all its pairs are compared at once, each row being shuffled once for each block.
FEW_BLOCKS = 8
#: Parts that a block is cut into where rows are held against one row only, so that tasks are even.
PARTS = 4


def _weight(rows: int, units: int):
    return F.greatest(F.lit(1.0 / rows), F.col("n") / F.lit(float(units)))


def _blocks(weight):
    return F.ceil(weight - 1e-9).cast("int")


def tiled(members: DataFrame, group: str, order: str, rows: int, units: int) -> DataFrame:
    """Members dealt to tiles (group, i, j), i <= j, sorted by tile, side and size within each partition: all pairs of a group.

    members: group, order (the vertex), n (set size) and whatever a tile needs. A group that is larger than a block, of about `rows`
    members and `units` elements, is dealt to blocks by a hash of the vertex; a tile holds blocks i and j, so any two members of a group
    meet in exactly one tile. A group of m members makes (m / rows)^2 / 2 tiles, each of bounded size.
    """
    large = members.groupBy(group).agg(_blocks(F.sum(_weight(rows, units))).alias("blocks")).where("blocks > 1")
    dealt = members.join(large, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(order), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks")
    return dealt.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", "block", "n")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Each run of rows with equal keys, put together over batch borders; a run is one tile, of bounded size."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(batch.schema.get_field_index(k))) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is None or tuple(c[0] for c in columns) != last
        last = tuple(c[-1] for c in columns)
        at = 0
        for cut in [*np.flatnonzero(new), batch.num_rows]:
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if cut < batch.num_rows and held:
                yield pa.Table.from_batches(held)
                held = []
            at = cut
    if held:
        yield pa.Table.from_batches(held)


def roots(size: int, near: Callable[[int, np.ndarray], np.ndarray], side: np.ndarray | None = None) -> np.ndarray:
    """The first row of each row's component. A row is held only against rows that no component has yet (of the other side, if there are
    two), so a tile in which all is linked takes one step, and none takes more than one for each row."""
    root = np.full(size, -1)
    for first in range(size):
        if root[first] >= 0:
            continue
        root[first], todo = first, [first]
        while todo:
            row = todo.pop()
            free = root < 0 if side is None else (root < 0) & (side != side[row])
            others = np.flatnonzero(free)
            if len(others):
                hit = others[near(row, others)]
                root[hit] = first
                todo += hit.tolist()
    return root


def connecting_edges(members: DataFrame, nearness: Nearness, payload: str, rows: int, units: int, scratch: Scratch) -> DataFrame:
    """a, b: edges that connect the members of each group just as all near pairs of the group would.

    members: tile (the group, named by one of its members), vertex, n and the payload that nearness reads. A group of at most
    FEW_BLOCKS blocks is compared at once. A larger one is first held against its namesake alone, of which every block gets a copy; if all are near it, that is all,
    and the shuffle is in proportion to the group. Only those that are not (the far ones) are then dealt to tiles with each other, and with
    the near ones, which count as one.
    """
    weight = _weight(rows, units)
    columns = ["tile", "vertex", "n", payload]
    members = members.select(*columns)
    large = scratch.written(members.groupBy("tile").agg(_blocks(F.sum(weight)).alias("blocks")).where(F.col("blocks") > FEW_BLOCKS), "large")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, ["tile", "i", "j"]):
            if tile.num_rows > 1:
                vertex = np.asarray(tile.column("vertex"))
                side = None if tile.column("i")[0] == tile.column("j")[0] else np.asarray(tile.column("block"))
                root = roots(len(vertex), nearness(tile), side)
                moved = root != np.arange(len(vertex))
                yield pa.record_batch([pa.array(vertex[moved]), pa.array(vertex[root[moved]])], ["a", "b"])

    few = members.join(large.select("tile"), "tile", "left_anti")
    edges = tiled(few, "tile", "vertex", rows, units).mapInArrow(whole, "a long, b long")
    if large.isEmpty():
        return edges

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, ["tile", "block"]):
            vertex = np.asarray(block.column("vertex"))
            near = vertex == np.asarray(block.column("tile"))
            if near[0]:
                near[1:] |= nearness(block)(0, np.arange(1, len(vertex)))
            others = pa.array(vertex != np.asarray(block.column("tile")))
            yield pa.record_batch([block.column(k).combine_chunks() for k in ("tile", "vertex", "n")] + [pa.array(near)], ["tile", "vertex", "n", "near"]).filter(others)

    big = members.join(large, "tile")
    block = F.pmod(F.xxhash64("vertex"), F.col("blocks") * PARTS).cast("int")
    dealt = big.where("vertex <> tile").select(*columns, block.alias("block")).union(big.where("vertex = tile").select(*columns, F.explode(F.sequence(F.lit(0), F.col("blocks") * PARTS - 1)).alias("block")))
    dealt = dealt.repartition("tile", "block").sortWithinPartitions("tile", "block", F.col("vertex") != F.col("tile"), "n")
    judged = scratch.written(dealt.mapInArrow(beside, "tile long, vertex long, n long, near boolean"), "judged")
    edges = edges.union(judged.where("near").select(F.col("vertex").alias("a"), F.col("tile").alias("b")))
    count = lambda what: _blocks(F.sum(F.when(what, weight).otherwise(0.0)))
    cut = judged.groupBy("tile").agg(count(~F.col("near")).alias("far_blocks"), count(F.col("near")).alias("near_blocks")).where("far_blocks > 0")
    cut = scratch.written(cut, "cut")
    if cut.isEmpty():
        return edges

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, ["tile", "near_side", "i", "j"]):
            vertex, side = np.asarray(tile.column("vertex")), np.asarray(tile.column("side"))
            near = nearness(tile)
            if tile.column("near_side")[0].as_py():
                rows_near = np.flatnonzero(side == 1)
                hit = np.array([r for r in np.flatnonzero(side == 0) if len(rows_near) and near(int(r), rows_near).any()], np.int64)
                yield pa.record_batch([pa.array(vertex[hit]), tile.column("tile").combine_chunks().take(pa.array(hit))], ["a", "b"])
            elif len(vertex) > 1:
                root = roots(len(vertex), near, None if tile.column("i")[0] == tile.column("j")[0] else side)
                moved = root != np.arange(len(vertex))
                yield pa.record_batch([pa.array(vertex[moved]), pa.array(vertex[root[moved]])], ["a", "b"])

    left = big.select(*columns).join(judged.select("tile", "vertex", "near"), ["tile", "vertex"]).join(cut, "tile")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    own = lambda blocks: F.pmod(F.xxhash64("vertex"), F.col(blocks)).cast("int")
    far, near = left.where("NOT near"), left.where("near AND near_blocks > 0")
    pairs = far.select(*columns, own("far_blocks").alias("own"), every("far_blocks").alias("other"))
    pairs = pairs.select(*columns, F.lit(False).alias("near_side"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    one = far.where("near_blocks > 0").select(*columns, F.lit(True).alias("near_side"), own("far_blocks").alias("i"), every("near_blocks").alias("j"), F.lit(0).alias("side"))
    two = near.select(*columns, F.lit(True).alias("near_side"), every("far_blocks").alias("i"), own("near_blocks").alias("j"), F.lit(1).alias("side"))
    keys = ["tile", "near_side", "i", "j"]
    tiles = pairs.union(one).union(two).repartition(*keys).sortWithinPartitions(*keys, "side", "n")
    return edges.union(tiles.mapInArrow(between, "a long, b long"))


def joined(adjacent: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix, the smallest row of its connected component."""
    return roots(len(adjacent), lambda row, others: adjacent[row, others])
