"""Neighbourhood operators on tiles with halos: rasters are cut into squares, and pixels near a square's border go to its neighbours as well.

One shuffle deals pixels to tiles; a task then holds a tile as arrays, whatever the size of the image, and computes kernels of several
passes at once, as the halo is as wide as all passes together reach. What lies outside the image is told apart from what lies outside the
tile: a halo that is empty is the image's border.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopyspark.operators.groups import run_starts, whole_groups

#: Pixels a side, without the halo.
SIDE = 256

#: Makes, of a tile's arrays by column and of the mask of pixels that exist, the arrays of new columns; all with the halo around.
Kernel = Callable[[Mapping[str, np.ndarray], np.ndarray], Mapping[str, np.ndarray]]


def with_halos(pixels: DataFrame, halo: int, side: int = SIDE) -> DataFrame:
    """pixels with their tile (__tx, __ty), and copies of those that lie within halo of another tile, for that tile; dealt by tile and
    sorted by row within it. halo is at most side."""
    near = lambda c: F.array_distinct(F.transform(F.array(F.lit(-halo), F.lit(0), F.lit(halo)), lambda d: F.floor((F.col(c) + d) / side).cast("int")))
    dealt = pixels.withColumn("__tx", F.explode(near("x"))).withColumn("__ty", F.explode(near("y"))).where("__tx >= 0 AND __ty >= 0")
    keys = ["image_key", "__ty", "__tx"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "y", "x")


def by_tiles(pixels: DataFrame, reads: Sequence[str], halo: int, kernel: Kernel, writes: Mapping[str, str], side: int = SIDE) -> DataFrame:
    """pixels with the columns that kernel makes of the columns it reads; writes gives their types. Other columns are carried along, and
    columns of the same name are replaced. A null that is read counts as a pixel that doesn't exist."""
    kept = [c for c in pixels.columns if c not in writes]
    # what is read and replaced comes along under another name
    moved = pixels.select(*kept, *(F.col(c).alias(f"__in_{c}") for c in reads if c in writes))
    source = {c: f"__in_{c}" if c in writes else c for c in reads}
    dealt = with_halos(moved, halo, side)
    kinds = {"double": pa.float64(), "int": pa.int32(), "bigint": pa.int64(), "long": pa.int64(), "boolean": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["image_key", "__ty", "__tx"]):
            starts = run_starts(rows, ["image_key", "__ty", "__tx"])
            x, y, tx, ty = (rows.column(rows.schema.get_field_index(c)).to_numpy() for c in ("x", "y", "__tx", "__ty"))
            values = {c: rows.column(rows.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for c, name in source.items()}
            own = (x // side == tx) & (y // side == ty)
            out = {c: np.zeros(len(x), kinds[kind].to_pandas_dtype()) for c, kind in writes.items()}
            for a, z in zip(starts, [*starts[1:], len(x)], strict=True):
                if not own[a:z].any():
                    continue
                x0, y0 = x[a:z].min(), y[a:z].min()
                at = y[a:z] - y0, x[a:z] - x0
                there = np.zeros((int(at[0].max()) + 1, int(at[1].max()) + 1), bool)
                there[at] = True
                arrays = {}
                for c, v in values.items():
                    part = v[a:z]
                    if part.dtype == object:
                        there[at] &= np.array([p is not None for p in part])
                        part = np.array([p or False for p in part])
                    arrays[c] = np.zeros(there.shape, part.dtype)
                    arrays[c][at] = part
                for c, array in kernel(arrays, there).items():
                    out[c][a:z] = array[at]
            columns = [rows.column(rows.schema.get_field_index(c)) for c in kept] + [pa.array(out[c], kinds[kind]) for c, kind in writes.items()]
            yield pa.record_batch(columns, [*kept, *writes]).filter(pa.array(own))

    types = dict(pixels.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + "".join(f", `{c}` {kind}" for c, kind in writes.items())
    return dealt.mapInArrow(run, schema).select(*(c for c in pixels.columns), *(c for c in writes if c not in pixels.columns))


def mirrored(array: np.ndarray, halo: int) -> np.ndarray:
    """The array with mirrored borders, the border itself not repeated, however small it is. At a border within the image this adds what
    nothing reads but the halo itself."""
    for axis in (0, 1):
        size = array.shape[axis]
        period = max(1, 2 * (size - 1))
        place = np.abs(np.arange(-halo, size + halo)) % period
        array = np.take(array, np.where(place >= size, period - place, place), axis)
    return array


def separable(array: np.ndarray, kernel: Sequence[float]) -> np.ndarray:
    """A separable kernel over rows, then over columns, mirrored at borders; taps are added in their order."""
    half = len(kernel) // 2
    wide = mirrored(array.astype(float), half)
    h, w = array.shape
    rows = np.zeros((h + 2 * half, w))
    for k, weight in enumerate(kernel):
        rows = rows + wide[:, k : k + w] * weight
    out = np.zeros((h, w))
    for k, weight in enumerate(kernel):
        out = out + rows[k : k + h] * weight
    return out


def swept(mask: np.ndarray, there: np.ndarray, halves: Sequence[int], grow: bool) -> np.ndarray:
    """Dilation (or erosion) by a structuring element whose rows have these half widths; pixels that don't exist don't count."""
    reach = len(halves) // 2
    outside = not grow
    known = np.where(there, mask, outside)
    wide = np.pad(known, ((reach, reach), (max(halves), max(halves))), constant_values=outside)
    h, w = mask.shape
    fold, start, out = (np.logical_or, False, None) if grow else (np.logical_and, True, None)
    lines = {}
    for half in sorted(set(halves)):
        line = np.full((h + 2 * reach, w), start)
        for k in range(max(halves) - half, max(halves) + half + 1):
            line = fold(line, wide[:, k : k + w])
        lines[half] = line
    for k, half in enumerate(halves):
        row = lines[half][k : k + h]
        out = row if out is None else fold(out, row)
    return out
