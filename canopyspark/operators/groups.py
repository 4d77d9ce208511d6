"""Arrow batches of sorted rows, put together so that no group is cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def run_starts(rows: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where runs of rows with equal keys begin."""
    new = np.ones(rows.num_rows, bool)
    if rows.num_rows:
        new[1:] = False
        for key in keys:
            column = rows.column(rows.schema.get_field_index(key))
            new[1:] |= ~np.asarray(pc.equal(column[1:], column[:-1]).fill_null(False))
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, cut between groups only: the last group of a batch waits for the next one. One group is the most that is
    held beside a batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held:
            border = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)]).combine_chunks().to_batches()[0]
            if len(run_starts(border, keys)) > 1:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        last = int(run_starts(batch, keys)[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
