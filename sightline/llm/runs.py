"""Groups of a sorted partition, one after the other."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def sorted_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of equal (non-null) keys as one record batch each; the input is sorted by them.

    A run that goes on in the next Arrow batch is carried over, so a task holds one run and one
    batch at a time.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch) - 1, bool)
        for k in keys:
            c = batch.column(k)
            change |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.concat_batches(held)
            held = []
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            part = batch.slice(a, b - a)
            yield pa.concat_batches([*held, part]) if held else part
            held = []
        held.append(batch.slice(cuts[-2]))
    if held:
        yield pa.concat_batches(held)
