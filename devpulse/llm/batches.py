"""Arrow batches in slices of bounded text size, so that a task's memory follows the slice, not the batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000


def slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of a text or binary column (a longer value comes alone)."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(size):
            base = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
