"""Arrow batches in portions that a worker can hold as Python objects."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in a portion, in about.
PORTION_BYTES = 1 << 20


def portions(rows: Iterator[pa.RecordBatch], column: int, size: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, in order, cut so that a portion's values of one text column come to size bytes or one row."""
    for batch in rows:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop
