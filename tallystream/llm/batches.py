"""Arrow batches in parts of bounded size, and list columns as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes worked on at a time. A single longer text is worked on alone.
PART_BYTES = 1 << 20


def parts(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PART_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices whose ``column`` has about ``size`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def structs(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and fields of a list of structs without nulls inside; a null list is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column)
    fields = {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), fields
