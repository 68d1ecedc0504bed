"""Vectors of Arrow batches as numpy matrices, shared by operators 12 and 13."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, rows as doubles) of a list column, one pair per vector length.

    A vector that is null or empty, or that holds a null or non-finite component, is in none."""
    if not len(column):
        return
    ends = column.offsets.to_numpy().astype(np.int64)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    sizes = ends[1:] - ends[:-1]
    valid = column.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
    fine = valid & (bad[ends[1:]] == bad[ends[:-1]])
    for size in np.unique(sizes[fine]).tolist():
        rows = np.flatnonzero(fine & (sizes == size))
        yield rows, values[ends[rows][:, None] + np.arange(size)]
