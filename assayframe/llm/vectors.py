"""Vectors of an Arrow list column as one matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows, values): the rows with a vector of finite components only, in double precision.

    Vectors of unlike length are filled up with zeros, which changes neither inner products
    nor norms. Null and empty vectors, and those with null or non-finite components, are out.
    """
    size = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False),
                      np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(size)), size)
    bad = np.zeros(len(size), bool)
    bad[row[~np.isfinite(values)]] = True
    good = np.flatnonzero(~bad & (size > 0))
    width = int(size.max(initial=0))
    out = np.zeros((len(size), width))
    at = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = np.where(np.isfinite(values), values, 0.0)
    return good, out[good]
