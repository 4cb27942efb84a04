"""Reduction of Arrow batches to one row per key before a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def key_codes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """A number per row, equal for equal keys (null equals null)."""
    codes = np.zeros(batch.num_rows, np.int64)
    for key in keys:
        coded = batch.column(key).dictionary_encode()
        own = coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
        codes = np.unique(codes * (len(coded.dictionary) + 1) + own, return_inverse=True)[1]
    return codes


def newest_rows(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every code, in ascending order, the place of a row with the largest ``at``."""
    order = np.lexsort((at, codes))
    last = np.flatnonzero(np.diff(codes[order], append=-1))
    return order[last]
