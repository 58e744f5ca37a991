"""Arrow list columns to NumPy matrices and back, without a Python loop over rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vecloom.errors import VectorError


def texts_of(column: pa.Array, function: str) -> pa.Array:
    """The argument of a text function: a string column, or the untyped NULL literal.

    Spark strings may hold invalid UTF-8; such bytes become U+FFFD.
    """
    if pa.types.is_null(column.type):
        return column.cast(pa.string())
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        raise TypeError(f"{function} expects STRING, got {column.type}")
    try:
        column.validate(full=True)
    except pa.ArrowInvalid:
        raw = column.cast(pa.binary()).to_pylist()
        column = pa.array([None if b is None else b.decode("utf-8", "replace") for b in raw], type=pa.string())
    return column


def text_slices(texts: pa.Array, max_bytes: int, max_rows: int | None = None) -> Iterator[pa.Array]:
    """`texts` in consecutive slices of at most `max_bytes` and `max_rows`; a longer text is a slice by itself.

    What is made of texts can be many times their size, so it is made a slice at a time.
    """
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
    at = before = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        if max_rows is not None:
            end = min(end, at + max_rows)
        yield texts.slice(at, end - at)
        at, before = end, int(ends[end - 1])


def matrix_of(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows x width matrix of the non-NULL vectors, their row positions).

    Single-precision columns stay so, as a view where Arrow's memory allows; others become float64.
    """
    rows = np.flatnonzero(np.asarray(pc.is_valid(column)))
    present = column.drop_null()
    if len(present) == 0:
        return np.empty((0, width or 0)), rows
    lengths = np.asarray(pc.list_value_length(present))
    expected = int(lengths[0]) if width is None else width
    if (lengths != expected).any():
        wrong = int(lengths[lengths != expected][0])
        raise VectorError(f"vector has width {wrong}, expected {expected}")
    flat = present.flatten()
    if flat.null_count:
        raise VectorError("a vector has a NULL element")
    if not pa.types.is_float32(flat.type):
        flat = flat.cast(pa.float64())
    return flat.to_numpy().reshape(-1, expected), rows


def numbers_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all elements in a row as float64, width of each vector) of vectors without NULLs, of any widths."""
    flat = column.flatten()
    if flat.null_count:
        raise VectorError("a vector has a NULL element")
    return np.asarray(flat.cast(pa.float64())), np.asarray(pc.list_value_length(column)).astype(np.int64)


def row_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `sizes` values; an empty run sums to 0."""
    out = np.zeros(len(sizes))
    filled = sizes > 0
    if filled.any():
        out[filled] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[filled])
    return out


def lists_of(matrix: np.ndarray, rows: np.ndarray, n_rows: int) -> pa.Array:
    """The rows of `matrix` at positions `rows` of a list column of `n_rows`; NULL elsewhere."""
    width = matrix.shape[1] if matrix.ndim == 2 else 0
    lengths = np.zeros(n_rows, dtype=np.int64)
    lengths[rows] = width
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    values = pa.array(np.ascontiguousarray(matrix).reshape(-1))
    present = np.zeros(n_rows, dtype=bool)
    present[rows] = True
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(~present))
