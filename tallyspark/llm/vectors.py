"""Embeddings as vectors of integers: scaled, floored, and packed into canonical bytes.

Equal vectors have equal bytes and the other way round, so bytes serve as a
grouping key.  The first byte is the width of an entry (1, 2, 4 or 8 bytes, the
least that fits), the entries follow in little-endian order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from .common import map_rows

#: Below this size after scaling, sums of 2**15 products of entries fit 64 bits; vectors with an entry beyond are left out.
LIMIT = 1 << 24


def integers(column: pa.Array, scale: int, limit: int = LIMIT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, int64 matrix of ``floor(scale * entry)``) for each vector length in the column.

    Rows that are null, or hold a null, a non-finite entry or one beyond ``limit``, are left out.
    """
    if isinstance(column, pa.FixedSizeListArray):
        column = column.cast(pa.list_(column.type.value_type))
    if not len(column):
        return
    starts = column.offsets.to_numpy()
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(starts), -1)
    flat = column.values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes >= 0]):
        rows = np.flatnonzero(sizes == size)
        x = np.floor(flat[starts[rows][:, None] + np.arange(size)] * float(scale))
        good = (np.abs(x) < limit).all(axis=1)          # false for NaN and infinities too
        if good.any():
            yield rows[good], x[good].astype(np.int64)


def pack(x: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(row numbers, bytes) of an integer matrix, for each entry width it needs."""
    top = np.maximum(x.max(axis=1, initial=0), -1 - x.min(axis=1, initial=0))
    widths = np.select([top < 1 << 7, top < 1 << 15, top < 1 << 31], [1, 2, 4], 8)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        body = np.ascontiguousarray(x[rows].astype(f"<i{width}")).view(np.uint8).reshape(len(rows), -1)
        data = np.concatenate([np.full((len(rows), 1), width, np.uint8), body], axis=1)
        ends = np.arange(len(rows) + 1, dtype=np.int32) * data.shape[1]
        yield rows, pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def unpack(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, int64 matrix) for each length and entry width in a column of packed vectors."""
    if not len(column):
        return
    column = column.cast(pa.large_binary())
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    sizes, widths = np.diff(starts), data[starts[:-1]]
    kinds = sizes * 16 + widths
    for kind in np.unique(kinds):
        rows = np.flatnonzero(kinds == kind)
        size, width = int(kind) // 16, int(kind) % 16
        body = np.ascontiguousarray(data[starts[rows][:, None] + np.arange(1, size)])
        yield rows, body.view(f"<i{width}").reshape(len(rows), (size - 1) // width).astype(np.int64)


def padded(column: pa.Array, width: int | None = None) -> np.ndarray:
    """All packed vectors of a column as one int64 matrix; absent entries are 0."""
    parts = list(unpack(column))
    out = np.zeros((len(column), max([x.shape[1] for _, x in parts] + [width or 0])), np.int64)
    for rows, x in parts:
        out[rows, :x.shape[1]] = x
    return out


def packed_vectors(df: DataFrame, scale: int, vector: Column, *ids: Column, limit: int = LIMIT) -> DataFrame:
    """``ids`` and ``x binary`` for every row whose vector has an integer form."""
    df = df.select(*ids, vector.alias("x"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields[:-1]]
    schema = ", ".join([*fields, "x binary"])

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for rows, x in integers(batch.column("x"), scale, limit):
                for some, data in pack(x):
                    at = pa.array(rows[some])
                    yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns[:-1]], data], batch.schema.names)
        return step

    return map_rows(df, schema, make, slice_rows=4096)
