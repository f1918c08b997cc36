"""Embedding vectors as whole numbers, in as few bytes as each needs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

STEPS = 64  # a component x becomes floor(64 * x)
_WIDTHS = (1, 2, 4, 8)


def coded(vectors: DataFrame, vector_col: str, carried: list[str] | None, limit: float) -> DataFrame:
    """``row`` (the input row, or its ``carried`` columns), ``dim`` and ``code`` of every usable vector.

    Left out are null and empty vectors and those with a null or non-finite component. A
    component counts as non-finite too if ``64 * x`` is not below ``limit`` in size, as
    what is computed from it then fits no long. Equal vectors have equal codes.
    """
    rows = vectors.select(F.struct(*[vectors[f"`{c}`"] for c in carried or vectors.columns]).alias("row"),
                          F.col(f"`{vector_col}`").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, lists = batch.column("row"), batch.column("vector")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = np.floor(STEPS * pc.fill_null(lists.flatten().cast(pa.float64()), np.nan).to_numpy(
                zero_copy_only=False))
            starts = np.concatenate([[0], np.cumsum(sizes)])
            bad = np.concatenate([[0], np.cumsum(~(np.abs(values) < limit))])
            good = (sizes > 0) & (bad[starts[1:]] == bad[starts[:-1]])
            for dim in np.unique(sizes[good]):
                at = np.flatnonzero(good & (sizes == dim))
                x = values[starts[at, None] + np.arange(dim)].astype(np.int64)
                widths = np.select([np.maximum(x.max(1), -1 - x.min(1)) < 1 << (8 * w - 1) for w in _WIDTHS], _WIDTHS)
                for width in np.unique(widths):
                    these = widths == width
                    yield pa.RecordBatch.from_arrays(
                        [row.take(pa.array(at[these])), pa.array(np.full(these.sum(), dim, np.int32)),
                         encoded(x[these], width)], names=["row", "dim", "code"])
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, dim int, code binary")


def encoded(x: np.ndarray, width: int) -> pa.Array:
    """Rows of whole numbers as binaries: the width in bytes, then the numbers."""
    body = np.ascontiguousarray(x.astype(f"<i{width}")).view(np.uint8).reshape(len(x), -1)
    data = np.concatenate([np.full((len(x), 1), width, np.uint8), body], 1)
    offsets = np.arange(len(x) + 1, dtype=np.int32) * data.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def decoded(codes: pa.Array, dim: int) -> np.ndarray:
    """The numbers of binaries of one dimension."""
    ends = np.frombuffer(codes.buffers()[1], np.int32)[codes.offset:codes.offset + len(codes) + 1].astype(np.int64)
    data = np.frombuffer(codes.buffers()[2] or b"", np.uint8)
    out = np.empty((len(codes), dim), np.int64)
    widths = data[ends[:-1]]
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        body = data[ends[at, None] + 1 + np.arange(dim * int(width))]
        out[at] = body.view(f"<i{width}").reshape(len(at), dim)
    return out


def by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of a batch with ``dim`` and ``code``: each dimension, its rows' places and their numbers."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, decoded(batch.column("code").take(pa.array(at)), int(dim))
