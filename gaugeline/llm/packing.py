"""Packing of documents into token windows by the online sum-of-squares rule.

A document's ids and an end id are cut into whole windows, each a sequence of its
own, and a remainder. A remainder goes to the fill level where the sum of the squared
numbers of partly filled windows grows least; an array of those numbers by level is
all the rule needs. Ties go to the fullest window.

Every input partition is packed on its own, so nothing is shuffled. When more than
``max_open`` windows are open, and at the end of a partition, the open ones are
closed by cutting their pieces at window boundaries, which leaves at most one partly
filled window. That bounds a task's memory and the padding: at most one padded window
a partition.

Edge cases: a null or empty text is a document of its end id alone; repeated rows are
documents of their own; a null id is carried along; other columns are left out,
whatever their names; no rows give no rows. Ids of sequences are unique, not gapless.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .tokens import encoder, runs

WINDOW, MAX_OPEN, END = 1024, 1024, 0
#: Texts encoded together, in bytes.
RUN_BYTES = 4_000_000

_COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Packer:
    """The windows of one partition. A piece is (document, start in it, ids, its size)."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.n_open = self.sequences = 0

    def add(self, document, ids: np.ndarray):
        """Yields closed sequences as (number, pieces)."""
        size = len(ids)
        whole = size - size % self.window
        for start in range(0, whole, self.window):
            yield self._closed([(document, start, ids[start:start + self.window], size)])
        if whole < size:
            yield from self._place((document, whole, ids[whole:], size))

    def _place(self, piece):
        size = len(piece[2])
        level = self._level(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if level + size == self.window:
            yield self._closed(pieces)
            return
        self._keep(level + size, pieces)
        if self.n_open > self.max_open:
            yield from self.flush(last=False)

    def _level(self, size: int) -> int:
        """The fill level that a remainder joins; 0 is a new window."""
        room = self.window - size + 1
        filled = self.levels[size:size + room]
        growth = 2 * filled + 1
        growth[-1] = 0  # the window is full and no longer counts
        taken = self.levels[:room]
        growth = growth - np.where(taken > 0, 2 * taken - 1, 0)
        usable = taken > 0
        usable[0] = True
        if size == self.window:
            return 0
        growth = np.where(usable, growth, np.iinfo(np.int64).max)
        return int(room - 1 - np.argmin(growth[::-1]))

    def _keep(self, level: int, pieces: list) -> None:
        self.open[level].append(pieces)
        self.levels[level] += 1
        self.n_open += 1

    def _closed(self, pieces: list):
        self.sequences += 1
        return self.sequences - 1, pieces

    def flush(self, last: bool = True):
        """Closes the open windows, cutting their pieces where a window ends."""
        pieces = [piece for windows in self.open for window in windows for piece in window]
        self.open = [[] for _ in range(self.window)]
        self.levels[:] = 0
        self.n_open = 0
        filling, fill = [], 0
        for document, start, ids, size in pieces:
            while len(ids):
                part = ids[:self.window - fill]
                filling.append((document, start, part, size))
                start, ids, fill = start + len(part), ids[len(part):], fill + len(part)
                if fill == self.window:
                    yield self._closed(filling)
                    filling, fill = [], 0
        if filling and last:
            yield self._closed(filling)
        elif filling:
            self._keep(fill, filling)


def packed(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           window: int = WINDOW, end: int = END, max_open: int = MAX_OPEN,
           with_ids: bool = True) -> DataFrame:
    """One row per piece: the document's id, its place in the document and in its
    sequence, a checksum, and with ``with_ids`` the ids."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in _COLUMNS)
    schema += ", ids array<int>" if with_ids else ""

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        packer, pieces_of = Packer(window, max_open), encoder(tokenizer)

        def rows_of(closed):
            for number, pieces in closed:
                offset = 0
                for document, start, ids, size in pieces:
                    yield (document, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False)), size,
                           base + number, offset, ids)
                    offset += len(ids)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            names = batch.column("doc_id").to_pylist()
            for start, stop in runs(batch.column("text"), RUN_BYTES):
                ids, ends = with_end(*pieces_of.encode(batch.column("text").slice(start, stop - start)), end)
                out = []
                for document, low, high in zip(names[start:stop], ends, ends[1:]):
                    out.extend(rows_of(packer.add(document, ids[low:high])))
                yield _batch(out, kind, with_ids)
        if packer.n_open:
            yield _batch(list(rows_of(packer.flush())), kind, with_ids)
    return rows.mapInArrow(run, schema)


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, list[int]]:
    """The ids with the end id behind each document, and the places where documents begin."""
    ends = np.cumsum(lengths)
    return np.insert(ids, ends, ids.dtype.type(end)), [0, *(ends + np.arange(1, len(ends) + 1)).tolist()]


def _batch(rows: list[tuple], kind: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 8
    arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7])]
    if with_ids:
        sizes = np.concatenate([[0], np.cumsum([len(i) for i in columns[7]], dtype=np.int64)])
        flat = np.concatenate(columns[7]).astype(np.int32) if rows else np.zeros(0, np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat)))
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *_COLUMNS] + ["ids"] * with_ids)
