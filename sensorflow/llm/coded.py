"""Blocks of documents written once as numbers, with a dictionary each.

A task that reads texts packs what later steps need of some megabytes of them
into one row.  Keys that the whole corpus is asked about (words, id pairs) are
numbered within the block; its dictionary is joined with a table of all keys,
and what is found goes back to the block by its number.  Later passes read the
rows, not the texts, and no task holds more than one block's keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def in_blocks(batches: Iterator[pa.RecordBatch], size: int, text_col: str, make: Callable[[int, dict], pa.RecordBatch]
              ) -> Iterator[pa.RecordBatch]:
    """``make(block, columns)`` for runs of rows that hold some ``size`` bytes of
    text; columns are lists, texts as UTF-8 bytes or None.  A block has one
    number wherever it is read: it is stored with the row."""
    first, count, held, rows = TaskContext.get().partitionId() << 32, 0, 0, None
    for batch in batches:
        at, end = 0, batch.num_rows
        index = batch.schema.get_field_index(text_col)
        texts = batch.column(index).cast(pa.binary()) if not pa.types.is_binary(batch.schema.types[index]) else batch.column(index)
        lengths = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + end + 1]
        while at < end:
            stop = int(np.searchsorted(lengths, lengths[at] + size - held, side="left"))
            stop = min(max(stop, at + 1), end)
            part = {c: (texts if i == index else batch.column(i)).slice(at, stop - at).to_pylist()
                    for i, c in enumerate(batch.schema.names)}
            rows = part if rows is None else {c: rows[c] + part[c] for c in part}
            held += int(lengths[stop] - lengths[at])
            at = stop
            if held >= size:
                yield make(first + count, rows)
                count, held, rows = count + 1, 0, None
    if rows is not None:
        yield make(first + count, rows)
