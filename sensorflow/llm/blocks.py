"""Texts scored from a table of n-grams that no task holds as a whole.

Rows are dealt into blocks of some ``BLOCK_BYTES`` of text by a hash of their
columns.  Of each block the distinct keys its words look up are joined with
the table, and what is found meets the block's texts again.  A key comes once
a block, so a letter sequence of every word is still spread over the tasks,
and a task holds the entries of one block, however long the table grows.

Texts are shuffled once, as pieces: a task's rows of one block, compressed
together.  A task sorts its rows by block first, so its pieces are as long as
its input and the number of blocks allow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType

from sensorflow.llm.chargrams import LETTERS
from sensorflow.session import bound_batches

BLOCK_BYTES = 16 << 20
PIECE_BYTES = 4 << 20  # a piece that has reached this ends


def score_blocks(df: DataFrame, table: DataFrame, text_col: str, out_col: str, out_type: DataType,
                 keys: Callable, scorer: Callable) -> DataFrame:
    """``df`` with ``out_col`` added or replaced, from ``table`` (``key string,
    value array<float>``).  ``keys`` gives the keys of a set of letter
    runs; ``scorer`` takes the keys found and their values, one row each, and gives
    the function from a block's texts to their results.

    ``df`` must give the same rows when read again, in any order.  Rows equal
    in every column share a block."""
    bound_batches(df.sparkSession)
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    block = F.pmod(F.xxhash64(*hashed), F.lit(1 + size // BLOCK_BYTES)).cast("int")
    kept = [F.col(f"`{c}`") for c in df.columns if c != out_col or c == text_col]
    rows = df.select(F.struct(*kept).alias("r"), block.alias("block"))
    row_type = rows.schema["r"].dataType
    texts = rows.sortWithinPartitions("block").mapInArrow(_pieces, "block int, piece binary")
    arrow_type = to_arrow_type(out_type)

    def needed(pieces: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what earlier blocks have left
        words: set = set()
        for text in _texts(_rows(pieces), text_col):
            if text:
                words.update(text.lower().split())
        found = list(keys(set(LETTERS.findall(" ".join(words)))))
        number = pieces["block"][0].as_py()
        return pa.table([pa.array([number] * len(found), pa.int32()), pa.array(found, pa.string())],
                        names=["block", "key"])

    def score(pieces: pa.Table, entries: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        rows = _rows(pieces)
        names = entries["key"].to_pylist()
        values = entries["value"].combine_chunks()
        values = np.asarray(values.flatten(), np.float32).reshape(len(names), -1 if names else 0)
        out = scorer(names, values)(_texts(rows, text_col))
        return pa.table([rows, pa.array(out, arrow_type)], names=["r", "out"])

    pairs = texts.groupBy("block").applyInArrow(needed, "block int, key string")
    # keys and table grow with the texts: one plan at every size
    found = pairs.join(table.hint("merge"), "key").select("block", "key", "value")
    schema = StructType([StructField("r", row_type), StructField("out", out_type)])
    scored = texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, schema)
    return scored.select(*[F.col(f"r.`{c}`") for c in df.columns if c != out_col], F.col("out").alias(out_col))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, piece`` of rows ``r, block`` that come sorted by block."""
    held, size, block = [], 0, None

    def piece() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema) as out:
            for part in held:
                out.write_batch(part)
        data = zstandard.ZstdCompressor(level=1).compress(sink.getvalue())
        held.clear()
        return pa.record_batch([pa.array([block], pa.int32()), pa.array([data], pa.binary())], ["block", "piece"])

    for batch in batches:
        numbers = batch["block"].to_numpy()
        edges = [*(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for lo, hi in zip([0, *edges], edges):
            if lo == hi:
                continue
            if held and (numbers[lo] != block or size >= PIECE_BYTES):
                yield piece()
                size = 0
            part, block = batch.slice(lo, hi - lo).select(["r"]), numbers[lo]
            held.append(part)
            size += part.nbytes
    if held:
        yield piece()
    pa.default_memory_pool().release_unused()


def _rows(pieces: pa.Table) -> pa.ChunkedArray:
    """The rows of all pieces of a block."""
    tables = [pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()
              for data in pieces["piece"].to_pylist()]
    return pa.concat_tables(tables)["r"]


def _texts(rows: pa.ChunkedArray, text_col: str) -> list:
    return [t for chunk in rows.chunks for t in chunk.field(text_col).to_pylist()]


def _has_map(kind: DataType) -> bool:
    return "map<" in kind.simpleString()
