"""Best-fit packing of token runs by hierarchical residual packing.

Runs are dealt to groups of about ``GROUP`` by hash and packed best-fit,
longest first, within each group.  Bins that are nearly full are final.  The
others become items of the next round, dealt to fewer groups and packed again,
and so on up a tree until one group is left or a round hardly merges anything.
A task holds one group's lengths, never texts or ids.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from math import ceil
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorflow.llm.chargrams import Memo
from sensorflow.session import discard, materialize

GROUP = 4096
NEARLY = 0.998     # fill from which a bin is final
SETTLED = 0.99     # a round that leaves more than this share of the bins is the last
# White space on which str.split and the tokenizer's pattern may differ.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0]")

#: Byte-level vocabularies write the bytes that print as themselves and number the others from 256.
PRINTS = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in PRINTS)}


class WordIds:
    """Ids of whole texts, word by word from a bounded memo.

    The tokenizer drops white space and never joins what it separates, so a
    text's ids are its words' ids in order.  Lower-casing and composition work
    on texts as on words where all characters are Latin-1; any other text, and
    one that may hold a special token's string, goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.memo = Memo(self.word)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, word: str) -> bytes:
        """A word of Latin-1 letters is one piece to the merges, its bytes
        written as letters; a full stop or comma after it is a piece of its own."""
        if word.isalpha():
            piece = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
            return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
        if word[-1] in ".," and word[:-1].isalpha():
            return self.memo[word[:-1]] + self.memo[word[-1]]
        return self.whole(word)

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.whole(text)
        if "<|" in text or ODD_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.memo.__getitem__, text.lower().split()))


def token_pieces(df: DataFrame, path: str, limit: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``row, id, piece, start, length, ids_crc32`` and, if
    asked for, ``ids`` (packed little-endian).

    A document is its token ids and ``end_id`` (NULL text: empty, so one id).
    Only documents longer than ``limit`` are cut.  ``row`` numbers input rows.
    """
    @F.pandas_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long,ids:binary>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words, end = WordIds(path), end_id.to_bytes(4, "little")
        for texts in batches:
            out = []
            for text in texts:
                ids = (words.packed(text) if text else b"") + end
                cuts = [ids[i: i + 4 * limit] for i in range(0, len(ids), 4 * limit)]
                out.append([(k, k * limit, len(c) // 4, crc32(c), c if keep_ids else None)
                            for k, c in enumerate(cuts)])
            yield pd.Series(out)

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                     F.explode(run(F.col(text_col))).alias("p"))
    return rows.select("row", "id", "p.*") if keep_ids else rows.select("row", "id", "p.*").drop("ids")


def best_fit(lengths: list[int], limit: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, taken in the order given, and the bins'
    fills.  An item goes to the fullest bin that still has room."""
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    bins, offsets, fills = [], [], []
    for length in lengths:
        at = bisect_left(room, (length, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = limit, len(fills)
            fills.append(0)
        bins.append(b)
        offsets.append(fills[b])
        fills[b] += length
        if free > length:
            insort(room, (free - length, b))
    return bins, offsets, fills


def _round(items: DataFrame, level: int, count: int, limit: int) -> DataFrame:
    """``item, bin, at, fill`` for items ``item, length``."""
    groups = max(1, ceil(count / GROUP))

    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "item"], ascending=[False, True], kind="stable")
        bins, offsets, fills = best_fit(block["length"].tolist(), limit)
        first = (level << 56) + (int(key[0]) << 20)
        return pd.DataFrame({"item": block["item"].to_numpy(), "bin": [first + b for b in bins],
                             "at": offsets, "fill": [fills[b] for b in bins]})

    dealt = items.withColumn("g", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(groups)))
    return dealt.groupBy("g").applyInPandas(run, "item long, bin long, at long, fill long")


def pack(items: DataFrame, limit: int = 4096) -> DataFrame:
    """``item, sequence_id, offset`` for items ``item`` (unique long) and
    ``length`` (1 to ``limit``).  Sequences hold at most ``limit`` and have no
    gaps.  An empty table gives an empty result."""
    placed = materialize(_round(items, 0, items.count(), limit), "packed")
    moves, rounds, level = None, [], 0
    bins = materialize(placed.groupBy("bin").agg(F.first("fill").alias("fill")), "bins")
    while True:
        rest = bins.filter(F.col("fill") < NEARLY * limit).select(F.col("bin").alias("item"), F.col("fill").alias("length"))
        count = rest.count()
        if count < 2:
            break
        level += 1
        step = materialize(_round(rest, level, count, limit), "packed")
        discard(bins)
        bins = materialize(step.groupBy("bin").agg(F.first("fill").alias("fill")), "bins")
        rounds.append(step)
        step = step.select("item", F.col("bin").alias("to"), F.col("at").alias("by"))
        if moves is None:
            moves = step
        else:  # follow earlier moves one round on
            next_ = step.select(F.col("item").alias("to"), F.col("to").alias("to2"), F.col("by").alias("by2"))
            moves = moves.join(next_, "to", "left").select(
                "item", F.coalesce("to2", "to").alias("to"), (F.col("by") + F.coalesce("by2", F.lit(0))).alias("by"))
        if count <= GROUP or bins.count() > SETTLED * count:
            break
    if moves is None:
        return placed.select("item", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    moves = moves.withColumnRenamed("item", "bin")
    out = materialize(placed.join(moves, "bin", "left").select(
        "item", F.coalesce("to", "bin").alias("sequence_id"),
        (F.col("at") + F.coalesce("by", F.lit(0))).alias("offset")), "packed")
    discard(placed, bins, *rounds)
    return out


def pack_documents(df: DataFrame, path: str, limit: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = token_pieces(df, path, limit, end_id, id_col, text_col)
    pieces = materialize(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = pack(pieces.select("item", "length"), limit)
    return pieces.join(placed, "item").select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
