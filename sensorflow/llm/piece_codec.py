"""Encoding and decoding with a merge-type piece vocabulary by a prefix table.

A prefix of a merge-encoded string has one last token.  Walking through the
string, an automaton lists the pieces that end at each position; the one whose
junction with the last token of what lies before it survives merging (*pair
compatibility*) is stored.  Ids are read off the table backwards, in time
linear in the length.

Two facts about the vocabulary, tested when it is loaded, cut texts into short
segments whose ids are kept in a bounded memo: no piece has a space mark after
another character, and no piece holds a line feed.  Pieces of equal score would
break the uniqueness of the last token; here they are runs of space marks, and
segments with such a run are merged by a priority queue instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.chargrams import Memo

MARK = "▁"
PAIRS = 400_000


class PieceCodec:
    """Encoder and decoder of one vocabulary file (merge type, byte fallback,
    no normalisation, one space mark before the text)."""

    def __init__(self, path: str):
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bos, self.eos = lib.bos_id(), lib.eos_id()
        self.scores, self.ids, self.byte_ids = {}, {}, {}
        self.bytes_of: list[bytes] = []
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_control(i) or lib.is_unknown(i):
                self.bytes_of.append(b"" if lib.is_control(i) else " ⁇ ".encode())
            elif lib.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            else:
                self.scores[piece], self.ids[piece] = lib.get_score(i), i
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        seen: dict = {}
        for piece, score in self.scores.items():
            seen.setdefault(score, []).append(piece)
        self.tied = {p for same in seen.values() if len(same) > 1 for p in same}
        tied = "".join(sorted({c for p in self.tied for c in p}))
        if tied.strip(MARK) or any(MARK in p.lstrip(MARK) for p in self.scores) or any("\n" in p for p in self.scores):
            raise ValueError("vocabulary joins pieces across spaces or lines, or has other equal scores")
        self.automaton = ahocorasick.Automaton()
        for piece in self.scores:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.whole = Memo(lambda p: self.merge(p) == [p], PAIRS)
        self.fit = Memo(lambda pair: self.merge(pair[0] + pair[1]) == list(pair), PAIRS)
        self.plain = Memo(self.segment)
        self.spaced = Memo(lambda w: self.segment(MARK + w))
        self.line_feed = self.pack(["\n"])
        self.cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def merge(self, text: str) -> list[str]:
        """Pieces by definition: the best-scored neighbours join first, of
        equal ones the leftmost."""
        part, size = list(text), len(text)
        left, right = list(range(-1, size - 1)), list(range(1, size + 1))
        heap = [(-self.scores[ab], i, ab) for i, ab in enumerate(map("".join, zip(part, part[1:]))) if ab in self.scores]
        heapify(heap)
        while heap:
            _, i, ab = heappop(heap)
            j = right[i] if part[i] is not None else size
            if j >= size or part[i] + part[j] != ab:
                continue
            part[i], part[j] = ab, None
            right[i] = right[j]
            if right[i] < size:
                left[right[i]] = i
                ab = part[i] + part[right[i]]
                if ab in self.scores:
                    heappush(heap, (-self.scores[ab], i, ab))
            if left[i] >= 0:
                ab = part[left[i]] + part[i]
                if ab in self.scores:
                    heappush(heap, (-self.scores[ab], left[i], ab))
        return [p for p in part if p is not None]

    def table(self, text: str) -> list[str]:
        """The last piece of every prefix."""
        last, fit, whole = [""] * (len(text) + 1), self.fit, self.whole
        for end, piece in self.automaton.iter(text):  # longer pieces first at each end
            if last[end + 1]:
                continue
            self._fill(last, text, end)
            before = last[end + 1 - len(piece)]
            if fit[before, piece] if before else whole[piece]:
                last[end + 1] = piece
        self._fill(last, text, len(text))
        return last

    @staticmethod
    def _fill(last: list[str], text: str, end: int) -> None:
        """A position where no piece fits has the bare character as last."""
        while end and not last[end]:
            last[end] = text[end - 1]
            end -= 1

    def segment(self, text: str) -> bytes:
        if MARK + MARK in text:
            return self.pack(self.merge(text))
        last, at, pieces = self.table(text), len(text), []
        while at:
            pieces.append(last[at])
            at -= len(last[at])
        return self.pack(pieces[::-1])

    def pack(self, pieces: list[str]) -> bytes:
        ids = chain.from_iterable((self.ids[p],) if p in self.ids else (self.byte_ids[b] for b in p.encode())
                                  for p in pieces)
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def encode(self, text: str) -> bytes:
        """Ids of the text with begin and end, little-endian unsigned 32-bit."""
        out = [self.bos.to_bytes(4, "little")]
        for k, line in enumerate(text.replace(" ", MARK).split("\n") if text else ()):
            if k:
                out.append(self.line_feed)
            else:
                line = MARK + line
            if MARK + MARK in line:
                out += map(self.plain.__getitem__, self.cut.findall(line))
            else:
                words = line.split(MARK)
                if words[0]:
                    out.append(self.plain[words[0]])
                out += map(self.spaced.__getitem__, words[1:])
        out.append(self.eos.to_bytes(4, "little"))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the text: begin and end say nothing, and the space mark
        that encoding put first is taken off."""
        text = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return text.removeprefix(b" ")


def encode_decode(df: DataFrame, path: str, text_col: str = "text", out_col: str = "codec",
                  keep: bool = False) -> DataFrame:
    """``df`` with struct ``out_col`` added or replaced: ``n_tokens,
    ids_sha256, decoded_sha256`` and, if ``keep``, ``ids`` (packed) and
    ``decoded``.  NULL counts as the empty text, whose ids are begin and end."""
    more = ", ids binary, decoded string" if keep else ""

    @F.pandas_udf(f"n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = PieceCodec(path)
        for texts in batches:
            out = []
            for text in texts:
                ids = codec.encode(text or "")
                decoded = codec.decode(ids)
                row = (len(ids) // 4, sha256(ids).hexdigest(), sha256(decoded).hexdigest())
                out.append((*row, ids, decoded.decode()) if keep else row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep
            yield pd.DataFrame(out, columns=names)

    return df.withColumn(out_col, run(F.col(text_col)))
