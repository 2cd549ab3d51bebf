"""Alignment of two tokenizers over the bytes of each text.

Both tokenizers cut the same bytes.  Two tokens are linked where their byte
ranges overlap, and a text falls into groups at the offsets where a token of
either side ends.  All documents of a block advance in lockstep: one state
vector holds a pointer into A and one into B for each document; every step
emits the links under the pointers and the cuts where both end, advances the
side that ends first (both at a cut) and drops the documents that are done.

How often an id pair is linked in the whole corpus is a Spark table.  A block
keeps its documents' links as numbers of its own pair dictionary, which is
joined with that table; counts go back to the block by number.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType
from tokenizers import Tokenizer

from sensorflow.llm.coded import in_blocks, packed, unpacked
from sensorflow.llm.packing import BYTE_LETTERS, PRINTS
from sensorflow.session import discard, materialize

BLOCK_BYTES = 4 << 20
CHUNK = 1 << 18  # characters given to a tokenizer at a time, up to the next lone space
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
MARK = "▁"
# Characters that any version of the Unicode tables puts in the same class.
PLAIN = re.compile("[\t\n\r\x20-\x7e\u00a1-\u00ac\u00ae-\u017f\u2010-\u2027]*")


class Tokens:
    """Both vocabularies: ids of a text, bytes and byte lengths of ids.

    With the ``pattern`` by which A splits texts, A's merges are run as ranks by
    a faster library where the text is ``PLAIN``; the file must list its
    merges in the order of their ids."""

    def __init__(self, path_a: str, path_b: str, pattern: str | None = None):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letter = {chr(b if b in PRINTS else BYTE_LETTERS[b]): b for b in range(256)}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes_a[i] = bytes(letter[c] for c in entry) if all(c in letter for c in entry) else entry.encode()
        self.ranked = self._ranked(pattern) if pattern else None
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        # a cut at a lone space changes no ids only if no piece spans one
        self.cuttable = not any(MARK in p.lstrip(MARK) for i, p in enumerate(pieces) if not self.b.is_byte(i))

    def _ranked(self, pattern: str) -> tiktoken.Encoding | None:
        model = json.loads(self.a.to_str())["model"]
        special = self.a.get_added_tokens_decoder()
        ranks = {self.bytes_a[i]: i for i in model["vocab"].values() if i not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(model["vocab"][x + y] != 256 + k for k, (x, y) in enumerate(merges)) or len(ranks) != 256 + len(merges):
            return None
        return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids_a(self, text: str) -> list[int]:
        if self.ranked and PLAIN.fullmatch(text):
            return self.ranked.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a space and the text by A, and of the text by B, which adds the space."""
        if len(text) <= CHUNK or not self.cuttable:
            return self.ids_a(" " + text), self.b.encode(text)
        a, b, at = [], [], 0
        while at < len(text):
            cut = LONE_SPACE.search(text, at + CHUNK)
            end = cut.start() if cut else len(text)
            a += self.ids_a(" " + text[at:end])
            b += self.b.encode(text[at:end])
            at = end + 1  # the space at the cut begins the next part on both sides
        return a, b

    def same_bytes(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """``ids``, or none where the joined bytes of a side are not a space and the text."""
        a, b = self.ids(text.decode()) if text else ([], [])
        whole = b" " + text if text else b""
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            a, b = [], []
        return np.array(a, np.int32), np.array(b, np.int32)


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, stop_a: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links ``(a, b)`` and cuts ``(a, b)`` as token indices, from the byte ends
    of all tokens and each document's first tokens and stop.  Ends grow along
    the block, and a document's last ends are equal on both sides."""
    on = first_a < stop_a
    i, j, stop = first_a[on], first_b[on], stop_a[on]
    links_a, links_b, cuts_a, cuts_b = [i[:0]], [j[:0]], [i[:0]], [j[:0]]
    while i.size:
        at_a, at_b = end_a[i], end_b[j]
        links_a.append(i)
        links_b.append(j)
        both = at_a == at_b
        if both.any():
            cuts_a.append(i[both])
            cuts_b.append(j[both])
        i, j = i + (at_a <= at_b), j + (at_b <= at_a)
        on = i < stop
        if not on.all():
            i, j, stop = i[on], j[on], stop[on]
    return tuple(map(np.concatenate, (links_a, links_b, cuts_a, cuts_b)))


class Block:
    """The alignment of some documents' texts."""

    def __init__(self, tokens: Tokens, texts: list[bytes | None]):
        sides = [tokens.same_bytes(t or b"") for t in texts]
        self.n_a = np.array([len(a) for a, _ in sides], np.int64)
        self.n_b = np.array([len(b) for _, b in sides], np.int64)
        none = np.zeros(0, np.int32)
        self.a, self.b = np.concatenate([none, *(a for a, _ in sides)]), np.concatenate([none, *(b for _, b in sides)])
        self.stop_a, self.stop_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        end_a = np.cumsum(np.array([len(x) for x in tokens.bytes_a], np.int64)[self.a])
        end_b = np.cumsum(np.array([len(x) for x in tokens.bytes_b], np.int64)[self.b])
        first_a, first_b = self.stop_a - self.n_a, self.stop_b - self.n_b
        self.link_a, self.link_b, cut_a, cut_b = lockstep(
            end_a, end_b, *(x.astype(np.int32) for x in (first_a, first_b, self.stop_a)))
        self.cut_a, self.cut_b = np.sort(cut_a).astype(np.int64), np.sort(cut_b).astype(np.int64)
        self.n_groups = np.searchsorted(self.cut_a, self.stop_a) - np.searchsorted(self.cut_a, first_a)
        self.doc = np.repeat(np.arange(len(texts)), self.n_a)[self.link_a]
        self.n_links = np.bincount(self.doc, minlength=len(texts))

    def groups(self, size_a: int, size_b: int) -> list[np.ndarray]:
        """Per document its groups as numbers into ``group_texts``."""
        code_a, code_b = self.a.astype(np.int32), self.b + np.int32(2 * size_a)
        begins_a, begins_b = np.r_[0, self.cut_a + 1][:-1], np.r_[0, self.cut_b + 1][:-1]
        code_a[begins_a] += size_a
        code_b[begins_b] += size_b
        # a group's tokens of A stand before those of B
        group_a, group_b = np.zeros(len(code_a), np.int64), np.zeros(len(code_b), np.int64)
        group_a[begins_a[1:]] = 1
        group_b[begins_b[1:]] = 1
        group_a, group_b = np.cumsum(group_a), np.cumsum(group_b)
        out = np.empty(len(code_a) + len(code_b), np.int32)
        if len(out):
            out[np.arange(len(code_a)) + begins_b[group_a]] = code_a
            out[np.arange(len(code_b)) + self.cut_a[group_b] + 1] = code_b
        return np.split(out, (self.stop_a + self.stop_b)[:-1])

    def histogram(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs, their links in the block, and for each document
        and pair in order the step from the one before it and its links."""
        keys = self.a[self.link_a].astype(np.int64) << 32 | self.b[self.link_b]
        pairs, number, counts = np.unique(keys, return_inverse=True, return_counts=True)
        cells = np.sort(self.doc * max(1, len(pairs)) + number)
        new = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, np.int64)
        return pairs, counts, np.diff(cells[new], prepend=0), np.diff(np.r_[new, len(cells)])


def group_texts(size_a: int, size_b: int) -> list[bytes]:
    """Texts of the numbers in ``Block.groups``: ids with what stands before them."""
    return [b"%s%d" % (mark, i) for mark, size in ((b",", size_a), (b";", size_a), (b",", size_b), (b"|", size_b))
            for i in range(size)]


def aligned_blocks(df: DataFrame, path_a: str, path_b: str, pattern: str | None, id_col: str, text_col: str,
                   keep: bool) -> DataFrame:
    kind = StructType([StructField(id_col, df.schema[id_col].dataType)])
    fields = "n_a long, n_b long, n_groups long, n_links long, cells long, groups_sha256 string, groups string"
    docs = f"array<struct<{kind.simpleString()[7:-1]},{fields.replace(' ', ':').replace(',:', ',')}>>"
    schema = f"block long, docs {docs}, steps binary, times binary, pairs array<long>, counts array<long>"
    id_type = to_arrow_type(df.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path_a, path_b, pattern)
        size_a, size_b = len(tokens.bytes_a), len(tokens.bytes_b)
        text_of = group_texts(size_a, size_b).__getitem__

        def make(number: int, rows: dict) -> pa.RecordBatch:
            block = Block(tokens, rows["text"])
            pairs, counts, steps, times = block.histogram()
            cells = np.bincount(np.cumsum(steps) // max(1, len(pairs)), minlength=len(block.n_a))
            digests, texts = [], []
            for codes in block.groups(size_a, size_b):
                text = b"".join(map(text_of, codes.tolist()))[1:]
                digests.append(sha256(text).hexdigest() if text else "")
                texts.append(text.decode() if keep else None)
            names = [id_col, "n_a", "n_b", "n_groups", "n_links", "cells", "groups_sha256", "groups"]
            columns = [pa.array(rows["id"], id_type), *(pa.array(x, pa.int64()) for x in (
                block.n_a, block.n_b, block.n_groups, block.n_links, cells)), pa.array(digests), pa.array(texts, pa.string())]
            docs = pa.StructArray.from_arrays(columns, names=names)
            one = pa.array([0, len(docs)], pa.int32())
            keys = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in (pairs, counts)]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays(one, docs),
                 pa.array([packed(steps)], pa.binary()), pa.array([packed(times)], pa.binary()), *keys],
                names=["block", "docs", "steps", "times", "pairs", "counts"])

        yield from in_blocks(batches, BLOCK_BYTES, "text", make)

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)


def align(df: DataFrame, path_a: str, path_b: str, pattern: str | None = None, id_col: str = "doc_id",
          text_col: str = "text", keep: bool = False) -> DataFrame:
    """One row per row of ``df``: ``id_col, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256`` and, if ``keep``, ``groups``.

    A (a byte-level vocabulary in JSON, which splits texts by ``pattern``) encodes
    a space and the text, B (a piece vocabulary) the text.  ``groups`` lists the groups' ids as
    ``a1,a2|b1;a3|b2,b3``.  An id pair counts its links in all of ``df``;
    ``count_sum`` adds that up over a row's links, ``n_best`` counts the links
    whose pair is linked as often as any with the same B id.

    NULL and empty texts, and texts whose bytes either side does not give back
    (such as one that holds B's space mark), have no tokens: zeros, and '' for
    groups and digest.  Rows are counted as often as they occur; ids may be
    NULL or repeated.  Very long texts are tokenized in parts cut at lone
    spaces, which changes no id.  An empty table gives an empty result."""
    blocks = materialize(aligned_blocks(df, path_a, path_b, pattern, id_col, text_col, keep), "aligned")
    asked = blocks.select(F.col("block").alias("of"), F.posexplode(F.arrays_zip("pairs", "counts")).alias("number", "p"))
    pairs = asked.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    pairs = materialize(pairs.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pairs")
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))  # at most B's vocabulary
    known = pairs.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    # dictionaries and pairs grow with the texts: one plan at every size
    found = asked.select("of", "number", F.col("p.pairs").alias("pair")).join(
        known.hint("merge"), "pair").select("of", "number", "n", "best")
    docs_type = blocks.schema["docs"].dataType.elementType
    names = [f.name for f in docs_type if f.name not in ("cells", "groups_sha256", "groups")]
    last = ["groups_sha256", "groups"] if keep else ["groups_sha256"]
    schema = StructType([docs_type[c] for c in names] + [StructField(c, docs_type["n_a"].dataType) for c in ("n_best", "count_sum")]
                        + [docs_type[c] for c in last])

    def count(block: pa.Table, counts: pa.Table) -> pa.Table:
        docs = block["docs"].chunk(0).flatten()
        order = np.argsort(counts["number"].to_numpy())
        n, best = counts["n"].to_numpy()[order], counts["best"].to_numpy()[order]
        number = np.cumsum(unpacked(block["steps"][0].as_py()).astype(np.int64)) % max(1, len(n))
        times = unpacked(block["times"][0].as_py()).astype(np.int64)
        stop = np.cumsum(docs.field("cells").to_numpy())

        def per_doc(values: np.ndarray) -> np.ndarray:
            return np.diff(np.r_[0, np.cumsum(values)][np.r_[0, stop]])

        columns = {c: docs.field(c) for c in names} | {
            "n_best": pa.array(per_doc(times * best[number])), "count_sum": pa.array(per_doc(times * n[number]))}
        return pa.table(columns | {c: docs.field(c) for c in last})

    rest = blocks.select("block", "docs", "steps", "times").groupBy("block")
    out = materialize(rest.cogroup(found.groupBy("of")).applyInArrow(count, schema), "alignment")
    discard(blocks, pairs)
    return out
