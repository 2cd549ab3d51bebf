"""Token counts that follow edits.

A document's text is split into pre-tokens, and a segment tree over them keeps
sums of characters and tokens.  An edit descends the tree to the pre-tokens it
touches; splitting starts again ``CONTEXT`` characters before the edit and goes
on behind it until a new pre-token begins where an old one began, because from
there on the old split holds.  Only the pre-tokens in between are encoded, and
the sums above them change; the rest of the text is not looked at.

Trees are columns of a DataFrame (``build``), so a later job can go on from
them with new edits (``apply_edits``).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.chargrams import Memo

#: A pre-token ends for reasons at most this many characters behind its end
#: (contractions look two ahead, white space one).
CONTEXT = 3
PIECES = 250_000  # pre-tokens whose counts a task remembers
TREE = "chars binary, tokens binary, n_tokens long"


class Counter:
    """Splits text and counts tokens by a file of byte ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.count = Memo(lambda piece: len(self.encoding.encode_ordinary(piece)), PIECES)

    def tree(self, text: str) -> Tree:
        pieces = self.pattern.findall(text)
        return Tree(list(map(len, pieces)), list(map(self.count.__getitem__, pieces)))


class Tree:
    """Segment tree over pre-tokens: sums of characters and of tokens.

    Leaves hold ``LEAF`` pre-tokens or fewer; a level holds the sums of
    ``FAN`` neighbours of the level below it.
    """

    LEAF, FAN = 32, 8

    def __init__(self, chars: list[int], tokens: list[int]):
        size = self.LEAF
        self.leaves = [(chars[i: i + size], tokens[i: i + size]) for i in range(0, len(chars), size)]
        self.levels: list[list[list[int]]] = []
        self.rebuild()

    def rebuild(self) -> None:
        sums = [[sum(c), sum(t)] for c, t in self.leaves] or [[0, 0]]
        self.levels = [sums]
        while len(sums) > 1:
            sums = [[sum(x[0] for x in sums[i: i + self.FAN]), sum(x[1] for x in sums[i: i + self.FAN])]
                    for i in range(0, len(sums), self.FAN)]
            self.levels.append(sums)

    @property
    def n_chars(self) -> int:
        return self.levels[-1][0][0]

    @property
    def n_tokens(self) -> int:
        return self.levels[-1][0][1]

    def find(self, pos: int) -> tuple[int, int, int]:
        """Leaf, index in it and start of the pre-token that holds character
        ``pos`` (the last one, if ``pos`` is the text's end)."""
        node, start = 0, 0
        for level in range(len(self.levels) - 2, -1, -1):
            row, node = self.levels[level], node * self.FAN
            last = min(node + self.FAN, len(row)) - 1
            while node < last and start + row[node][0] <= pos:
                start += row[node][0]
                node += 1
        chars, i = self.leaves[node][0], 0
        while i < len(chars) - 1 and start + chars[i] <= pos:
            start += chars[i]
            i += 1
        return node, i, start

    def replace(self, first: tuple[int, int], last: tuple[int, int], chars: list[int], tokens: list[int]) -> None:
        """Put new pre-tokens in place of those from ``first`` up to, but
        without, ``last`` (leaf and index).  Sums above the leaf change; the
        levels are laid out anew only when leaves come or go."""
        (a, i), (b, j) = first, last
        end = self.leaves[b]
        new = self.leaves[a][0][:i] + chars + end[0][j:], self.leaves[a][1][:i] + tokens + end[1][j:]
        if a == b and 0 < len(new[0]) <= 2 * self.LEAF:
            before = self.levels[0][a]
            by = sum(new[0]) - before[0], sum(new[1]) - before[1]
            self.leaves[a] = new
            node = a
            for row in self.levels:
                row[node] = [row[node][0] + by[0], row[node][1] + by[1]]
                node //= self.FAN
            return
        size = self.LEAF
        self.leaves[a: b + 1] = [(new[0][k: k + size], new[1][k: k + size]) for k in range(0, len(new[0]), size)]
        self.rebuild()


def edit(counter: Counter, text: str, tree: Tree, at: int, cut: int, put: str) -> tuple[str, int]:
    """Replace ``cut`` characters at ``at`` by ``put``: the new text and the
    number of characters that were encoded.  ``tree`` follows."""
    at = min(at, len(text))
    cut = min(cut, len(text) - at)
    now = text[:at] + put + text[at + cut:]
    if not tree.leaves:
        fresh = counter.tree(now)
        tree.leaves, tree.levels = fresh.leaves, fresh.levels
        return now, len(now)
    # pre-tokens that end CONTEXT characters before the edit or earlier stay
    leaf, i, start = tree.find(max(0, at - CONTEXT))
    first, old, by = (leaf, i), start, len(put) - cut
    chars, tokens = [], []
    for found in counter.pattern.finditer(now, start):
        pos = found.start()
        while old < pos - by and leaf < len(tree.leaves):  # old pre-tokens that begin earlier are replaced
            old += tree.leaves[leaf][0][i]
            leaf, i = (leaf, i + 1) if i + 1 < len(tree.leaves[leaf][0]) else (leaf + 1, 0)
        if pos >= at + len(put) and old == pos - by:
            break
        chars.append(len(found.group()))
        tokens.append(counter.count[found.group()])
    else:
        leaf, i = len(tree.leaves), 0
    if i == 0 and leaf > first[0]:  # stay in the leaf before
        leaf, i = leaf - 1, len(tree.leaves[leaf - 1][0])
    tree.replace(first, (leaf, i), chars, tokens)
    return now, sum(chars)


def _stored(tree: Tree) -> tuple[bytes, bytes, int]:
    chars, tokens = ([x for leaf in tree.leaves for x in leaf[k]] for k in (0, 1))
    return np.array(chars, "<u4").tobytes(), np.array(tokens, "<u4").tobytes(), tree.n_tokens


def build(df: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "tree") -> DataFrame:
    """``df`` with ``out_col``: the leaves of each text's tree and its token
    count.  NULL counts as the empty text, which has no leaves."""
    @F.pandas_udf(TREE)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = Counter(path, pattern)
        for texts in batches:
            yield pd.DataFrame([_stored(counter.tree(t or "")) for t in texts], columns=["chars", "tokens", "n_tokens"])

    return df.withColumn(out_col, run(F.col(text_col)))


def apply_edits(df: DataFrame, path: str, pattern: str, text_col: str = "text", tree_col: str = "tree",
                edits_col: str = "edits", out_col: str = "after") -> DataFrame:
    """``df`` with ``out_col``: the edited ``text``, its tree, ``n_tokens`` and
    the characters ``encoded`` on the way.

    ``edits`` is an array of ``struct<at int, cut int, put string>``, applied
    in order; positions count code points of the text as it then is and are
    clipped to it.  NULL or empty edits leave text and count as they are.
    """
    @F.pandas_udf(f"text string, {TREE}, encoded long")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        counter = Counter(path, pattern)
        for texts, chars, tokens, edits in batches:
            out = []
            for text, c, t, todo in zip(texts, chars, tokens, edits):
                tree = Tree(np.frombuffer(c, "<u4").tolist(), np.frombuffer(t, "<u4").tolist())
                text, encoded = text or "", 0
                for e in todo if todo is not None else ():
                    text, n = edit(counter, text, tree, e["at"], e["cut"], e["put"] or "")
                    encoded += n
                out.append((text, *_stored(tree), encoded))
            yield pd.DataFrame(out, columns=["text", "chars", "tokens", "n_tokens", "encoded"])

    return df.withColumn(out_col, run(text_col, f"{tree_col}.chars", f"{tree_col}.tokens", edits_col))


def recount(df: DataFrame, path: str, pattern: str, text_col: str = "text", edits_col: str = "edits",
            out_col: str = "counts") -> DataFrame:
    """``build`` and ``apply_edits`` in one pass, for callers that need the
    counts only: ``df`` with struct ``out_col`` of ``n_tokens,
    edited_n_tokens, edited_n_chars, encoded, edited_sha256``.  Trees and
    edited texts stay in the task."""
    @F.pandas_udf("n_tokens long, edited_n_tokens long, edited_n_chars long, encoded long, edited_sha256 string")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        counter = Counter(path, pattern)
        for texts, edits in batches:
            out = []
            for text, todo in zip(texts, edits):
                text, encoded = text or "", 0
                tree = counter.tree(text)
                before = tree.n_tokens
                for e in todo if todo is not None else ():
                    text, n = edit(counter, text, tree, e["at"], e["cut"], e["put"] or "")
                    encoded += n
                out.append((before, tree.n_tokens, tree.n_chars, encoded, sha256(text.encode()).hexdigest()))
            yield pd.DataFrame(out, columns=["n_tokens", "edited_n_tokens", "edited_n_chars", "encoded",
                                             "edited_sha256"])

    return df.withColumn(out_col, run(text_col, edits_col))
