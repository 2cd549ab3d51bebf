"""Character n-grams inside words, counted over a table."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.session import bound_batches

LETTERS = re.compile(r"[^\W\d_]+")
CACHE_WORDS = 700_000  # some 150 MB of keys and values in a worker
LONGEST_KEY = 64
LETTERS_AT_ONCE = 250_000  # held as numbers, in some 20 MB


def grams(word: str, order: int) -> list[str]:
    """For each letter and the word end: it with up to ``order - 1`` symbols
    before it.  ``^`` and ``$`` mark the ends, which no letter run contains."""
    word = f"^{word}$"
    return [word[max(0, i - order + 1): i + 1] for i in range(1, len(word))]


def portions(words: list[str]) -> Iterator[slice]:
    """Runs of words with some ``LETTERS_AT_ONCE`` symbols; a longer word is alone."""
    ends, lo = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2), 0
    while lo < len(words):
        most = LETTERS_AT_ONCE + (int(ends[lo - 1]) if lo else 0)
        yield slice(lo, lo := max(lo + 1, int(np.searchsorted(ends, most, side="right"))))


def spelled(words: list[str]) -> np.ndarray:
    """Code points of ``^word$`` of all words, one after the other."""
    return np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le"), np.uint32).astype(np.int64)


def numbered_grams(words: list[str], order: int) -> tuple[list[str], np.ndarray]:
    """``grams`` of all words, in that order, as numbers in a list of names.
    The list begins with "" and holds the endings of each gram too.

    A gram is told by its first letter and the number of the rest, so each
    length is numbered from the one before."""
    if not words:
        return [""], np.zeros(0, np.int64)
    points = spelled(words)
    begins = points == ord("^")
    at = np.flatnonzero(~begins)
    depth = at - np.maximum.accumulate(np.where(begins, np.arange(len(points)), 0))[at]
    names, numbers = [""], np.zeros(len(at), np.int64)
    for k in range(order):
        live = np.flatnonzero(depth >= k)  # the gram still begins inside its word
        found, codes = pd.factorize(points[at[live] - k] << 32 | numbers[live])
        numbers[live] = found + len(names)
        names += [chr(code >> 32) + names[code & 0xFFFFFFFF] for code in codes.tolist()]
    return names, numbers


class Memo(dict):
    """``memo[key]`` computes a value once.  Bounded: it is emptied when full,
    and very long keys are not kept."""

    def __init__(self, compute, size: int = CACHE_WORDS):
        super().__init__()
        self.compute, self.size = compute, size

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= LONGEST_KEY:
            if len(self) >= self.size:
                self.clear()
            self[key] = value
        return value


def count_grams(rows: DataFrame, text_col: str, label_col: str, order: int) -> DataFrame:
    """``label, gram, n``: occurrences over all rows.  Each task counts words,
    then grams of the distinct words, and passes on one row per gram."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict = {}

        def flush() -> pd.DataFrame:
            out = []
            for label, counter in words.items():
                found: Counter = Counter()
                kinds, times = list(counter), np.fromiter(counter.values(), float, len(counter))
                for part in portions(kinds):
                    names, numbers = numbered_grams(kinds[part], order)
                    each = np.repeat(times[part], [len(w) + 1 for w in kinds[part]])
                    sums = np.bincount(numbers, each, len(names)).astype(int)  # exact to 2 ** 53
                    for i in np.flatnonzero(sums).tolist():
                        found[names[i]] += int(sums[i])
                out += [(label, gram, n) for gram, n in found.items()]
            words.clear()
            return pd.DataFrame(out, columns=["label", "gram", "n"])

        for batch in batches:
            for label, text in zip(batch["label"], batch["text"]):
                words.setdefault(label, Counter()).update(LETTERS.findall(text.lower()))
            if sum(map(len, words.values())) > CACHE_WORDS:
                yield flush()
        yield flush()
        pa.default_memory_pool().release_unused()

    bound_batches(rows.sparkSession)
    kind = rows.schema[label_col].dataType.simpleString()
    return (rows.select(F.col(label_col).alias("label"), F.col(text_col).alias("text"))
            .filter("label IS NOT NULL AND text IS NOT NULL")
            .mapInPandas(count, f"label {kind}, gram string, n long")
            .groupBy("label", "gram").agg(F.sum("n").alias("n")))
