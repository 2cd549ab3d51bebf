"""Licence scans: winnowed fingerprints, then banded alignment.

Templates are cut into k-word shingles, of which winnowing keeps the smallest
hash of every window; an inverted index maps each to its places.  A document's
winnowed shingles look up candidates (template, diagonal); around each diagonal
a banded alignment of words counts the template's matched share and its span.
Any run of ``k + window - 1`` template words leaves a common fingerprint.

The index holds the templates only, whose number is the caller's, so it is the
same size for any table.  Words that no template has end a shingle at once,
which makes texts without licences cheap.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
NEVER = np.uint64(2**64 - 1)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
FOUND = "array<struct<template:string,coverage:double,matched:int,words:int,start:int,end:int>>"


class LicenseIndex:
    """Winnowed inverted index of templates, and the scan of one text."""

    def __init__(self, templates: dict[str, str], k: int = 3, window: int = 3, band: int = 8, least: float = 0.8):
        self.k, self.window, self.band, self.least = k, window, band, least
        self.vocabulary: dict[str, int] = {}
        self.templates = {name: [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in self.words(text)]
                          for name, text in templates.items()}
        self.places: dict[int, list[tuple[str, int]]] = {}
        for name, ids in self.templates.items():
            for at, code in self.winnow(np.array(ids, np.uint64)):
                self.places.setdefault(code, []).append((name, at))

    @staticmethod
    def words(text: str) -> list[str]:
        return WORD.findall(text.lower())

    def winnow(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Places and hashes of the shingles kept (id 0: not a template word).
        A text shorter than k words is one shingle."""
        k = min(self.k, len(ids))
        if not k:
            return []
        n = len(ids) - k + 1
        known = np.ones(n, bool)
        code = np.zeros(n, np.uint64)
        for j in range(k):
            part = ids[j: j + n]
            known &= part != 0
            code = (code ^ part) * SPREAD
            code ^= code >> np.uint64(29)
        if not known.any():
            return []
        code[~known] = NEVER  # is chosen only where nothing else is
        w = min(self.window, n)
        windows = np.lib.stride_tricks.sliding_window_view(code, w)
        kept = np.unique(np.arange(len(windows)) + windows.argmin(axis=1))
        return [(int(i), int(code[i])) for i in kept[known[kept]]]

    def align(self, template: list[int], ids: list[int], diagonal: int) -> tuple[int, int, int]:
        """Matched words and the first and last word of the text matched, by
        the best alignment that leaves the diagonal by ``band`` words at most.
        Skips cost nothing; of equal alignments the one that begins last, and
        then the one that ends first, counts."""
        width = 2 * self.band + 1
        none = (0, -1, -1)
        above = [none] * (width + 1)
        for i, word in enumerate(template):
            row, left = [], none
            for o in range(width):
                j = i + diagonal + o - self.band
                best = left if left[:2] > above[o + 1][:2] else above[o + 1]  # skip a word of either
                if 0 <= j < len(ids) and ids[j] == word:
                    matched, first, _ = above[o]
                    more = (matched + 1, first if first >= 0 else j, j)
                    if more[:2] > best[:2]:
                        best = more
                row.append(best)
                left = best
            above = row + [none]
        return max(above, key=lambda x: x[:2])

    def scan(self, text: str) -> list[tuple]:
        """``template, coverage, matched, words, start, end`` of each match;
        start and end count code points.  Matches do not overlap: of those that
        would, the one with most words matched counts, then the better covered,
        then the first.  So of look-alikes the one whose own words (such as
        *Affero* or *Lesser*) are there has the name, and a notice within a
        header or a first paragraph within a whole text is not told twice."""
        lower = text.lower()
        if len(lower) != len(text):  # a letter whose small form is longer: keep positions
            lower = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
        words = WORD.findall(lower)
        get = self.vocabulary.get
        ids = [get(w, 0) for w in words]
        diagonals: dict[str, list[int]] = {}
        for at, code in self.winnow(np.array(ids, np.uint64)):
            for name, place in self.places.get(code, ()):
                diagonals.setdefault(name, []).append(at - place)
        if not diagonals:
            return []
        hits = []
        for name, found in diagonals.items():
            template, last = self.templates[name], None
            for d in sorted(set(found)):
                if last is not None and d - last <= self.band // 2:
                    continue  # the band around the last diagonal covers this one
                last = d
                matched, first, end = self.align(template, ids, d)
                if matched >= self.least * len(template):
                    hits.append((-matched, -matched / len(template), first, end, name))
        if not hits:
            return []
        spans = [m.span() for m in WORD.finditer(lower)]
        taken: list[tuple[int, int]] = []  # apart from each other, in order
        out = []
        for matched, coverage, first, end, name in sorted(hits):
            at = bisect(taken, (first, end))
            if (at and taken[at - 1][1] >= first) or (at < len(taken) and taken[at][0] <= end):
                continue
            taken.insert(at, (first, end))
            out.append((name, -coverage, -matched, len(self.templates[name]), spans[first][0], spans[end][1]))
        return sorted(out, key=lambda x: (x[4], x[5], x[0]))


def scan_licenses(df: DataFrame, templates: dict[str, str], text_col: str = "text", out_col: str = "licenses",
                  **options) -> DataFrame:
    """``df`` with ``out_col``: array of the matches in each text, in order of
    their place, which do not overlap.  NULL, empty and wordless texts have none;
    texts are scanned whole, however long; repeated rows are scanned each; an empty
    table stays empty."""
    @F.pandas_udf(FOUND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = LicenseIndex(templates, **options)
        for texts in batches:
            yield pd.Series([index.scan(t) if t else [] for t in texts])

    return df.withColumn(out_col, run(F.col(text_col)))
