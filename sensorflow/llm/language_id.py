"""Language identification by multilingual mixture inference.

Each language has an n-gram model of letters inside words.  A document is a
mixture: every word is drawn from one of the document's languages.
Expectation-maximisation estimates the proportions from the words'
likelihoods; which languages take part is chosen by penalised likelihood: a
language stays only if it raises the log-likelihood by more than
``penalty * log(words)``.

Counts come from every labelled row and are summed by Spark.  The
log-probabilities of all counted n-grams and of their endings stay a Spark
table; texts are scored in blocks that meet only the entries they look up
(``blocks``).  The documents of a block are solved together in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType

from sensorflow.llm.blocks import score_blocks
from sensorflow.llm.chargrams import LETTERS, count_grams, numbered_grams, portions, spelled
from sensorflow.session import discard, materialize

UNDETERMINED = "und"
STEPS = 12          # EM steps; proportions move by less than a hundredth after about ten
FLOOR = -12.0       # no n-gram counts for less (natural logarithm)
LONG_WORD = 16      # a word weighs no more than this many letters
BLOCK_WORDS = 200_000  # solved together, in some 30 MB
PREDICTION = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("mixture", MapType(StringType(), DoubleType()))])


@dataclass
class FittedLanguages:
    """All log-probabilities as a table ``key, value``, one value a language."""

    languages: list[str]
    table: DataFrame | None
    order: int
    penalty: float


class LanguageModel:
    """The part of the log-probabilities that some texts need: of each of ``names``
    a row of ``values``, one value a language.  With a gram its endings are there."""

    def __init__(self, languages: list[str], names: list[str], values: np.ndarray, order: int, penalty: float):
        self.languages, self.order, self.penalty = languages, order, penalty
        self.values = np.concatenate([np.zeros((1, len(languages)), np.float32), values])  # row 0: nothing found
        rows = dict(zip(names, range(1, len(names) + 1)))
        rows[""] = 0
        # a gram is told by its first letter and the row of the rest
        self.steps = pd.Index(np.fromiter((ord(g[0]) << 32 | rows[g[1:]] for g in names), np.int64, len(names)))

    def _rows(self, points: np.ndarray) -> np.ndarray:
        """Of each letter and word end (``spelled``) the row of the longest gram
        that ends there, 0 if there is none."""
        at = np.flatnonzero(points != ord("^"))
        out = np.zeros(len(at), np.int64)
        live = np.arange(len(at))
        for k in range(self.order):  # no gram has a word end before its last symbol, so none leaves its word
            found = self.steps.get_indexer(points[at[live] - k] << 32 | out[live])
            live, found = live[found >= 0], found[found >= 0]
            out[live] = found + 1
        return out

    def words(self, chunks: list[str]) -> np.ndarray:
        """Log-likelihood of each word in each language less that in the best;
        NaN if the word has no letters."""
        found = list(map(LETTERS.findall, chunks))
        runs = np.fromiter(map(len, found), np.int64, len(found))
        lettered = np.flatnonzero(runs)
        out = np.full((len(chunks), len(self.languages)), np.nan, np.float32)
        if len(lettered):
            at = self._rows(spelled(list(chain.from_iterable(found))))
            runs, letters = runs[lettered], np.array([sum(map(len, found[k])) for k in lettered.tolist()])
            ends = np.cumsum(letters + runs)  # each letter and each run's end has a row
            total = np.add.reduceat(self.values[at], ends - letters - runs, axis=0)
            total -= total.max(axis=1, keepdims=True)
            out[lettered] = total * np.minimum(1.0, LONG_WORD / letters).astype(np.float32)[:, None]
        return out


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = 4,
        penalty: float = 2.0) -> FittedLanguages:
    """Fit on the rows whose language and text are not NULL.

    Probabilities of a letter after its history are smoothed with the shorter
    history's, down to an even distribution over the letters seen."""
    rows = (rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
            .filter("text IS NOT NULL AND lang IS NOT NULL"))
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return FittedLanguages([], None, order, penalty)
    counts = count_grams(rows, "text", "lang", order)
    # endings are counted by language first, so a further language adds no column to a row on its way
    ends = (counts.select("label", "n", F.expr(
        "explode(transform(sequence(1, length(gram)), k -> right(gram, k)))").alias("gram"))
        .groupBy("label", "gram").agg(F.sum("n").alias("n")))
    wide = materialize(ends.groupBy("gram").agg(*[
        F.coalesce(F.sum(F.when(F.col("label") == lang, F.col("n"))), F.lit(0)).cast("double").alias(f"n{i}")
        for i, lang in enumerate(languages)]), "endings")
    table = materialize(_log_probabilities(wide, order, len(languages)), "languages")
    discard(wide)
    return FittedLanguages(languages, table, order, penalty)


def _log_probabilities(wide: DataFrame, order: int, languages: int) -> DataFrame:
    """Interpolated (Witten-Bell) log-probabilities of all counted n-grams and
    of their shorter endings; ``wide`` has both with their counts."""
    each = range(languages)
    wide = wide.withColumn("h", F.expr("substring(gram, 1, length(gram) - 1)"))
    histories = wide.groupBy("h").agg(*[F.sum(f"n{i}").alias(f"t{i}") for i in each],
                                      *[F.count(F.when(F.col(f"n{i}") > 0, 1)).alias(f"k{i}") for i in each])
    even = 1.0 / max(1, wide.filter("length(gram) = 1").count())
    joined = wide.join(histories.hint("merge"), "h").drop("h")
    lower, found = None, None
    for k in range(1, order + 1):
        level = joined.filter(F.length("gram") == k)
        if lower is not None:
            level = level.withColumn("back", F.expr("substring(gram, 2)")).join(
                lower.select(F.col("gram").alias("back"), *[f"p{i}" for i in each]).hint("merge"), "back", "left")
        back = [F.lit(even) if lower is None else F.coalesce(f"p{i}", F.lit(even)) for i in each]
        lower = level.select("gram", *[
            ((F.col(f"n{i}") + (F.col(f"k{i}") + 0.5) * back[i]) / (F.col(f"t{i}") + F.col(f"k{i}") + 0.5))
            .alias(f"p{i}") for i in each])
        found = lower if found is None else found.unionByName(lower)
    return found.select(F.col("gram").alias("key"), F.array(*[
        F.greatest(F.log(F.greatest(F.col(f"p{i}"), F.lit(1e-30))), F.lit(FLOOR)).cast("float")
        for i in each]).alias("value"))


def infer(model: LanguageModel, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Proportions (documents x languages) of documents whose words' log
    likelihoods are the rows of ``words``; document i's begin at starts[i].
    No document may be without words."""
    n = np.diff(np.append(starts, len(words))).astype(float)
    doc = np.repeat(np.arange(len(starts)), n.astype(int))
    like = np.exp(words)

    def em(allowed: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log-likelihood of the chosen documents, each over its allowed languages."""
        pick = np.isin(doc, docs) if len(docs) < len(starts) else slice(None)
        p, size = like[pick], n[docs]
        at = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(int)
        of = np.repeat(np.arange(len(docs)), size.astype(int))
        share = allowed / allowed.sum(1, keepdims=True)
        for _ in range(STEPS):
            joint = p * share[of].astype(np.float32)
            joint /= np.maximum(joint.sum(1, keepdims=True), 1e-30)
            share = np.add.reduceat(joint, at, axis=0, dtype=float) / size[:, None]
        fit = np.log(np.maximum((p * share[of].astype(np.float32)).sum(1), 1e-30))
        return share, np.add.reduceat(fit, at, dtype=float)

    every = np.arange(len(starts))
    kinds = words.shape[1]
    alone = np.add.reduceat(words, starts, axis=0, dtype=float)
    best = np.zeros((len(starts), kinds))
    best[every, alone.argmax(1)] = 1.0
    value, price = alone.max(1), model.penalty * np.log(n + 1)
    # The log-likelihood is concave in the proportions, so from the best single
    # language no mixture gains more than the steepest slope towards another.
    own = np.take_along_axis(like, alone.argmax(1)[doc][:, None], axis=1)
    slope = np.add.reduceat(like / np.maximum(own, 1e-30), starts, axis=0, dtype=float) - n[:, None]
    open_ = np.flatnonzero(np.minimum(slope.max(1), -value) > price)
    if kinds > 1 and len(open_):
        full, _ = em(np.ones((len(open_), kinds)), open_)
        order = np.argsort(-full, axis=1, kind="stable")
        for size in range(2, kinds + 1):
            allowed = np.zeros((len(open_), kinds))
            np.put_along_axis(allowed, order[:, :size], 1.0, axis=1)
            share, fit = em(allowed, open_)
            better = fit - (size - 1) * price[open_] > value[open_]
            best[open_[better]] = share[better]
            value[open_[better]] = (fit - (size - 1) * price[open_])[better]
            more = -value[open_] > 0  # a further language must still be able to pay
            more &= -(size * price[open_]) > value[open_]
            open_, order = open_[more], order[more]
            if not len(open_):
                break
    return best


class _Numbers(dict):
    """``numbers[word]`` is how many other words were asked for before it."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def predict(df: DataFrame, model: FittedLanguages, text_col: str = "text", out_col: str = "lang_mix") -> DataFrame:
    """``df`` with ``out_col`` added or replaced: struct of ``lang_pred`` (largest proportion;
    of equal ones the first in alphabetical order), ``score`` (that proportion)
    and ``mixture`` (language to proportion, above 0.01).  ``und`` with score 0
    where the text is NULL or has no letter, or no language was learned."""
    if not model.languages:
        return df.withColumn(out_col, F.struct(
            F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.expr("cast(map() AS map<string, double>)").alias("mixture")))
    languages, order, penalty = model.languages, model.order, model.penalty

    def keys(runs: set) -> set:
        runs, found = list(runs), set()
        for part in portions(runs):
            found.update(numbered_grams(runs[part], order)[0][1:])
        return found

    def scorer(names: list, values: np.ndarray):
        m = LanguageModel(languages, names, values.reshape(-1, len(languages)), order, penalty)
        names.clear()

        def run(texts: list) -> list:
            preds = [(UNDETERMINED, 0.0, [])] * len(texts)
            index = _Numbers()  # word to row of the table
            table = np.empty((BLOCK_WORDS // 4, len(languages)), np.float32)

            def solve(docs: list[tuple[int, list[str]]]) -> None:
                nonlocal table
                first = len(index)
                counts = [len(words) for _, words in docs]
                at = np.fromiter(map(index.__getitem__, chain.from_iterable(words for _, words in docs)),
                                 np.int64, sum(counts))
                new, last = list(islice(index, first, None)), len(index)
                if last > len(table):  # by half as much again, so that it is copied seldom
                    table = np.resize(table, (max(last, len(table) * 3 // 2), len(languages)))
                for part in portions(new):
                    table[first + part.start: first + part.stop] = m.words(new[part])
                found = table[at]
                lettered = ~np.isnan(found[:, 0])
                starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
                sizes = np.add.reduceat(lettered, starts, dtype=int)
                kept = np.flatnonzero(sizes)
                if not len(kept):
                    return
                starts = np.concatenate([[0], np.cumsum(sizes[kept])[:-1]]).astype(int)
                for k, x in zip(kept, infer(m, found[lettered], starts)):
                    best = int(x.argmax())
                    preds[docs[k][0]] = (languages[best], float(min(1.0, x[best])),
                                         [(languages[j], float(x[j])) for j in np.flatnonzero(x > 0.01)])

            docs, size = [], 0
            for i, text in enumerate(texts):
                words = text.lower().split() if text else ()
                if words:
                    docs.append((i, words))
                    size += len(words)
                if docs and (size > BLOCK_WORDS or i == len(texts) - 1):
                    solve(docs)
                    docs, size = [], 0
            return [dict(zip(("lang_pred", "score", "mixture"), p)) for p in preds]

        return run

    return score_blocks(df, model.table, text_col, out_col, PREDICTION, keys, scorer)
