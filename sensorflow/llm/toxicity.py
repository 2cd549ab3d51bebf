"""Toxicity by class-conditional Kneser-Ney models over letters.

Two models, toxic and ordinary, give each letter of a word its probability
after the letters before it.  Only the longest history is counted by class;
what its discount sets free goes to backoff distributions that both classes
share, so an expression too rare to be counted in either class weighs nothing.
A word's evidence is the difference of its two log-likelihoods, divided by its
length where that exceeds ``LONG_WORD`` letters.  A text's is the mean over the
``SHARE`` of its words that speak most for the toxic class: insults make up a
few words in a hundred, and a mean over all words would drown them in the noise
of the others, the more so the longer the text.  A logistic curve, fitted on
labelled texts the models have not seen, puts it on the scale 0 to 1.

Counts come from every labelled row and are summed by Spark.  The log ratios
of all counted n-grams and histories stay a Spark table; texts are scored in
blocks that meet only the entries they look up (``blocks``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sensorflow.llm.blocks import score_blocks
from sensorflow.llm.chargrams import LETTERS, Memo, count_grams, grams
from sensorflow.session import discard, materialize

FOLDS = 4          # one fold of the labelled texts sets the logistic curve
STEP = 0.05        # width of the histogram that the curve is fitted on
REACH = 50.0       # evidence beyond this is counted as this
SHARE = 0.005      # share of the words that decide; insults are 1 to 3 words in a hundred
LONG_WORD = 24


HISTORY = "="      # before a history's letters in the key; no n-gram holds it


@dataclass
class ToxicityModel:
    """Log ratios by n-gram and by history as a table ``key, value``, and the
    logistic curve."""

    table: DataFrame
    order: int
    curve: tuple[float, float] = (1.0, 0.0)


class Scorer:
    """The part of a model that some texts need, as a dict."""

    def __init__(self, ratios: dict, order: int, curve: tuple[float, float]):
        self.ratios, self.order, self.curve = ratios, order, curve

    def word(self, chunk: str) -> float:
        """Toxic less ordinary log-likelihood of the letters of a word."""
        total, letters, ratios = 0.0, 0, self.ratios
        for run in LETTERS.findall(chunk):
            letters += len(run)
            for gram in grams(run, self.order):
                ratio = ratios.get(gram)
                total += ratios.get(HISTORY + gram[:-1], 0.0) if ratio is None else ratio
        return total * LONG_WORD / max(letters, LONG_WORD)

    def evidence(self, text: str | None, memo: Memo) -> float:
        words = text.lower().split() if text else ()
        if not words:
            return 0.0
        values = np.fromiter(map(memo.__getitem__, words), float, len(words))
        most = max(1, int(len(words) * SHARE))
        return float(np.partition(values, -most)[-most:].mean())

    def score(self, evidence: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1.0 / (1.0 + np.exp(-np.clip(a * evidence + b, -60, 60)))


def fit(rows: DataFrame, text_col: str = "text", label_col: str = "toxic", order: int = 5,
        discount: float = 0.75) -> ToxicityModel:
    """Fit on ``rows`` (label 1: toxic, 0: ordinary, NULL rows are left out).

    The curve is set on one fold, scored by the counts of the others; copies
    of a text fall into one fold.  Scores then come from the counts of every
    row, the fold's included.  With no rows of one class every score is the curve's
    value at 0."""
    rows = materialize(rows.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"))
                       .filter("text IS NOT NULL AND label IN (0, 1)")
                       .withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS))), "labelled")
    counts = _counts(rows.withColumn("label", F.expr("label + IF(fold = 0, 2, 0)")), order)  # both in one pass
    model = ToxicityModel(_table(counts.filter("ct + co > 0"), order, discount), order)
    raw = _scored(rows.filter("fold = 0").select("label", "text"), model, "text", "score", curve=False)
    bins = (raw.groupBy(F.round(F.col("score") / STEP).cast("int").alias("bin"), "label").count()
            .orderBy("bin", "label").collect())  # 2 * REACH / STEP bins at most
    model.curve = _logistic(np.array([r["bin"] * STEP for r in bins]),
                            np.array([r["label"] for r in bins]),
                            np.array([r["count"] for r in bins], dtype=float))
    discard(model.table)
    model.table = _table(counts.select("gram", (F.col("ct") + F.col("ct0")).alias("ct"),
                                       (F.col("co") + F.col("co0")).alias("co")), order, discount)
    discard(rows, counts)
    return model


def _table(top: DataFrame, order: int, discount: float) -> DataFrame:
    """``key, value`` of all n-grams in ``top`` and their histories, written once."""
    seen, unseen = _log_ratios(top, order, discount)
    # an n-gram of ratio 0 has its row, or its history would stand in for it
    keyed = seen.select(F.col("gram").alias("key"), "r").unionByName(
        unseen.filter("r != 0").select(F.concat(F.lit(HISTORY), "gram").alias("key"), "r"))
    return materialize(keyed.select("key", F.array(F.col("r").cast("float")).alias("value")), "ratios")


def _ratios(rows: DataFrame, order: int, discount: float, most: int) -> tuple[dict, dict]:
    """The ``most`` heaviest n-grams and histories, to look at; scoring uses all."""
    top = _counts(rows, order)
    found = []
    for table in _log_ratios(top, order, discount):
        heavy = table.orderBy(F.desc(F.abs("r") * F.col("n")), "gram").limit(most).collect()
        found.append({r["gram"]: r["r"] for r in heavy})
    discard(top)
    return found[0], found[1]


def _counts(rows: DataFrame, order: int) -> DataFrame:
    """``gram, ct, co``: occurrences under label 1 and 0; ``ct0, co0``: under
    3 and 2, as ``fit`` marks the labels of the fold that sets the curve."""
    counts = count_grams(rows, "text", "label", order)
    return materialize(counts.groupBy("gram").agg(*[
        F.coalesce(F.sum(F.when(F.col("label") == label, F.col("n"))), F.lit(0)).alias(name)
        for name, label in (("ct", 1), ("co", 0), ("ct0", 3), ("co0", 2))]), "grams")


def _log_ratios(top: DataFrame, order: int, discount: float) -> tuple[DataFrame, DataFrame]:
    """``gram, r, n`` of the n-grams in ``top`` and of their histories."""
    history = F.expr("substring(gram, 1, length(gram) - 1)")

    # shared backoff: how many different histories a shorter n-gram follows
    shared = None
    level, levels = top.select("gram"), []
    for _ in range(order - 1):
        level = (level.filter("length(gram) > 1").select(F.expr("substring(gram, 2)").alias("gram"))
                 .groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
        levels.append(level)
    for level in reversed(levels):
        level = level.withColumn("h", history)
        total = level.groupBy("h").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        level = level.join(total, "h")
        if shared is None:
            lower = F.lit(1.0) / F.col("kinds")
        else:
            level = level.withColumn("back", F.expr("substring(gram, 2)")).join(
                shared.select(F.col("gram").alias("back"), "p"), "back", "left")
            lower = F.coalesce(F.col("p"), F.lit(1e-6))
        p = (F.greatest(F.col("n") - discount, F.lit(0.0)) + discount * F.col("kinds") * lower) / F.col("total")
        shared = level.select("gram", p.alias("p"))

    contexts = top.withColumn("h", history).groupBy("h").agg(
        *[F.sum(c).alias(f"{c}_all") for c in ("ct", "co")],
        *[F.count(F.when(F.col(c) > 0, 1)).alias(f"{c}_kinds") for c in ("ct", "co")])

    def free(c: str):  # share of a history's mass that goes to the shared backoff
        return (F.when(F.col(f"{c}_all") > 0, discount * F.col(f"{c}_kinds") / F.col(f"{c}_all"))
                .otherwise(F.lit(1.0)))

    def probability(c: str):
        kept = F.when(F.col(f"{c}_all") > 0,
                      F.greatest(F.col(c) - discount, F.lit(0.0)) / F.col(f"{c}_all")).otherwise(F.lit(0.0))
        return kept + free(c) * F.col("p")

    seen = (top.withColumn("h", history).withColumn("back", F.expr("substring(gram, 2)"))
            .join(contexts, "h")
            .join(shared.select(F.col("gram").alias("back"), "p"), "back", "left")
            .fillna(1e-6, ["p"])
            .select("gram", F.log(probability("ct") / probability("co")).alias("r"),
                    (F.col("ct") + F.col("co")).alias("n")))
    unseen = contexts.select(F.col("h").alias("gram"), F.log(free("ct") / free("co")).alias("r"),
                             (F.col("ct_all") + F.col("co_all")).alias("n"))
    return seen, unseen


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Weighted logistic curve; targets are drawn in from 0 and 1 (Platt), so
    classes that are fully apart still give a finite slope; it never falls."""
    pos, neg = float(n[y == 1].sum()), float(n[y == 0].sum())
    if not pos or not neg:
        return 0.0, -2.0
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = n * np.where(y == 1, 0.5 / pos, 0.5 / neg) * (pos + neg)  # classes count alike
    scale = x.std() or 1.0
    z, a, b = x / scale, 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        g = np.array([(weight * (target - p) * z).sum() - 1e-3 * a, (weight * (target - p)).sum()])
        w = weight * p * (1 - p) + 1e-9
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a + np.clip(step[0], -2, 2), b + np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return (float(a / scale), float(b)) if a > 0 else (0.0, -2.0)


def score(df: DataFrame, model: ToxicityModel, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``df`` with ``out_col`` (0 to 1) added or replaced.  NULL and empty
    texts get the curve's value at 0.  Every row is scored from its whole text
    alone."""
    return _scored(df, model, text_col, out_col)


def _scored(df: DataFrame, model: ToxicityModel, text_col: str, out_col: str, curve: bool = True) -> DataFrame:
    order, fitted = model.order, model.curve

    def keys(runs: set) -> set:
        found: set = set()
        for run in runs:
            found.update(grams(run, order))
        return found | {HISTORY + h for h in {g[:-1] for g in found}}

    def scorer(names: list, values: np.ndarray):
        m = Scorer(dict(zip(names, values[:, 0].tolist())) if names else {}, order, fitted)
        memo = Memo(m.word)

        def run(texts: list) -> np.ndarray:
            raw = np.array([m.evidence(t, memo) for t in texts], dtype=float)
            return m.score(raw) if curve else raw.clip(-REACH, REACH)

        return run

    return score_blocks(df, model.table, text_col, out_col, DoubleType(), keys, scorer)
