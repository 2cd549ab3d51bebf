"""Near-duplicate classes by circulant MinHash, banding and exact Jaccard.

Signatures take two permutations: the first spreads shingles over ``2**20``
places, the second, stored as a table, gives coordinate k after a circular
shift by k.  A shingle's coordinates are therefore one contiguous stretch of
the table, and a signature is the minimum over stretches.

Texts with the same word sequence are one *class* and are handled once.  Two
classes that share a band are candidates, and every link is confirmed on the
full shingle sets:

1. In each bucket of a band every member is compared with one member drawn by
   hash.  Buckets with the same members are kept once.
2. Components of the links found so far are labelled.  Members of a bucket that
   already carry its most frequent label need not meet each other; all others
   (strays) are compared with the whole bucket, in blocks: ``STRAYS`` sets
   against ``MEMBERS`` sets a task, so no task or row holds a whole bucket and
   no table of all pairs is made.  No cap is set on partners.

A pair of similarity 0.8 shares none of 50 bands of 6 with probability 3e-7.
A bucket whose members are all unlike each other costs step 2 the square of
its size, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sensorflow.llm.chargrams import Memo
from sensorflow.llm.components import components
from sensorflow.session import discard, materialize

PLACES = 1 << 20
CHUNK = 2048
STRAYS, MEMBERS = 256, 4096
HASHED_WORDS = 150_000  # whose hashes a worker keeps, some 30 MB
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
BAND_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers."""
    for m in MIX:
        x = (x ^ (x >> np.uint64(33))) * m
    return x ^ (x >> np.uint64(33))


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; with fewer words the
    whole sequence is the one shingle."""
    if not len(words):
        return np.empty(0, np.uint64)
    k = min(k, len(words))
    x = np.full(len(words) - k + 1, np.uint64(k))
    for j in range(k):
        x = mix(x * MIX[0] + words[j: len(words) - k + 1 + j])
    return np.unique(x)


class Signer:
    """Signatures of ``size`` coordinates from the two permutations."""

    def __init__(self, size: int, seed: int = 3):
        table = np.random.default_rng(seed).permutation(PLACES).astype(np.uint32)
        self.size = size
        self.stretches = np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[:size]]), size)

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        places = (mix(shingles ^ MIX[1]) >> np.uint64(44)).astype(np.int64)
        out = np.full(self.size, 2**32 - 1, np.uint32)
        for i in range(0, len(places), CHUNK):
            np.minimum(out, self.stretches[places[i: i + CHUNK]].min(axis=0), out=out)
        return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key a band, which also tells the band's number."""
    bands = signatures.shape[1] // rows
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * BAND_STEP, (len(signatures), bands)).copy()
    for j in range(rows):
        key = mix(key * MIX[0] + signatures[:, j::rows].astype(np.uint64))
    return key.view(np.int64)


def _word_hashes() -> Memo:
    return Memo(lambda w: xxh64_intdigest(w), HASHED_WORDS)


def _words(text: str | None) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters, A-Z lowered."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _hashes(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
               percent: int = 80, rows: int = 6, bands: int = 50, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id, kept, group, row``.

    Texts are linked when ``100 * |A & B| >= percent * |A | B|`` for their sets
    of ``shingle``-word shingles.  ``component_id`` is the smallest id that
    links lead to.  NULL or empty texts and texts without words have an empty
    set, link with nothing and stay.  ``kept``: the row has its component's
    smallest id (several rows may, where ids repeat).  ``row`` is the
    number stored in ``row_col`` (without one, a number stored with the
    signatures, under which the texts are not stored again), ``group`` the
    smallest such number of a class in the component.  Other columns are
    ignored.
    """
    base = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     *[F.col(c).alias("row") for c in (row_col,) if c])
    if row_col is None:  # rows equal in id and text cannot be told apart, and need not be
        base = base.select("*", *[F.xxhash64(F.lit(k), "id", "text").alias(f"key{k}") for k in (0, 1)])
    signed = _sign(base, shingle, rows, bands)
    if row_col is None:
        signed = signed.withColumn("row", F.monotonically_increasing_id())
    signed = materialize(signed, "signed")
    members = signed.select("row", "id", "n", "word_key").filter("n > 0")
    groups = materialize(members.groupBy("word_key").agg(
        F.min("row").alias("cls"), F.min("id").alias("least"), F.count(F.lit(1)).alias("size")), "classes")
    classes = groups.select("cls", "least")
    copies = groups.filter("size > 1").select("word_key", F.col("cls").alias("copy_of"))
    of_class = members.join(copies, "word_key", "left").select(
        "row", "id", "n", F.coalesce("copy_of", "row").alias("cls"))
    of_class = materialize(of_class, "classes")

    firsts = of_class.filter("row = cls").select("row")
    buckets = _buckets(signed, firsts)
    wanted = buckets.select(F.col("cls").alias("row")).distinct()
    # members of buckets grow with the table, so these joins shuffle at every size
    if row_col:
        texts = base.join(wanted.hint("merge"), "row", "left_semi")
    else:
        keys = ["key0", "key1"]
        wanted = signed.select("row", *keys).join(wanted.hint("merge"), "row", "left_semi")
        texts = base.select("text", *keys).join(wanted.hint("merge"), keys).dropDuplicates(keys)
    sets = materialize(_sets(texts, shingle), "sets")

    fits = 100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")
    stars = (buckets.filter((F.col("cls") != F.col("pivot")) & fits)
             .select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b")).distinct())
    links = materialize(_confirm(stars, sets, percent), "links")
    label = components(links)
    groups_of = classes.join(label, F.col("cls") == F.col("node"), "left").drop("node")
    more = _strays(buckets, label, sets, percent)
    spent = [signed, groups, of_class, buckets, sets, links, label]
    if more is not None:
        # links between labels, then labels of labels
        own = label.selectExpr("node AS x", "label AS l")
        ends = (more.join(own.withColumnsRenamed({"x": "a", "l": "la"}), "a", "left")
                .join(own.withColumnsRenamed({"x": "b", "l": "lb"}), "b", "left")
                .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
        upper = components(ends)
        spent += [more, upper]
        groups_of = (groups_of.withColumn("own", F.coalesce("label", "cls"))
                     .join(upper.selectExpr("node AS own", "label AS up"), "own", "left")
                     .select("cls", "least", F.coalesce("up", "label").alias("label")))

    # component: the least id over its classes
    labelled = materialize(groups_of.filter("label IS NOT NULL"), "groups")
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    linked = labelled.join(least, "label").select("cls", "component_id", "label")
    of_group = classes.join(linked, "cls", "left").select(
        "cls", F.coalesce("label", "cls").alias("group"),
        F.when(F.col("label").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    of_group = materialize(of_group, "groups")
    spent += [labelled, of_group]
    out = of_class.join(of_group, "cls").select("row", "id", "n", "component_id", "group")
    alone = signed.filter("n = 0").select("row", "id", "n", F.col("id").alias("component_id"),
                                          F.col("row").alias("group"))
    out = materialize(out.unionByName(alone), "near")
    discard(*spent)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "group", "row")


def survivors(found: DataFrame) -> DataFrame:
    """``row`` of exactly one kept row of each group of ``near_dedup``."""
    return found.filter("kept").groupBy("group").agg(F.min("row").alias("row")).select("row")


def _sign(base: DataFrame, shingle: int, rows: int, bands: int) -> DataFrame:
    @F.pandas_udf("n long, word_key binary, bands array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo, signer = _word_hashes(), Signer(rows * bands)
        for texts in batches:
            n, keys, signatures = [], [], np.empty((len(texts), rows * bands), np.uint32)
            for i, text in enumerate(texts):
                words = _words(text)
                shingles = shingle_set(_hashes(words, memo), shingle)
                n.append(len(shingles))
                keys.append(blake2b(b" ".join(words), digest_size=16).digest())
                signatures[i] = signer.sign(shingles)
            yield pd.DataFrame({"n": n, "word_key": keys, "bands": list(band_keys(signatures, rows))})

    own = [c for c in base.columns if c != "text"]
    return base.select(*own, run("text").alias("s")).select(*own, "s.*")


def _buckets(signed: DataFrame, firsts: DataFrame) -> DataFrame:
    """``band, cls, n, pivot, pivot_n``: members of the buckets with two
    classes or more; buckets with the same members only once."""
    pairs = (signed.filter("n > 0").join(firsts, "row", "left_semi")
             .select(F.explode("bands").alias("band"), F.col("row").alias("cls")).repartition("band"))
    # one shuffle of (band, class) finds the buckets of several and keeps their members; the rest is done on these
    several = pairs.groupBy("band").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).filter("a != b").select("band")
    kept = materialize(pairs.join(several, "band"), "shared")
    rows = materialize(kept.join(signed.select(F.col("row").alias("cls"), "n"), "cls"), "shared")
    draw = F.xxhash64("cls", "band")
    shared = rows.groupBy("band").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("cls")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "cls")).alias("y"), F.min_by("cls", draw).alias("pivot"),
        F.min_by("n", draw).alias("pivot_n"))
    once = shared.groupBy("size", "x", "y").agg(
        F.min("band").alias("band"), F.min_by("pivot", "band").alias("pivot"),
        F.min_by("pivot_n", "band").alias("pivot_n"))
    once = materialize(once.select("band", "pivot", "pivot_n"), "bands")
    out = materialize(rows.join(once, "band"), "buckets")
    discard(kept, rows, once)
    return out


def _sets(base: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _word_hashes()
        for batch in batches:
            yield pd.DataFrame({"cls": batch["row"], "shingles": [
                shingle_set(_hashes(_words(t), memo), shingle).view(np.int64) for t in batch["text"]]})

    return base.select("row", "text").mapInPandas(run, "cls long, shingles array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets are compared row by row: batches of them for Python would hold
    two whole sets a pair."""
    common = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b")
            .join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), "a")
            .filter(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b"))


def _strays(buckets: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links between members of a bucket that carry different labels."""
    rows = (buckets.join(label, F.col("cls") == F.col("node"), "left")
            .select("band", "cls", "n", F.coalesce("label", "cls").alias("label")))
    kinds = rows.groupBy("band", "label").agg(F.count(F.lit(1)).alias("size"))
    mixed = materialize(kinds.groupBy("band").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("size").alias("size"), F.max("size").alias("most"),
        F.max_by("label", F.struct("size", "label")).alias("main")).filter("kinds > 1"), "mixed")
    if not mixed.limit(1).count():
        return None
    tall, wide = F.ceil((F.col("size") - F.col("most")) / STRAYS), F.ceil(F.col("size") / MEMBERS)
    rows = rows.join(mixed, "band").select(
        "band", "cls", "n", "label", (F.col("label") != F.col("main")).alias("stray"),
        tall.cast("int").alias("tall"), wide.cast("int").alias("wide"),
        F.xxhash64("cls").alias("h"))
    # a stray goes to one row of blocks, and as a member to one column
    strays = rows.filter("stray").select(
        "band", "cls", "label", F.lit(True).alias("stray"), F.pmod("h", "tall").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("j"))
    others = rows.select(
        "band", "cls", "label", F.lit(False).alias("stray"),
        F.explode(F.sequence(F.lit(0), F.col("tall") - 1)).alias("i"), F.pmod("h", "wide").cast("int").alias("j"))
    blocks = strays.unionByName(others).join(sets, "cls")

    def run(block: pd.DataFrame) -> pd.DataFrame:
        top, rest = block[block["stray"]], block[~block["stray"]]
        found = []
        if len(top):
            size = np.array([len(x) for x in top["shingles"]])
            flat = np.concatenate(list(top["shingles"]))
            owner = np.repeat(np.arange(len(top)), size)
            by = np.argsort(flat, kind="stable")
            flat, owner = flat[by], owner[by]
            ids, labels = top["cls"].to_numpy(), top["label"].to_numpy()
            for cls, lab, own in zip(rest["cls"], rest["label"], rest["shingles"]):
                lo, hi = np.searchsorted(flat, own), np.searchsorted(flat, own, side="right")
                runs = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
                common = np.bincount(owner[at], minlength=len(top))
                hit = (100 * common >= percent * (size + len(own) - common)) & (labels != lab)
                found += [(min(cls, x), max(cls, x)) for x in ids[hit]]
        return pd.DataFrame(found, columns=["a", "b"])

    out = materialize(blocks.groupBy("band", "i", "j").applyInPandas(run, "a long, b long").distinct(), "links")
    discard(mixed)
    return out
