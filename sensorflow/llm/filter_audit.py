"""What each of several filters removes, alone, in every order, and fairly shared.

A document is its *mask* of failed filters.  A coalition of filters removes
the documents that fail any of its members: a game ``v`` over the ``2 ** k``
coalitions.  Its Hart-Mas-Colell potential is built up recursively,

    |S| P(S) = v(S) + sum over i in S of P(S without i),

and a filter's Shapley value is the grand potential less the potential without
that filter.  Steps of an order are differences of ``v`` between its prefixes.
All is kept in integers: ``lcm(1..k) P`` is one for every coalition.

Texts are shuffled as digests, once.  Counts leave each task per part and
mask, so neither a large part nor a large group of copies meets in one task.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.session import discard, materialize

SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SALTS = 1024  # rows without an id are spread over as many keys


def text_conditions(text: Column) -> dict[str, Column]:
    """A: under 200 words; B: less than half of the words distinct; C: over
    2 % of the characters are ``A-Z``; D: holds one of ``#$%&*|``.  NULL is the
    empty text, which fails A alone."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.char_length(text) - F.char_length(F.translate(text, CAPITALS, ""))
    return {"A": F.size(words) < 200,
            "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            "C": 100 * capitals > 2 * F.char_length(text),
            "D": text.rlike(r"[#$%&*|]")}


def failed_masks(docs: DataFrame, conditions: dict[str, Column], part: Column, copies: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, part, mask, same, n``: rows of ``docs`` by id, part, the filters they
    fail (bit ``i`` for the ``i``-th condition) and digest of the text.  With ``copies`` a last filter
    of that name: the text is the same as that of a row with a smaller id,
    wherever it is; rows without an id are never copies.

    Rows equal in id, part and text are counted as one row.  An empty table
    gives an empty result; a NULL part stays NULL."""
    mask = F.lit(0)
    for i, failed in enumerate(conditions.values()):
        mask = mask + F.when(failed, 1 << i).otherwise(0)
    same = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    rows = docs.select(F.col(id_col).alias("id"), part.alias("part"), mask.alias("mask"), same.alias("same"))
    rows = rows.groupBy("id", "part", "mask", "same").agg(F.count(F.lit(1)).alias("n"))
    if copies is None:
        return rows
    rows = materialize(rows, "masks")
    first = rows.groupBy("same").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    # joined on the id as well: the rows of a large group of copies stay spread
    copy = F.when(F.col("first").isNull() & F.col("id").isNotNull(), 1 << len(conditions)).otherwise(0)
    return rows.join(first.hint("merge"), ["same", "id"], "left").select(
        "id", "part", (F.col("mask") + copy).alias("mask"), "same", "n")


def coalition_values(masks: DataFrame, k: int, losses: DataFrame | None = None) -> DataFrame:
    """One row per part of ``failed_masks``: ``total`` and the arrays ``removed`` and one per
    column of ``losses``, indexed by coalition.  ``losses`` has ``id`` and
    boolean columns; an id in several rows counts where any of them is true."""
    names = [c for c in losses.columns if c != "id"] if losses is not None else []
    salt = F.when(F.col("id").isNull(), 1 + F.pmod(F.xxhash64("same"), F.lit(SALTS))).otherwise(0)
    if losses is not None:
        flags = losses.groupBy("id").agg(*[F.max(F.col(c)).alias(c) for c in names]).withColumn("salt", F.lit(0).cast("long"))
        masks = masks.withColumn("salt", salt.cast("long")).join(flags.hint("merge"), ["id", "salt"], "left")
    cells = masks.groupBy("part", "mask").agg(
        F.sum("n").alias("total"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in names])
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    values = (cells.withColumn("removed", F.col("total"))
              .withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << k) - 1))))
              .groupBy("part", "coalition").agg(
                  F.sum("total").alias("total"),
                  *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("removed", *names)]))
    rows = F.array_sort(F.collect_list(F.struct("coalition", "removed", *names)))  # one for each coalition
    return values.groupBy("part").agg(F.max("total").alias("total"), rows.alias("v")).select(
        "part", "total", *[F.col(f"v.{c}").alias(c) for c in ("removed", *names)])


def potential(value: Column, k: int) -> Column:
    """``lcm(1..k)`` times the potential of every coalition, from the array of
    the coalitions' values.  A coalition's number is above those of its parts,
    so they are there when it is its turn."""
    scale = lcm(*range(1, k + 1))

    def step(done: Column, s: Column) -> Column:
        total = F.get(value, s) * scale
        for i in range(k):
            total = total + F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(done, s - (1 << i))).otherwise(0)
        return F.array_append(done, F.call_function("div", total, F.bit_count(s).cast("long")))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << k) - 1)), F.array(F.lit(0).cast("long")), step)


def every_order(values: DataFrame, names: str, losses: dict[str, str]) -> DataFrame:
    """One row per part, order of the filters ``names`` (a letter each) and
    step: ``filter_order, step, kept, removed, redundant, unique_fails``, a
    count for each of ``losses`` (output name to column), and ``shapley``, the
    filter's removals summed over all orders."""
    k = len(names)
    full = (1 << k) - 1
    per_order = factorial(k) // lcm(*range(1, k + 1))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(names)])
    rows = (values.withColumn("potential", potential(F.col("removed"), k))
            .withColumn("filter_order", F.explode(orders))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k)))))
    prefix = F.substring(F.col("filter_order"), F.lit(1), F.col("step"))
    after = F.lit(0)
    for i, name in enumerate(names):
        after = after + F.when(prefix.contains(name), 1 << i).otherwise(0)
    at, own = F.substring(F.col("filter_order"), F.col("step"), F.lit(1)), F.lit(0)
    for i, name in enumerate(names):
        own = F.when(at == name, 1 << i).otherwise(own)
    rows = rows.withColumn("after", after).withColumn("own", own).withColumn("before", F.col("after") - F.col("own"))

    def gain(column: str) -> Column:
        return F.get(column, F.col("after")) - F.get(column, F.col("before"))

    others = F.lit(full) - F.col("own")
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.get("removed", F.col("after"))).alias("kept"),
        gain("removed").alias("removed"),
        (F.get("removed", F.col("own")) - gain("removed")).alias("redundant"),
        (F.get("removed", F.lit(full)) - F.get("removed", others)).alias("unique_fails"),
        *[gain(c).alias(out) for out, c in losses.items()],
        (per_order * (F.get("potential", F.lit(full)) - F.get("potential", others))).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """``every_order`` of the filters A to D of ``text_conditions`` and E,
    texts that a row with a smaller id has as well, per source (NULL: empty
    string, one part with empty sources).

    ``good_lost`` and ``toxic_lost`` count removed documents that ``labels``
    (``id_col, quality, toxic``) mark 1; an id with several labels counts if
    any is 1, documents without a label never.  Other columns are not read.
    An empty table has no parts, so no rows."""
    conditions = text_conditions(F.col(text_col))
    masks = failed_masks(docs, conditions, F.coalesce(F.col(source_col), F.lit("")), "E", id_col, text_col)
    marks = labels.select(F.col(id_col).alias("id"), (F.col("quality") == 1).alias("good"),
                          (F.col("toxic") == 1).alias("bad"))
    values = materialize(coalition_values(masks, 5, marks), "coalitions")  # 32 numbers a part and column
    discard(masks)
    return every_order(values, "ABCDE", {"good_lost": "good", "toxic_lost": "bad"})
