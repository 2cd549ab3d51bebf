"""Filter audit against a plain replay of every order."""

import collections
import itertools
import re

import pytest
from pyspark.sql import functions as F

from sensorflow.llm.filter_audit import audit, potential

DOCS = "doc_id long, text string, source string, mask string, n int"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{i}" for i in range(250))


def plain(docs, labels):
    """Rows of the audit, document by document."""
    smallest = {}
    for doc, text, *_ in docs:
        if doc is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc), doc)
    found = []
    for doc, text, source, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": doc is not None and doc > smallest[text]}
        mine = [m for m in labels if m[0] == doc and doc is not None]
        found.append((source or "", {f for f in fails if fails[f]}, any(m[1] == 1 for m in mine), any(m[2] == 1 for m in mine)))
    rows, shares = {}, collections.Counter()
    for part in {f[0] for f in found}:
        mine = [f for f in found if f[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                fails = sum(name in f[1] for f in mine)
                shares[part, name] += len(gone)
                rows[part, order, step] = [len(left), len(gone), fails - len(gone), sum(f[1] == {name} for f in mine),
                                           sum(f[2] for f in gone), sum(f[3] for f in gone)]
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def rows_of(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in df.collect()}


CASES = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG + " $", "a"), (4, LONG.upper(), "b"), (5, "same " * 300, "b"),
    (6, None, None), (7, "", ""), (8, " \t\n", "b"), (None, LONG, "a"), (None, LONG, "a"), (None, None, None),
    (9, LONG, "b"), (9, LONG, "b"), (9, LONG, "a"), (0, LONG.upper(), "b"), (10, "É" * 60 + " ÀB #", "a"),
    (11, "x " * 40_000, "c"), (12, LONG + " " + LONG, "c"), (13, LONG + "\x1c" + LONG, "c")]
MARKS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 0, 1), (9, 1, 1), (77, 1, 1), (None, 1, 1), (5, None, None), (6, 1, None)]


def test_equals_the_plain_replay(spark):
    docs = spark.createDataFrame([(*c, "kept out", 1) for c in CASES], DOCS).repartition(3)
    got = rows_of(audit(docs, spark.createDataFrame(MARKS, LABELS)))
    assert got == plain(CASES, MARKS)
    assert len(got) == 600 * 4  # a, b, c and the empty source


def test_a_hot_group_of_copies_and_of_missing_ids(spark):
    many = [(i if i % 3 else None, LONG, "hot") for i in range(1, 900)] + [(1000 + i, f"t {i}", "s") for i in range(50)]
    docs = spark.createDataFrame([(*c, "", 0) for c in many], DOCS).repartition(5)
    assert rows_of(audit(docs, spark.createDataFrame(MARKS, LABELS))) == plain(many, MARKS)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert audit(none, spark.createDataFrame([], LABELS)).count() == 0
    docs = spark.createDataFrame([(*c, "", 0) for c in CASES], DOCS)
    assert rows_of(audit(docs, spark.createDataFrame([], LABELS))) == plain(CASES, [])


@pytest.mark.parametrize("k", [1, 3, 4])
def test_potential_gives_shapley_values(spark, k):
    """For any number of filters, against marginal gains over all orders."""
    value = [(7 * s * s + 3 * s) % 101 if s else 0 for s in range(1 << k)]
    got = spark.range(1).select(potential(F.array(*[F.lit(v).cast("long") for v in value]), k).alias("p")).first()["p"]
    full = (1 << k) - 1
    orders = list(itertools.permutations(range(k)))
    scale = {1: 1, 3: 6, 4: 12}[k]
    for i in range(k):
        gain = 0
        for order in orders:
            before = sum(1 << j for j in order[:order.index(i)])
            gain += value[before | 1 << i] - value[before]
        assert (got[full] - got[full ^ 1 << i]) * len(orders) == gain * scale
