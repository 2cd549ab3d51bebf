"""What steps of the corpus operators leave on disk, and hold in memory."""

import os

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sensorflow.llm import blocks, iblt
from sensorflow.llm.chargrams import count_grams
from sensorflow.llm.near_dedup import _confirm, _sets
from sensorflow.session import ARROW_BYTES, BATCH_BYTES


def test_texts_of_fingerprints_go_before_the_last_table(spark, monkeypatch):
    numbered, seen = [], {}
    number, materialize = iblt.number, iblt.materialize

    def numbers(*args):
        out = number(*args)
        numbered.extend(f.removeprefix("file:").replace("///", "/") for f in out.inputFiles())
        seen["at first"] = all(map(os.path.exists, numbered))
        return out

    def writes(df, name="stage", codec=None):
        if name == "differences":
            seen["at last"] = any(map(os.path.exists, numbered))
        return materialize(df, name, codec)

    monkeypatch.setattr(iblt, "number", numbers)
    monkeypatch.setattr(iblt, "materialize", writes)
    docs = spark.createDataFrame([(i, f"One {i}. Two. Three {i % 3}.") for i in range(9)], "doc_id long, text string")
    assert iblt.edited_fingerprints(docs).count() == 9
    assert numbered and seen == {"at first": True, "at last": False}
    assert all(".zstd." in f for f in numbered)


def test_pairs_of_sets_are_confirmed_without_python(spark):
    """Exactly four fifths link, less does not; sets keep all 64 bits."""
    words = [f"w{i}" for i in range(12)]
    texts = [(0, " ".join(words)), (1, " ".join(words[:11])), (2, " ".join(words[:8])), (3, " ".join([*words[:10], "x"])), (4, "z")]
    sets = _sets(spark.createDataFrame(texts, "row long, text string"), 4)
    kept = {r["cls"]: set(r["shingles"]) for r in sets.collect()}
    assert [len(kept[i]) for i in range(5)] == [9, 8, 5, 8, 1] and np.min([min(s) for s in kept.values()]) < 0
    pairs = [(a, b) for a in range(5) for b in range(a + 1, 5)]
    found = _confirm(spark.createDataFrame(pairs, "a long, b long"), sets, 80)
    want = {(a, b) for a, b in pairs if 100 * len(kept[a] & kept[b]) >= 80 * len(kept[a] | kept[b])}
    assert {(r["a"], r["b"]) for r in found.collect()} == want and (0, 1) in want
    edge = _confirm(spark.createDataFrame([(0, 1)], "a long, b long"), spark.createDataFrame(
        [(0, [1, 2, 3, 4, 5]), (1, [2, 3, 4, 5])], "cls long, shingles array<long>"), 80)
    assert edge.count() == 1
    plan = edge._jdf.queryExecution().executedPlan().toString()
    assert "MapIn" not in plan and "Python" not in plan


def test_texts_cross_to_python_in_small_batches(spark, monkeypatch):
    """A partition of 16 MB of text would otherwise be one batch."""
    pieces = blocks._pieces

    def watched(batches):
        def small():
            for batch in batches:
                assert batch.nbytes <= 1.1 * BATCH_BYTES, batch.nbytes
                yield batch
        return pieces(small())

    monkeypatch.setattr(blocks, "_pieces", watched)
    session = spark.newSession()
    docs = session.range(0, 8000, 1, 1).select("id", F.repeat(F.lit("words of "), 230).alias("text"))
    table = session.createDataFrame([("o", [1.0])], "key string, value array<float>")
    found = blocks.score_blocks(docs, table, "text", "out", LongType(), lambda runs: {"o"},
                                lambda names, values: lambda texts: [len(t) for t in texts])
    assert [tuple(r) for r in found.groupBy("out").count().collect()] == [(2070, 8000)]


def test_counting_bounds_batches_unless_the_session_does(spark):
    for bound, want in ((None, str(BATCH_BYTES)), ("1m", "1m")):
        session = spark.newSession()
        if bound:
            session.conf.set(ARROW_BYTES, bound)
        rows = session.createDataFrame([("aa", "x"), ("a", "x")], "text string, lang string")
        assert {r["gram"]: r["n"] for r in count_grams(rows, "text", "lang", 1).collect()} == {"a": 3, "$": 2}
        assert session.conf.get(ARROW_BYTES) == want
