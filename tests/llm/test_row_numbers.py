"""Operators on a scan that gives its rows in another order each time it is read."""

import random

import corpus_pipeline as cp
from sensorflow.llm.exact_dedup import exact_dedup
from sensorflow.llm.iblt import edited_fingerprints
from sensorflow.llm.near_dedup import near_dedup, survivors

TEXT = "one two three four five six seven eight nine ten eleven twelve thirteen"
ROWS = [(i, f"{TEXT} {i // 3} {i // 3}. It ends with {i // 3}." * 3) for i in range(60)]


def unsteady(spark, rows=ROWS):
    def mix(batches):
        for batch in batches:
            yield batch.sample(frac=1, random_state=random.SystemRandom().randrange(2**31))

    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).mapInPandas(
        mix, "doc_id long, text string")


def steady(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def test_exact_dedup(spark):
    for rows in (ROWS, [(i, f"short {i // 3}") for i in range(60)]):  # several rounds, one round
        got = [r for r in exact_dedup(unsteady(spark, rows)).collect() if r["kept"]]
        assert sorted(r["doc_id"] for r in got) == list(range(2, 60, 3))


def test_near_dedup(spark):
    key = lambda df: sorted((r["doc_id"], r["component_id"], r["kept"]) for r in df.collect())
    assert key(near_dedup(unsteady(spark), shingle=4)) == key(near_dedup(steady(spark), shingle=4))
    found = near_dedup(unsteady(spark), shingle=4)
    assert survivors(found).count() == len({r["group"] for r in found.collect()})


def test_fingerprints(spark):
    key = lambda df: sorted((r["doc_id"], r["edited_sha256"], r["near_next"]) for r in df.collect())
    assert key(edited_fingerprints(unsteady(spark))) == key(edited_fingerprints(steady(spark)))


def test_pipeline_keeps_the_rows_it_chose(spark):
    assert sorted(r["doc_id"] for r in cp.drop_copies(spark, unsteady(spark), "").collect()) == list(range(2, 60, 3))
    near = [r["doc_id"] for r in cp.drop_near_copies(spark, unsteady(spark), "").collect()]
    want = {r["component_id"] for r in near_dedup(steady(spark), shingle=5).collect()}
    assert sorted(near) == sorted(want)
