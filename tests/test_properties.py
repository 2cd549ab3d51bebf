"""Property tests (hypothesis): upsert against a dict model, dedupe invariance."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sensorflow.operators.dedupe import dedupe_by_key
from sensorflow.operators.upsert import upsert, upsert_counts

rows = st.lists(st.tuples(st.integers(0, 30), st.one_of(st.none(), st.integers(0, 5))),
                max_size=25, unique_by=lambda r: r[0])
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SETTINGS
@given(target=rows, source=rows)
def test_upsert_matches_model_and_is_idempotent(spark, target, source):
    t = spark.createDataFrame(target, "k int, v int")
    s = spark.createDataFrame(source, "k int, v int")
    model = dict(target)
    model.update(dict(source))  # whole-row replace, NULLs included
    once = upsert(t, s, "k")
    assert _sorted(once) == sorted(model.items(), key=repr)
    assert _sorted(upsert(once, s, "k")) == _sorted(once)
    c = upsert_counts(t, s, "k").first()
    assert c.updates == len({k for k, _ in source} & {k for k, _ in target})
    assert c.inserts + c.updates == len(source)


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 10**6)), max_size=40,
                     unique_by=lambda r: r[1]),
       parts=st.integers(1, 6), seed=st.integers(0, 100))
def test_dedupe_invariant_under_order_and_partitioning(spark, data, parts, seed):
    import random
    shuffled = list(data)
    random.Random(seed).shuffle(shuffled)
    a = dedupe_by_key(spark.createDataFrame(data, "k int, o int"), "k", ["o"])
    b = dedupe_by_key(spark.createDataFrame(shuffled, "k int, o int").repartition(parts), "k", ["o"])
    assert _sorted(a) == _sorted(b)
    want = {}
    for k, o in data:
        want[k] = max(want.get(k, -1), o)
    assert dict(_sorted(a)) == want
