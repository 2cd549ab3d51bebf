"""The pipeline, stage by stage, against plain versions of its decisions."""

import collections

import corpus_pipeline as cp
from sensorflow.llm import language_id, queries, toxicity
from sensorflow.session import materialize

from test_brute_force import LOW, check_packing, near_components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = queries.documents(spark, SF)
    columns = docs.columns
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        now = materialize(stage(spark, docs, SF), name)
        assert now.columns == columns
        before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (docs, now))
        assert after.items() <= before.items()
        kept[name] = before, after
        if name == "toxicity":
            model = toxicity.fit(docs.select("doc_id", "text").join(queries.labels(spark, SF), "doc_id"))
            scores = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
            assert set(after) == {d for d, s in scores.items() if s < cp.TOXIC_FROM}
        if name == "language_id":
            found = language_id.predict(docs, language_id.fit(docs)).collect()
            assert set(after) == {r["doc_id"] for r in found if sum(r["lang_mix"]["mixture"].values()) >= cp.LEAST_SHARE}
            assert all(r["lang_mix"]["lang_pred"] == "und" for r in found if r["doc_id"] not in after)
        docs = now
    before, after = kept["exact_dedup"]
    by = collections.defaultdict(list)
    for doc, text in before.items():
        by[(text or "").translate(LOW)].append(doc)
    assert set(after) == {max(ids) for ids in by.values()}
    before, after = kept["near_dedup"]
    assert set(after) == {c for _, c in near_components(before.items(), 5).values()}
    check_packing(cp.STAGES[-1][1](spark, docs, SF).collect(), after.items())


def test_run_equals_its_stages(spark):
    rows = cp.run(spark, SF).collect()
    docs = queries.documents(spark, SF)
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
    want = docs.collect()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(tuple(r[k] for k in key) for r in rows) == sorted(tuple(r[k] for k in key) for r in want)


def test_copies_with_repeated_and_null_ids(spark, tmp_path):
    """One document of each group stays, whatever the ids."""
    path = str(tmp_path / "t")
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, text), (5, text), (None, text.upper()), (6, text + " extra"), (7, ""), (7, None), (None, "  ")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    exact = materialize(cp.drop_copies(spark, docs, SF))
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in exact.collect())[-2:] == [(6, text + " extra"), (7, "")]
    assert exact.count() == 4
    near = cp.drop_near_copies(spark, exact, SF)
    assert sorted(r["doc_id"] or -1 for r in near.collect()) == [-1, 5, 7]


def test_a_text_in_three_languages_is_kept(spark):
    """No language makes up half of it, but known ones explain it."""
    docs = queries.documents(spark, SF)
    rows = docs.filter("lang IS NOT NULL AND length(text) > 400").collect()
    parts = {}
    for r in rows:
        parts.setdefault(r["lang"], r["text"].split()[:60])
    mixed = [w for lang in sorted(parts)[:3] for w in parts[lang]]
    more = spark.createDataFrame([(10**9, " ".join(mixed), None, "mix", 0), (10**9 + 1, "12345 --- !!!", None, "mix", 0)], docs.schema)
    kept = {r["doc_id"] for r in cp.keep_identified(spark, docs.unionByName(more), SF).filter("source = 'mix'").collect()}
    assert kept == {10**9}


def test_columns_of_any_name_pass_through_and_empty_tables_stay_empty(spark):
    docs = queries.documents(spark, SF).limit(60).selectExpr(
        "*", "1 AS __row", "'r' AS row", "'x' AS toxicity", "named_struct('a', 1) AS lang_mix", "2.5 AS `odd.name`")
    docs = materialize(docs)
    for _, stage in cp.STAGES[:-1]:
        now = stage(spark, docs, SF)
        assert now.columns == docs.columns
        row = now.first()
        assert (row["__row"], row["row"], row["toxicity"], row["lang_mix"]["a"], float(row["odd.name"])) == (1, "r", "x", 1, 2.5)
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
