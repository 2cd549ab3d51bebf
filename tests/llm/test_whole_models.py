"""Rare n-grams count in tables of any size; the models have no largest size."""

import itertools

from sensorflow.llm import language_id, toxicity

SMALL = "небо море гора река"


def test_a_small_language_beside_a_large_one(spark):
    """234,256 four-letter words of one language, four words of the other."""
    words = ["".join(w) for w in itertools.product("abcdefghijklmnopqrstuv", repeat=4)]
    rows = [(" ".join(words[i::40] * 2), "aa") for i in range(40)] + [(SMALL, "zz")]
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    new = spark.createDataFrame([(SMALL,), ("abcd efgh",)], "text string")
    assert [r["lang_mix"]["lang_pred"] for r in language_id.predict(new, model).collect()] == ["zz", "aa"]


def test_rare_words_among_many_letter_sequences(spark):
    """371,293 five-letter words in both classes, one word in the toxic one only."""
    words = ["".join(w) for w in itertools.product("abcdefghijklm", repeat=5)]
    rows = [(" ".join(words[i::40] * (2 + i % 2) + ["балда", str(i)] * (i % 2)), i % 2) for i in range(40)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    ratios = {r["key"]: r["value"][0] for r in model.table.collect()}
    assert sum(not k.startswith(toxicity.HISTORY) for k in ratios) > 300_000
    assert ratios["балда"] > 0.5 and ratios["^балд"] > 0.5
    assert toxicity.Scorer(ratios, model.order, model.curve).word("балда") > 3


def test_a_counted_letter_is_not_taken_for_an_unseen_one():
    """A ratio of 0 is a ratio; only n-grams never counted fall back to the history."""
    scorer = toxicity.Scorer({"^a": 0.0, "=^": 2.0, "=^a": 1.0}, 5, (1.0, 0.0))
    assert scorer.word("a") == 1.0 and scorer.word("b") == 2.0


def test_blocks_keep_columns_rows_and_scores(spark, monkeypatch):
    """Scores do not depend on the blocks a table is cut into."""
    from sensorflow.llm import blocks
    train = spark.createDataFrame([(f"you utter nitwit {i}", 1) for i in range(20)]
                                  + [(f"a calm remark {i}", 0) for i in range(20)], "text string, toxic int")
    model = toxicity.fit(train)
    docs = spark.createDataFrame([(i, f"nitwit number {i % 7}" if i % 3 else None, {"k": i}) for i in range(200)],
                                 "id int, text string, m map<string,int>")
    whole = {r["id"]: (r["m"], r["toxicity"]) for r in toxicity.score(docs, model).collect()}
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 100)
    cut = toxicity.score(docs, model).collect()
    assert len(cut) == 200 and {r["id"]: (r["m"], r["toxicity"]) for r in cut} == whole


def test_every_labelled_text_is_counted(spark):
    """Each text has a word of its own; whichever fold it falls into, the word is known."""
    words = ["nitwit", "балда", "trottel", "crétin", "idiota", "dummkopf", "fjols", "hlupák", "ostrolog", "quvzex"]
    rows = [(f"you {w}", 1) for w in words] + [(f"a calm remark {w[::-1]}", 0) for w in words]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    known = {r["key"] for r in model.table.collect()}
    assert {f"^{w}$"[:5] for w in words} <= known and {f"^{w[::-1]}$"[:5] for w in words} <= known
