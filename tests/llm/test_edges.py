"""Every operator on NULLs, empty and very long texts, ties, repeated rows,
an empty table and extra columns whose names clash with its own."""

import public_tokenizers
import pytest

from sensorflow.llm import iblt, language_id, token_counts, toxicity
from sensorflow.llm.exact_dedup import exact_dedup
from sensorflow.llm.license_scan import scan_licenses
from sensorflow.llm.license_texts import TEMPLATES
from sensorflow.llm.near_dedup import near_dedup, survivors
from sensorflow.llm.packing import pack_documents
from sensorflow.llm.piece_codec import encode_decode
from sensorflow.llm.sharding import interleave

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

SCHEMA = ("doc_id long, text string, lang string, source string, row long, n int, shard int, bin string, "
          "id string, size array<int>, g map<string,int>, toxicity string, codec string, lang_mix string, licenses string")
LONG = "lorem ipsum dolor sit amet " * 8000
EDGES = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog.", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog.", "en", "a"),   # repeated row
    (2, "another text under the same id, which is allowed", "en", None),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, "   \n\t ", "en", "b"),
    (None, "no id at all", "en", "b"),
    (None, None, None, "b"),
    (6, LONG, None, "c"),
    (7, LONG + "x", "en", "c"),
    (8, "12345 67890 !!", "en", "a"),
    (9, "Élan ÉTÉ straße 日本語 \U0001F600 İx", "fr", "a"),
    (10, "x" * 50_000, "en", "a"),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(*r, 7, 1, 2, "bin", "id", [1], {"k": 1}, "t", "c", "l", "m") for r in EDGES]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def table(spark, edges, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges") / "t")
    edges.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_exact_dedup(table):
    rows = exact_dedup(table).collect()
    assert len(rows) == len(EDGES)
    by = {}
    for r in rows:
        by.setdefault(r["text_sha256"], []).append(r)
    for group in by.values():
        assert {r["group_size"] for r in group} == {len(group)}
        assert sum(r["kept"] for r in group) == 1
        assert len({r["keep_id"] for r in group}) == 1
    fox = [r for r in rows if r["group_size"] == 3 and r["keep_id"] == 2]
    assert sorted(r["doc_id"] for r in fox) == [1, 2, 2]
    empty = [r for r in rows if r["group_size"] == 3 and r["keep_id"] == 4]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in empty) == [(False, 3), (False, 4), (True, 0)]
    assert exact_dedup(table.limit(0)).count() == 0


def test_near_dedup(table):
    found = near_dedup(table, shingle=4)
    rows = found.collect()
    assert len(rows) == len(EDGES)
    fox = [r for r in rows if r["component_id"] == 1]
    assert sorted(r["doc_id"] for r in fox) == [1, 2, 2]
    assert [r["doc_id"] for r in fox if r["kept"]] == [1]
    alone = [r for r in rows if r["n_shingles"] == 0]
    assert len(alone) == 4 and all(r["kept"] and r["component_id"] == r["doc_id"] for r in alone)
    long = {r["component_id"] for r in rows if r["doc_id"] in (6, 7)}
    assert long == {6}
    assert survivors(found).count() == len({r["group"] for r in rows})
    assert near_dedup(table.limit(0)).count() == 0


def test_sharding(table):
    rows = interleave(table, shards=4).collect()
    sizes = [sum(r["shard"] == s for r in rows) for s in range(4)]
    assert sum(sizes) == len(EDGES) and max(sizes) - min(sizes) <= 1
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {1}
    assert interleave(table.limit(0)).count() == 0
    assert [r["slot"] for r in interleave(table.limit(1), shards=16).collect()] == [0]


def test_packing(table):
    rows = pack_documents(table, WORDS, limit=100).collect()
    assert all(1 <= r["length"] <= 100 for r in rows)
    assert [r["length"] for r in rows if r["doc_id"] in (3, 4)] == [1, 1]
    assert pack_documents(table.limit(0), WORDS).count() == 0


def test_token_counts(table):
    from pyspark.sql import functions as F
    trees = token_counts.build(table, RANKS, public_tokenizers.PATTERN)
    trees = trees.withColumn("edits", F.when(F.col("doc_id") != 1, F.array(
        F.struct(F.lit(3).alias("at"), F.lit(5).alias("cut"), F.lit("new ").alias("put")),
        F.struct(F.lit(10**6).alias("at"), F.lit(9).alias("cut"), F.lit(None).cast("string").alias("put")))))
    rows = token_counts.apply_edits(trees, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", "text", F.col("tree.n_tokens").alias("was"), "after").collect()
    counter = token_counts.Counter(RANKS, public_tokenizers.PATTERN)
    for r in rows:
        text = r["text"] or ""
        assert r["was"] == len(counter.encoding.encode_ordinary(text))
        want = text if r["doc_id"] in (1, None) else text[:3] + "new " + text[8:]
        assert r["after"]["text"] == want
        assert r["after"]["n_tokens"] == len(counter.encoding.encode_ordinary(want))
        assert len(text) < 1000 or r["after"]["encoded"] < 200 or " " not in text[:1000]
    assert token_counts.build(table.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_piece_codec(table):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in encode_decode(table, PIECES, keep=True).collect():
        ids = lib.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert r["codec"]["n_tokens"] == len(ids)
        assert bytes(r["codec"]["ids"]) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r["codec"]["decoded"] == lib.decode(ids)
    assert encode_decode(table.limit(0), PIECES).count() == 0


def test_license_scan(table):
    rows = scan_licenses(table, TEMPLATES).collect()
    assert len(rows) == len(EDGES) and all(r["licenses"] == [] for r in rows)
    assert scan_licenses(table.limit(0), TEMPLATES).count() == 0


def test_fingerprints(table):
    rows = iblt.edited_fingerprints(table).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    prints = {r["fingerprint"] for r in rows if r["n_chars"] == 0}
    assert len(prints) == 1
    assert iblt.edited_fingerprints(table.limit(0)).count() == 0
    one = iblt.edited_fingerprints(table.filter("doc_id = 1")).collect()
    assert one[0]["near_next"] == 1.0


def test_language_id(table):
    model = language_id.fit(table)
    rows = language_id.predict(table, model).collect()
    by = {r["doc_id"]: r["lang_mix"] for r in rows}
    assert len(rows) == len(EDGES)
    for doc in (3, 4, 5, 8):
        assert (by[doc]["lang_pred"], by[doc]["score"]) == ("und", 0.0)
    assert by[1]["lang_pred"] == "en" and by[9]["lang_pred"] == "fr"
    assert language_id.predict(table.limit(0), model).count() == 0
    nothing = language_id.fit(table.limit(0))
    assert {r["lang_mix"]["lang_pred"] for r in language_id.predict(table, nothing).collect()} == {"und"}


def test_toxicity(spark, table):
    train = spark.createDataFrame(
        [(f"you utter nitwit {i}", 1) for i in range(40)] + [(f"a calm remark {i}", 0) for i in range(40)]
        + [(None, 1), ("unlabelled", None)], "text string, toxic int")
    model = toxicity.fit(train)
    rows = toxicity.score(table, model).collect()
    assert len(rows) == len(EDGES) and all(0 <= r["toxicity"] <= 1 for r in rows)
    new = spark.createDataFrame([("what a nitwit",), ("a calm day",)], "text string")
    bad, good = [r["toxicity"] for r in toxicity.score(new, model).collect()]
    assert bad > 0.7 > 0.5 > good
    for part in (train.limit(0), train.filter("toxic = 1")):  # no class to tell apart
        assert all(r["toxicity"] < 0.5 for r in toxicity.score(new, toxicity.fit(part)).collect())
