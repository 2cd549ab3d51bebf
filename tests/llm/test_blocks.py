"""Texts go to their blocks once, as compressed pieces."""

import random

import pyarrow as pa
from pyspark.sql.types import LongType

from sensorflow.llm import blocks
from sensorflow.llm.blocks import score_blocks

WORDS = ["the", "of", "Straße", "naïve", "x²", "123", "^", "$^", "a^b$c", "𐐀𐐁", "don't", "e-mail", "語", "İstanbul"]


def texts(n, seed):
    draw = random.Random(seed)
    return [" ".join(draw.choice(WORDS) + draw.choice(["", ",", "x"]) for _ in range(draw.randrange(1, 300))) for _ in range(n)]


def test_rows_come_back_from_pieces(spark, monkeypatch):
    """Every row once, with all its columns, from blocks of many pieces; NULL
    texts, equal rows and a column named like the parts of a piece."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    rows = [(i % 90, t, {"piece": [i]}) for i, t in enumerate([*texts(90, 1), None, "", *texts(8, 2)])] * 2
    df = spark.createDataFrame(rows, "block int, text string, piece map<string,array<int>>").repartition(3)
    table = spark.createDataFrame([(w, [float(len(w))]) for w in ("the", "of")], "key string, value array<float>")
    got = score_blocks(df, table, "text", "known", LongType(), lambda runs: runs, lambda names, values: lambda found: [
        sum(w in names for w in (t or "").lower().split()) for t in found])
    want = [(b, t, p, sum(w in ("the", "of") for w in (t or "").lower().split())) for b, t, p in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_texts_are_shuffled_once_and_compressed(spark):
    """Neither text nor its row is in any exchange, only pieces; both uses read one exchange."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts(400, 3))], "doc_id long, text string")
    table = spark.createDataFrame([("the", [1.0])], "key string, value array<float>")
    got = score_blocks(df, table, "text", "n", LongType(), lambda runs: runs, lambda names, values: lambda found: [0] * len(found))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan()
    final = plan.toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "ReusedExchange [r" not in final
    sent = [line for line in final.splitlines() if "ReusedExchange" in line]
    assert sent and all("piece" in line for line in sent)


def test_pieces_are_small_and_end(monkeypatch):
    monkeypatch.setattr(blocks, "PIECE_BYTES", 10_000)
    lines = texts(600, 4)
    r = pa.array([{"text": t} for t in lines])
    numbers = pa.array(sorted(i % 3 for i in range(600)), pa.int32())
    whole = pa.record_batch([r, numbers], ["r", "block"])
    found = list(blocks._pieces(iter([whole.slice(0, 50), whole.slice(50, 0), whole.slice(50, 60), whole.slice(110)])))
    pieces = pa.Table.from_batches(found)
    assert [t["text"] for t in blocks._rows(pieces).to_pylist()] == lines
    assert sorted(set(pieces["block"].to_pylist())) == [0, 1, 2] and pieces.num_rows > 3
    assert pieces["block"].to_pylist() == sorted(pieces["block"].to_pylist())
    assert sum(map(len, pieces["piece"].to_pylist())) < 0.6 * sum(len(t.encode()) for t in lines)
    assert list(blocks._pieces(iter([]))) == []
