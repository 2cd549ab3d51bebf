"""Keyed table: NULL partition values, message order, record of changes, deletes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sensorflow.session import scratch_path
from sensorflow.sources.keyed_table import KeyedTable

ROWS = "k long, day date, v string"
ORDERED = "k long, v string, _at long, _offset long"


def day(n):
    return None if n is None else dt.date(2024, 1, n)


def rows_of(kt):
    return sorted((tuple(r) for r in kt.read().collect()), key=repr)


@pytest.mark.parametrize("order, recorded", [(False, False), (True, False), (False, True), (True, True)])
def test_rows_of_a_null_partition_are_kept(spark, order, recorded):
    root = scratch_path(spark, "null")
    kt = KeyedTable(spark, f"{root}/t", ["k", "day"], partition_by={"p": F.col("day")},
                    order=["v"] if order else None, changes_path=f"{root}/c" if recorded else None)
    assert kt.upsert(spark.createDataFrame([(1, None, "a")], ROWS)) == (1, 0)
    assert rows_of(kt) == [(1, None, "a")]
    assert kt.upsert(spark.createDataFrame([(2, None, "a"), (3, day(2), "a")], ROWS)) == (2, 0)
    assert kt.upsert(spark.createDataFrame([(4, day(2), "b"), (5, None, "b")], ROWS)) == (2, 0)
    assert rows_of(kt) == sorted([(1, None, "a"), (2, None, "a"), (3, day(2), "a"), (4, day(2), "b"), (5, None, "b")], key=repr)
    # a fresh handle reads the types from the rows, not from the folders' names
    again = KeyedTable(spark, f"{root}/t", ["k", "day"], partition_by={"p": F.col("day")})
    assert dict(again.read(with_partition_cols=True).dtypes)["p"] == "date"


@pytest.mark.parametrize("recorded", [False, True])
def test_batches_in_any_order_leave_the_same_table(spark, recorded):
    rng = random.Random(4)
    messages = [(rng.randrange(12), f"m{i}", rng.randrange(6), i) for i in range(60)]
    newest = {}
    for m in messages:
        if m[0] not in newest or m[2:] > newest[m[0]][2:]:
            newest[m[0]] = m
    for seed in range(2):
        root = scratch_path(spark, "order")
        kt = KeyedTable(spark, f"{root}/t", "k", buckets=3, order=["_at", "_offset"],
                        changes_path=f"{root}/c" if recorded else None)
        random.Random(seed).shuffle(messages)
        total = 0
        for i in range(0, 60, 15):
            batch = {}
            for m in messages[i:i + 15]:
                if m[0] not in batch or m[2:] > batch[m[0]][2:]:
                    batch[m[0]] = m
            inserts, updates = kt.upsert(spark.createDataFrame(list(batch.values()), ORDERED))
            assert inserts + updates + kt.stale == len(batch)
            total += inserts
        assert total == len(newest)
        assert rows_of(kt) == sorted(((k, v) for k, v, *_ in newest.values()), key=repr)
        assert kt.read(with_order=True).columns == ["k", "v", "_at", "_offset"]


def test_missing_order_is_oldest_and_an_equal_one_replaces(spark):
    kt = KeyedTable(spark, scratch_path(spark, "tie"), "k", buckets=1, order=["_at", "_offset"])
    kt.upsert(spark.createDataFrame([(1, "a", None, 0), (2, "a", 5, 5)], ORDERED))
    assert kt.upsert(spark.createDataFrame([(1, "b", 0, 0), (2, "b", None, 9)], ORDERED)) == (0, 1)
    assert kt.stale == 1 and rows_of(kt) == [(1, "b"), (2, "a")]
    assert kt.upsert(spark.createDataFrame([(2, "c", 5, 5)], ORDERED)) == (0, 1)
    assert rows_of(kt) == [(1, "b"), (2, "c")]


def changed(kt, batch):
    return sorted(((r["op"], None if r["old"] is None else tuple(r["old"]), tuple(r["new"])) for r in kt.changes(batch).collect()),
                  key=repr)


def test_changes_hold_both_images_and_a_replay_gives_the_same(spark):
    root = scratch_path(spark, "changes")

    def table():
        return KeyedTable(spark, f"{root}/t", "k", buckets=2, order=["_at", "_offset"], changes_path=f"{root}/c")

    kt = table()
    first = spark.createDataFrame([(1, "a", 1, 1), (2, "a", 1, 2), (3, None, 1, 3)], ORDERED)
    second = spark.createDataFrame([(1, "b", 2, 1), (2, "old", 0, 2), (3, None, 1, 3), (4, "n", 2, 4)], ORDERED)
    assert kt.upsert(first, batch_id=0) == (3, 0)
    assert kt.upsert(second, batch_id=1) == (1, 2) and kt.stale == 1
    want = [("insert", None, (4, "n")), ("update", (1, "a"), (1, "b"))]
    assert changed(kt, 1) == want
    stored = rows_of(kt)
    assert table().upsert(second, batch_id=1) == (1, 2)      # the last batch again, after a restart
    assert table().upsert(first, batch_id=0) == (3, 0)       # and one from before it
    assert changed(kt, 1) == want and rows_of(kt) == stored == [(1, "b"), (2, "a"), (3, None), (4, "n")]
    assert kt.changes().count() == 5


def test_a_record_completes_a_table_that_was_not_written(spark):
    """The driver dies between the record and the table."""
    root = scratch_path(spark, "died")
    kt = KeyedTable(spark, f"{root}/t", "k", buckets=2, changes_path=f"{root}/c")
    kt.upsert(spark.createDataFrame([(1, "a"), (2, "a")], "k long, v string"), batch_id=0)
    batch = spark.createDataFrame([(2, "b"), (3, "b")], "k long, v string")
    kt._decide(batch, None, 1)
    assert rows_of(kt) == [(1, "a"), (2, "a")]
    assert kt.upsert(batch, batch_id=1) == (1, 1)
    assert rows_of(kt) == [(1, "a"), (2, "b"), (3, "b")]
    # a record cut short does not count
    spark.createDataFrame([(9,)], "x int").write.parquet(f"{root}/c/batch_id=2")
    fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/c/batch_id=2/_SUCCESS"), False)
    assert kt.upsert(spark.createDataFrame([(4, "c")], "k long, v string"), batch_id=2) == (1, 0)


def test_duplicates_and_empty_batches_with_a_record(spark):
    root = scratch_path(spark, "rec")
    kt = KeyedTable(spark, f"{root}/t", "k", buckets=2, changes_path=f"{root}/c")
    assert kt.upsert(spark.createDataFrame([], "k long, v string"), batch_id=0) == (0, 0)
    with pytest.raises(Exception, match="duplicate key"):
        kt.upsert(spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string"), batch_id=1)
    assert kt.upsert(spark.createDataFrame([(1, "x")], "k long, v string"), batch_id=1) == (1, 0)
    assert rows_of(kt) == [(1, "x")]


def test_delete_empties_partitions(spark):
    kt = KeyedTable(spark, scratch_path(spark, "delete"), ["k", "day"], partition_by={"p": F.col("day")})
    kt.upsert(spark.createDataFrame([(1, None, "a"), (2, day(1), "a"), (3, day(1), "a"), (4, day(2), "a")], ROWS))
    assert kt.delete(spark.createDataFrame([(1, None), (2, day(1)), (4, day(2)), (9, day(9))], "k long, day date")) == 2
    # a NULL key value is no match, as in SQL
    assert rows_of(kt) == sorted([(1, None, "a"), (3, day(1), "a")], key=repr)
    assert kt.delete(spark.createDataFrame([(9, day(9))], "k long, day date")) == 0
    assert kt.delete(spark.createDataFrame([(3, day(1))], "k long, day date")) == 1
    assert rows_of(kt) == [(1, None, "a")]


def test_touched_partitions_are_read_without_moving_old_rows(spark, tmp_path):
    """No join where the batch touches every partition that its values span; else a
    broadcast of the partitions."""
    from pyspark.sql import functions as F

    from sensorflow.sources.keyed_table import KeyedTable
    table = KeyedTable(spark, str(tmp_path / "t"), "k", partition_by={
        "tens": (F.col("k") / 10).cast("int"), "odd": F.col("k") % 2})
    first = spark.createDataFrame([(k, "a") for k in range(40)] + [(None, "n")], "k long, v string")
    assert table.upsert(first) == (41, 0)

    def pruned(keys):
        rows = spark.createDataFrame([(k,) for k in keys], "k long").withColumns(table.partition_by)
        found = table._pruned(table._raw(), table._touched(rows)[1], rows)
        return {r["k"] for r in found.collect()}, found._jdf.queryExecution().optimizedPlan().toString()

    rows, plan = pruned([0, 1, 10, 11])
    assert rows == set(range(20)) and "Join" not in plan
    rows, plan = pruned([0, 11])
    assert rows == {*range(0, 10, 2), *range(11, 20, 2)} and "strategy=broadcast" in plan
    assert pruned([None, 4])[0] == {None, 0, 2, 4, 6, 8}
    gone = [0, 2, 4, 6, 8, 11, 30]  # a whole partition, parts of two others
    assert table.delete(spark.createDataFrame([(k,) for k in [*gone, 99, None]], "k long")) == 7
    assert {r["k"] for r in table.read().collect()} == {None, *range(40)} - set(gone)
    assert not (tmp_path / "t" / "tens=0" / "odd=0").exists()
    assert table.delete(spark.createDataFrame([(99,)], "k long")) == 0
