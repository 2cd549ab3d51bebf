"""Tables laid out by the key that later jobs group and join on.

Written once, bucketed and sorted by ``keys``, a table is read without a shuffle by
every aggregation whose grouping holds the keys, and by every join on them: only
the other side moves, into the table's buckets.  A dedupe, star join or upsert
repeated every day then shuffles what is new and not the history.

Bucketing lives in the session's catalog (the files are at ``path``).  One task
writes a bucket, so ``buckets`` grows with the table, and a key that holds a
large share of the rows makes its bucket as large: choose keys that spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.operators.dedupe import dedupe_by_key


class BucketedTable:
    def __init__(self, spark: SparkSession, name: str, path: str, keys: list[str], buckets: int):
        self.spark, self.name, self.path, self.keys, self.buckets = spark, name, path, list(keys), buckets

    def write(self, df: DataFrame) -> DataFrame:
        """Replaces the table; rows with a NULL key are kept.  The shuffle deals rows
        as buckets are numbered, so each bucket is one sorted file."""
        (df.repartition(self.buckets, *self.keys).sortWithinPartitions(*self.keys)
         .write.mode("overwrite").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
         .option("path", self.path).saveAsTable(self.name))
        return self.read()

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forgets the table; its files stay at ``path``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def newest(self, key: list[str], order: list[str]) -> DataFrame:
        """E1 without a shuffle: the last row per ``key``, whose columns must hold
        the table's (a key that determines them may simply name them too)."""
        if not set(self.keys) <= set(key):
            raise ValueError(f"key {key} does not hold the table's keys {self.keys}")
        return dedupe_by_key(self.read(), key, order, keep_null_keys=False)

    def join(self, other: DataFrame, how: str = "inner") -> DataFrame:
        """Join on the table's keys; ``other`` is brought into the buckets."""
        return self.read().join(other.hint("merge"), self.keys, how)

    def merged(self, source: DataFrame) -> DataFrame:
        """A5 on the table's keys: the rows after an upsert of ``source`` (unique on
        them), without moving the stored ones."""
        stored = self.read()
        both = (stored.select(*self.keys, F.struct(*stored.columns).alias("__o"))
                .join(source.select(*self.keys, F.struct(*stored.columns).alias("__s")).hint("merge"), self.keys, "full_outer"))
        return both.select(F.coalesce("__s", "__o").alias("r")).select("r.*")
