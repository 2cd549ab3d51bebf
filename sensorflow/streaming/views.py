"""Marts that follow the fact table (J2-J4), batch by batch.

A view reads the changes that a batch made to the table (``KeyedTable.changes``)
and never the batch itself, so a row delivered twice counts once and a
corrected one counts with its last value.

``AggregateView`` stores partial aggregates per group.  A batch's changes are
first summed per group: new images add, replaced ones are taken back.  Count
and sum follow from that; a group's least and greatest value only if none of
the values taken back was the extreme.  For the groups that lost theirs it is
computed anew from the table, of which only the partitions they lie in are
read.  The work of a batch grows with its changes, not with the table.

Views are keyed tables with a record of their own: a replayed batch applies what
it had decided, and does not add its changes again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.casts import instant_to_utc_ntz
from sensorflow.operators.joins import fits_broadcast
from sensorflow.plans.distributions import merged, sketched
from sensorflow.plans.marts import time_bucket
from sensorflow.session import discard, materialize
from sensorflow.sources.keyed_table import KeyedTable

SUMS = ("n", "n_values", "n_nan", "n_up", "n_down", "total")


def partials(rows: DataFrame, group: dict[str, Column], value: Column, sign: Column) -> DataFrame:
    """``SUMS`` per group, and the extremes of what comes in and goes out.

    ``n`` counts rows, ``n_values`` those with a value; NaN and infinities are
    counted apart, since they could not be taken back out of a sum."""
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    def count(when: Column) -> Column:
        return F.sum(F.when(when, sign).otherwise(0)).cast("bigint")

    comes = sign > 0
    return rows.groupBy(*[c.alias(name) for name, c in group.items()]).agg(
        F.sum(sign).cast("bigint").alias("n"), count(value.isNotNull()).alias("n_values"),
        count(F.isnan(value)).alias("n_nan"), count(value == float("inf")).alias("n_up"),
        count(value == float("-inf")).alias("n_down"), F.sum(F.when(finite, sign * value).otherwise(0.0)).alias("total"),
        F.min(F.when(comes, value)).alias("lo_in"), F.max(F.when(comes, value)).alias("hi_in"),
        F.min(F.when(~comes, value)).alias("lo_out"), F.max(F.when(~comes, value)).alias("hi_out"))


def finished(df: DataFrame) -> DataFrame:
    """``n, min_value, avg_value, max_value, sum_value`` from partials, as SQL's
    aggregates give them: NaN and infinities show in sum and average."""
    nan = F.lit(float("nan"))
    total = (F.when((F.col("n_nan") > 0) | ((F.col("n_up") > 0) & (F.col("n_down") > 0)), nan)
             .when(F.col("n_up") > 0, F.lit(float("inf"))).when(F.col("n_down") > 0, F.lit(float("-inf")))
             .when(F.col("n_values") > 0, F.col("total")))
    return df.withColumns({"min_value": F.col("lo"), "max_value": F.col("hi"), "sum_value": total,
                           "avg_value": F.try_divide(total, F.col("n_values"))}).drop(*SUMS[1:], "lo", "hi")


class AggregateView:
    """Count, sum, least and greatest of ``value`` per ``group`` (name to column
    over the table's rows, not NULL).

    ``partition_by`` lays out the view by columns of its group; ``within`` maps
    partition columns of the source table to columns of the group, so that
    lost extremes are looked for only there."""

    def __init__(self, spark: SparkSession, path: str, group: dict[str, Column], value: str = "value",
                 partition_by: dict[str, Column] | None = None, buckets: int | None = None,
                 within: dict[str, Column] | None = None):
        self.spark, self.group, self.value, self.within = spark, group, value, within or {}
        self.table = KeyedTable(spark, f"{path}/rows", list(group), partition_by=partition_by, buckets=buckets,
                                changes_path=f"{path}/changes")
        self.recomputed = 0  # groups whose extremes the last batch made lost

    def apply(self, changes: DataFrame, source: KeyedTable, batch_id: int) -> None:
        """Brings the view up to the batch's ``changes``, which ``source``
        already holds."""
        if self.table.recorded(batch_id):
            self.table.replay(batch_id)
            return
        keys = list(self.group)
        images = changes.select(F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("r")),
                                                  F.struct(F.lit(-1).alias("sign"), F.col("old").alias("r")))).alias("i"))
        images = images.filter("i.r IS NOT NULL").select("i.r.*", F.col("i.sign").alias("__sign"))
        delta = partials(images, self.group, F.col(self.value), F.col("__sign"))
        if self.table.exists():
            stored = self.table.read().select(*keys, *[F.col(c).alias(f"s_{c}") for c in (*SUMS, "lo", "hi")])
            merged = delta.join(stored, keys, "left")
        else:
            none = {f"s_{c}": F.lit(None).cast("double" if c in ("total", "lo", "hi") else "bigint") for c in (*SUMS, "lo", "hi")}
            merged = delta.withColumns(none)
        # a value taken back was the extreme, and none as extreme came in
        lost = (F.coalesce((F.col("lo_out") <= F.col("s_lo")) & ~F.coalesce(F.col("lo_in") <= F.col("s_lo"), F.lit(False)), F.lit(False))
                | F.coalesce((F.col("hi_out") >= F.col("s_hi")) & ~F.coalesce(F.col("hi_in") >= F.col("s_hi"), F.lit(False)), F.lit(False)))
        merged = materialize(merged.select(
            *keys, *[(F.coalesce(f"s_{c}", F.lit(0)) + F.col(c)).alias(c) for c in SUMS],
            F.least("s_lo", "lo_in").alias("lo"), F.greatest("s_hi", "hi_in").alias("hi"), lost.alias("__lost")), "delta")
        changed, self.recomputed = merged.agg(F.count(F.lit(1)), F.count_if("__lost")).first()
        rows = merged.drop("__lost")
        if self.recomputed:
            again = merged.filter("__lost").select(*keys)
            rows = rows.join(self._extremes(source, again, self.recomputed), keys, "left").select(
                *keys, *SUMS, *[F.when(F.col("__again"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in ("lo", "hi")])
        self.table.upsert(rows, source_rows=changed, batch_id=batch_id)
        discard(merged)

    def _extremes(self, source: KeyedTable, groups: DataFrame, count: int) -> DataFrame:
        rows = source.read(with_partition_cols=True)
        for column, value in self.within.items():
            values = [r["v"] for r in groups.select(value.alias("v")).distinct().collect()]  # partitions, not groups
            rows = rows.filter(F.col(column).isin(values))
        keyed = rows.select(*[c.alias(k) for k, c in self.group.items()], F.col(self.value).alias("__v"))
        wanted = F.broadcast(groups) if fits_broadcast(groups, list(self.group), count) else groups
        return keyed.join(wanted, list(self.group), "left_semi").groupBy(*self.group).agg(
            F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.lit(True).alias("__again"))

    def partials(self) -> DataFrame:
        """The stored partial aggregates; groups that lost all rows are left out."""
        return self.table.read().filter("n > 0")

    def read(self) -> DataFrame:
        """One row per group, as ``dimension_stats`` gives it."""
        return finished(self.partials())

    def rolled_up(self, by: list[str], df: DataFrame | None = None) -> DataFrame:
        """Statistics per ``by`` from the partials, joined by the caller with
        whatever holds the columns of ``by``."""
        df = self.partials() if df is None else df
        return finished(df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS], F.min("lo").alias("lo"), F.max("hi").alias("hi")))


class LatestView:
    """The row of greatest ``order`` per ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: list[str], buckets: int):
        self.key, self.order = key, order
        self.table = KeyedTable(spark, f"{path}/rows", key, buckets=buckets, order=order, changes_path=f"{path}/changes")

    def apply(self, changes: DataFrame, source: KeyedTable, batch_id: int) -> None:
        if self.table.recorded(batch_id):
            self.table.replay(batch_id)
            return
        row = F.max_by(F.col("new"), F.struct(*[F.col(f"new.{c}") for c in self.order]))
        newest = changes.groupBy(F.col(f"new.{self.key}").alias("__key")).agg(row.alias("r")).select("r.*")
        self.table.upsert(newest, batch_id=batch_id)

    def read(self) -> DataFrame:
        return self.table.read()


class SketchView:
    """Mergeable sketches per ``by`` and day.  ``add`` gives the table's rows the
    columns of ``by`` (a join with dimensions that are as they are).

    Sketches cannot give a value back: days of which a batch only adds rows
    are merged with sketches of these; days in which it replaced a row are
    sketched anew from the table's partitions of these days."""

    def __init__(self, spark: SparkSession, path: str, by: list[str], add: Callable[[DataFrame], DataFrame],
                 source_day: str = "day"):
        self.spark, self.by, self.add, self.source_day = spark, [*by, "day"], add, source_day
        self.table = KeyedTable(spark, f"{path}/rows", self.by, partition_by={"_day": F.col("day")}, changes_path=f"{path}/changes")

    def apply(self, changes: DataFrame, source: KeyedTable, batch_id: int) -> None:
        if self.table.recorded(batch_id):
            self.table.replay(batch_id)
            return
        day = F.to_date(instant_to_utc_ntz(F.col("timestamp_utc")))
        new = changes.select("op", "new.*").withColumn("day", day)
        old_days = changes.filter("op = 'update'").select("old.*").select(day.alias("day"))
        again = sorted(r["day"] for r in new.filter("op = 'update'").select("day").union(old_days).distinct().collect())
        fresh = new.drop("op") if not again else new.filter(~F.col("day").isin(again)).drop("op")
        parts = sketched(self.add(fresh), self.by)
        if self.table.exists():
            groups = parts.select(*self.by)
            parts = parts.unionByName(self.table.read().join(groups, self.by, "left_semi"))
        rows = merged(parts, self.by)
        if again:
            whole = source.read(with_partition_cols=True).filter(F.col(self.source_day).isin(again))
            rows = rows.unionByName(sketched(self.add(whole.drop(*source.partition_cols).withColumn("day", day)), self.by))
        rows = materialize(rows, "sketches")
        self.table.upsert(rows, batch_id=batch_id)
        discard(rows)

    def read(self, by: list[str]) -> DataFrame:
        """Sketches merged to ``by``."""
        return merged(self.table.read(), by)


def hourly(spark: SparkSession, path: str, buckets: int, source_day: str | None = "day") -> AggregateView:
    """Measurements per location, sensor and hour: the series of J3 as it is, and
    J2 rolled up.  Laid out by day, so that a batch rewrites the days it
    touches; ``source_day`` names the table's own partition by UTC day."""
    day = F.to_date("bucket")
    group = {"location_id": F.col("location_id"), "sensor_id": F.col("sensor_id"), "bucket": time_bucket(F.col("timestamp_utc"), "hour")}
    return AggregateView(spark, path, group, partition_by={
        "day": day, "_bucket": F.pmod(F.xxhash64("location_id", "sensor_id"), F.lit(buckets))},
        within={source_day: day} if source_day else None)
