"""A quarantine that empties itself.

Rows that break a rule are held under the digest of their JSON text, with the
rules and the parent keys that were missing.  Whoever writes a table first asks
for the rows that may come back: those which only lacked parents, and of whose
missing keys every one is stored by now (anti-joins of the missing keys, not of
the rows).  They are written with the new rows, checked again like these, and
leave the store after the table holds them.  Tables are written parent first, so
a row that comes back can bring its children back in the same run.

Every step may be repeated: a row is held once however often it is refused, and
a row that was written but not yet removed is written again as the same row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.operators.constraints import ROW_JSON, Checked
from sensorflow.operators.joins import orphan_keys
from sensorflow.schemas import TableSpec
from sensorflow.session import discard, materialize
from sensorflow.sources.keyed_table import KeyedTable

HELD = "table string, row_key string, rules array<string>, missing array<struct<parent:string,key:string>>, row_json string, copies bigint"


class Ready:
    """Rows that may come back: ``frame`` (``row_key, row_json``) and their ``count``."""

    def __init__(self, frame: DataFrame, count: int):
        self.frame, self.count = frame, count

    def rows(self, schema: T.StructType) -> DataFrame:
        """The rows with the columns of ``schema``; what a row did not have is NULL."""
        return self.frame.select(F.from_json("row_json", schema, ROW_JSON).alias("r")).select("r.*")


class QuarantineStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 1):
        self.spark = spark
        self.held = KeyedTable(spark, path, ["table", "row_key"], partition_by={
            "_table": F.col("table"), "_bucket": F.pmod(F.xxhash64("row_key"), F.lit(buckets))})

    def read(self, table: str | None = None) -> DataFrame:
        """``table, row_key, rules, missing, row_json, copies`` of the rows held."""
        df = self.held.read(with_partition_cols=True) if self.held.exists() else None
        if df is None:
            return self.spark.createDataFrame([], HELD)
        return (df if table is None else df.filter(F.col("_table") == table)).drop("_table", "_bucket")

    @staticmethod
    def refused(spec: TableSpec, checked: Checked) -> DataFrame:
        """Rows of ``checked`` that break a rule, as they are held; equal rows are one with ``copies``."""
        flagged = checked.flagged.filter(F.size("__rules") > 0)
        columns = [c for c in flagged.columns if not c.startswith("__")]
        gone = [F.when(F.array_contains("__rules", f"fk:{fk.column}->{fk.parent}"),
                       F.struct(F.lit(fk.parent).alias("parent"), F.col(fk.column).cast("string").alias("key")))
                for fk in spec.foreign_keys if fk.column in columns]
        missing = F.array_compact(F.array(*gone)) if gone else F.array()
        text = F.to_json(F.struct(*columns), ROW_JSON)
        rows = flagged.select(F.col("__rules").alias("rules"), missing.cast("array<struct<parent:string,key:string>>").alias("missing"),
                              text.alias("row_json"))
        return rows.groupBy("row_json").agg(F.first("rules").alias("rules"), F.first("missing").alias("missing"),
                                            F.count(F.lit(1)).alias("copies")).select(
            F.lit(spec.name).alias("table"), F.sha2("row_json", 256).alias("row_key"), "rules", "missing", "row_json", "copies")

    def ready(self, spec: TableSpec, parents: dict[str, DataFrame]) -> Ready | None:
        """Held rows of the table that lack nothing but parents which ``parents``
        (table name to rows) now has; ``None`` if there are none."""
        only_parents = F.forall("rules", lambda r: r.startswith("fk:"))
        held = self.read(spec.name).filter(only_parents)
        asked = held.select("row_key", F.explode("missing").alias("m"))
        count = asked.count()
        if not count:
            return None
        waiting = None
        for fk in spec.foreign_keys:
            mine = asked.filter(F.col("m.parent") == fk.parent).select("row_key", F.col("m.key").alias("key"))
            if fk.parent in parents:
                known = parents[fk.parent].select(F.col(fk.parent_column).cast("string").alias("key"))
                mine = mine.join(orphan_keys(mine, known, "key", "key", count).withColumnRenamed("__fk", "key"), "key", "left_semi")
            mine = mine.select("row_key")
            waiting = mine if waiting is None else waiting.unionByName(mine)
        rows = held.select("row_key", "row_json").join(waiting.distinct(), "row_key", "left_anti")
        frame = materialize(rows, "ready")  # the store changes before they are removed from it
        n = frame.count()
        if not n:
            discard(frame)
            return None
        return Ready(frame, n)

    def settle(self, spec: TableSpec, checked: Checked, ready: Ready | None = None) -> int:
        """Holds what ``checked`` refused, and lets the ``ready`` rows go that it
        did not refuse again; how many went."""
        refused = materialize(self.refused(spec, checked), "refused")
        n = refused.count()
        if n:
            self.held.upsert(refused, source_rows=n)
        went = 0
        if ready:
            went = self.held.delete(ready.frame.join(refused.select("row_key"), "row_key", "left_anti").select(
                F.lit(spec.name).alias("table"), "row_key"), keys_rows=ready.count)
            discard(ready.frame)
        discard(refused)
        return went
