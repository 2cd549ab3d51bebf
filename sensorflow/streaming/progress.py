"""What a stream has done and how far it is behind (H7, H8)."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = ("query string, run_id string, batch_id bigint, started timestamp, input_rows bigint, rows_per_second double, "
            "trigger_ms bigint, add_batch_ms bigint, sources string")


class ProgressStore(StreamingQueryListener):
    """Keeps the progress of every batch until ``flush`` appends it to a table.

    Spark calls listeners on a thread of its own, where no job should be
    started; so rows wait here, and whoever runs the stream flushes."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path
        self._rows: list[tuple] = []
        self._lock = threading.Condition()
        self._open: set[str] = set()
        self.failed: str | None = None

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        spent = p.durationMs or {}
        row = (p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond,
               spent.get("triggerExecution"), spent.get("addBatch"),
               json.dumps([{"from": s.startOffset, "to": s.endOffset, "rows": s.numInputRows} for s in p.sources]))
        with self._lock:
            self._rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.failed = event.exception
        with self._lock:
            self._open.discard(str(event.runId))
            self._lock.notify_all()

    def settled(self, timeout: float = 30.0) -> bool:
        """Waits for the reports of the queries that have ended: they come after
        the queries' own calls return, a termination after all of its batches."""
        with self._lock:
            return self._lock.wait_for(lambda: not self._open, timeout)

    def flush(self) -> int:
        """Appends what has come since the last time; how many rows."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            text = self.spark.createDataFrame(rows, PROGRESS.replace("started timestamp", "started string"))
            text.withColumn("started", F.col("started").cast("timestamp")).write.mode("append").parquet(self.path)
        return len(rows)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def lag(metrics: DataFrame, bounds: DataFrame) -> DataFrame:
    """``batch_id, partition, read_to, behind``: after each batch of the metrics
    table, the offset up to which a partition has been read (exclusive) and how
    many offsets lie between it and the topic's high offset (``offset_bounds``).

    A partition of which nothing was read yet is behind by all it holds."""
    read = metrics.select("batch_id", F.explode_outer("offsets").alias("partition", "last"))
    batches = metrics.select("batch_id").distinct()
    # a row per batch and partition of the topic: as many as the metrics table itself has
    every = batches.withColumn("p", F.explode(F.array(*[F.struct(F.lit(r["partition"]).alias("partition"), F.lit(r["low"]).alias("low"),
                                                               F.lit(r["high"]).alias("high")) for r in bounds.collect()])))
    every = every.select("batch_id", "p.*")
    so_far = Window.partitionBy("partition").orderBy("batch_id")
    joined = every.join(read.filter("partition IS NOT NULL"), ["batch_id", "partition"], "left")
    to = F.coalesce(F.max("last").over(so_far) + 1, F.col("low"))
    return joined.select("batch_id", "partition", to.alias("read_to"), (F.col("high") - to).alias("behind"))
