"""Streaming measurement upsert (H1-H8).

The streaming part of the plan is stateless (decode, parse); everything that
aggregates -- dedupe, constraint checks, upsert, counts -- runs per
micro-batch inside ``foreachBatch`` on a batch persisted once.

* H1 append output mode, H3 required checkpoint, H4 default trigger or
  ``availableNow`` for backfills/tests, H5 ``earliest`` offsets by default.
* H2/H8 each batch writes a metrics row ``(batch_id, rows, inserts, updates, stale,
  quarantined, released, rejected, end_seen, ended, offsets)``, the last being the
  greatest offset read of each of the topic's ``partitions``; metrics, quarantine and table writes are keyed by
  ``batch_id`` so a replayed batch overwrites instead of duplicating.
* With a table that has an order, the message order is stored with each row and
  an older message never replaces a newer one (``stale``).
* ``views`` follow the changes of the table; ``store`` holds rows whose parents are
  missing, and each batch takes back those whose parents have come (``released``).
* H6 every topic partition ends with a record ``{"end": true}``.  The sink
  collects the partitions that have ended, over batches and restarts; only
  when ``partitions`` of them have does the caller stop the query, after that
  batch has committed (``await_and_stop``).
* Parents of foreign keys are read anew for each batch, so rows the dimension
  job has written meanwhile count, and files it has replaced are not missed.
* Messages that give no row are stored with their text and the reason.
* Errors are not swallowed: a failing batch fails the query and is replayed
  from the checkpoint on restart (its offsets are not committed).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorflow.operators.constraints import validate
from sensorflow.operators.dedupe import dedupe_by_key
from sensorflow.plans.common import MSG_ORDER
from sensorflow.plans.measurements import (MEASUREMENT_COLUMNS, parse_measurements, rejected_messages,
                                           typed_measurements)
from sensorflow.schemas import MEASUREMENT_TABLE, MESSAGES, MessageSchemas
from sensorflow.session import path_exists
from sensorflow.sources.envelope import decode_value, kafka_stream_source
from sensorflow.sources.jdbc import JdbcUpsertSink
from sensorflow.sources.keyed_table import KeyedTable, VersionedTable
from sensorflow.sources.quarantine import QuarantineStore
from sensorflow.streaming.views import AggregateView, LatestView, SketchView

METRICS_DDL = ("batch_id bigint, rows bigint, inserts bigint, updates bigint, stale bigint, "
               "quarantined bigint, released bigint, rejected bigint, end_seen boolean, ended array<int>, "
               "offsets map<int,bigint>")
#: a frame that does not change, or what gives the current one
Parent = DataFrame | KeyedTable | JdbcUpsertSink | Callable[[], DataFrame]


def current(parent: Parent) -> DataFrame:
    if isinstance(parent, DataFrame):
        return parent
    return parent() if callable(parent) else parent.read()


class MeasurementUpsert:
    """``foreachBatch`` body for parsed measurement messages.

    ``table`` is any sink with ``upsert``; ``partitions`` is the number of
    topic partitions that must end before the stream has."""

    def __init__(self, spark: SparkSession, table: KeyedTable | VersionedTable | JdbcUpsertSink,
                 metrics_path: str | None = None, quarantine_path: str | None = None,
                 parents: dict[str, Parent] | None = None, local_mode: str = "wall_clock",
                 rejects_path: str | None = None, partitions: int = 1,
                 views: list[AggregateView | LatestView | SketchView] | None = None, store: QuarantineStore | None = None):
        self.spark, self.table = spark, table
        self.views, self.store = views or [], store
        self.order = MSG_ORDER if getattr(table, "order", None) else []
        if self.views and not getattr(table, "changes_path", None):
            raise ValueError("views follow a table that records its changes")
        self.metrics_path, self.quarantine_path = metrics_path, quarantine_path
        self.rejects_path, self.partitions = rejects_path, partitions
        self.parents, self.local_mode = parents, local_mode
        self.ended: set[int] = self._ended_before()
        self.end_batch_id: int | None = None
        self.last_metrics: dict | None = None

    def _ended_before(self) -> set[int]:
        """Partitions that ended in batches before a restart."""
        if not self.metrics_path or not path_exists(self.spark, self.metrics_path):
            return set()
        rows = self.spark.read.parquet(self.metrics_path).select(F.explode("ended").alias("p")).distinct()
        return {r["p"] for r in rows.collect()}  # at most the topic's partitions

    @property
    def end_seen(self) -> bool:
        return len(self.ended) >= self.partitions

    def _store(self, df: DataFrame, batch_id: int, path: str) -> None:
        """Replaces what an earlier try of the batch has stored."""
        (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        batch_id = int(batch_id)
        # markers are observed by the job that fills the cache of the typed rows
        obs = Observation(f"measurement_batch_{batch_id}_{uuid.uuid4().hex}")
        observed = batch_df.observe(
            obs, F.collect_set(F.when(F.col("data.end").isNotNull(), F.col("_partition"))).alias("ended"),
            *[F.max(F.when(F.col("_partition") == p, F.col("_offset"))).alias(f"o{p}") for p in range(self.partitions)])
        typed = typed_measurements(observed, self.local_mode).persist()
        try:
            n, bad = typed.agg(F.count_if(F.col("_reject").isNull()),
                               F.count_if(F.col("_reject").isNotNull())).first()
            seen = obs.get
            ended = sorted(int(p) for p in (seen.get("ended") or []))
            offsets = {p: int(seen[f"o{p}"]) for p in range(self.partitions) if seen.get(f"o{p}") is not None}
            inserts = updates = stale = quarantined = released = 0
            if bad and self.rejects_path and "_raw" in typed.columns:
                self._store(rejected_messages(typed), batch_id, self.rejects_path)
            parents = {k: current(v) for k, v in (self.parents or {}).items()}
            ready = self.store.ready(MEASUREMENT_TABLE, parents) if self.store else None
            if n or ready:
                rows = typed.filter(F.col("_reject").isNull()).select(*MEASUREMENT_COLUMNS, *MSG_ORDER)
                if ready:
                    rows = rows.unionByName(ready.rows(rows.schema))
                deduped = dedupe_by_key(rows, "latest_id", MSG_ORDER)
                # the order of a message goes with its row into the table and into quarantine
                deduped = deduped.select(*MEASUREMENT_COLUMNS, *(MSG_ORDER if self.order or self.store else []))
                total = n + (ready.count if ready else 0)
                checked = validate(deduped, MEASUREMENT_TABLE, parents, cache=True,
                                   unique_key=True, rows_hint=total)
                valid, quarantine = checked
                try:
                    quarantined = checked.rejected()
                    if quarantined and self.quarantine_path:
                        self._store(quarantine, batch_id, self.quarantine_path)
                    valid = valid.select(*MEASUREMENT_COLUMNS, *self.order)
                    inserts, updates = self.table.upsert(valid, source_rows=total, batch_id=batch_id)
                    stale = getattr(self.table, "stale", 0)
                    # views and quarantine have tables of their own: their jobs run side by side
                    rest = [lambda v=v: v.apply(self.table.changes(batch_id), self.table, batch_id) for v in self.views]
                    if self.store:
                        rest.insert(0, lambda: self.store.settle(MEASUREMENT_TABLE, checked, ready))
                    if rest:
                        with ThreadPoolExecutor(len(rest)) as pool:
                            done = [f.result() for f in [pool.submit(inheritable_thread_target(self.spark)(r)) for r in rest]]
                        released = done[0] if self.store else 0
                finally:
                    checked.release()
        finally:
            typed.unpersist()
        before = self.end_seen
        self.ended |= set(ended)
        if self.end_seen and not before:
            self.end_batch_id = batch_id
        self.last_metrics = {"batch_id": batch_id, "rows": int(n), "inserts": int(inserts), "updates": int(updates),
                             "stale": int(stale), "quarantined": int(quarantined), "released": int(released),
                             "rejected": int(bad), "end_seen": bool(ended), "ended": ended, "offsets": offsets}
        if self.metrics_path:
            row = self.spark.createDataFrame([tuple(self.last_metrics.values())], METRICS_DDL)
            self._store(row.drop("batch_id"), batch_id, self.metrics_path)


def start_measurement_stream(envelope_stream: DataFrame, sink: MeasurementUpsert, checkpoint: str,
                             available_now: bool = False, query_name: str | None = None,
                             schemas: MessageSchemas = MESSAGES) -> StreamingQuery:
    """Start decode -> parse -> ``foreachBatch(sink)``; ``checkpoint`` is required."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    parsed = parse_measurements(decode_value(envelope_stream), schemas, keep_raw=bool(sink.rejects_path))
    writer = (parsed.writeStream.foreachBatch(sink).outputMode("append")
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def await_and_stop(query: StreamingQuery, sink: MeasurementUpsert | None = None,
                   timeout: float | None = None, poll: float = 1.0) -> None:
    """H7: wait until the query ends or the batch in which the last partition
    ended has committed (its progress is reported); always stop the query;
    re-raise its error.  When ``timeout`` seconds pass first, the stream is
    incomplete: the query is stopped and ``TimeoutError`` raised."""
    deadline = None if timeout is None else time.monotonic() + timeout
    late = False
    try:
        while query.isActive:
            if sink is not None and sink.end_seen:
                progress = query.lastProgress
                done = progress.get("batchId", -1) if progress else -1
                if sink.end_batch_id is None or done >= sink.end_batch_id:
                    break
            if deadline is not None and time.monotonic() > deadline:
                late = True
                break
            query.awaitTermination(poll)
    finally:
        query.stop()
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")
    if late:
        raise TimeoutError(f"stream not complete after {timeout} s; its checkpoint holds what was committed")


def measurement_job(spark: SparkSession, sink: MeasurementUpsert, checkpoint: str, topic: str = "measurements",
                    bootstrap_servers: str | None = None, source: Callable[[], DataFrame] | None = None,
                    available_now: bool = False, timeout: float | None = None,
                    schemas: MessageSchemas = MESSAGES, **options) -> None:
    """The streaming job from topic to table: starts the stream on the brokers
    (or on ``source()``) and returns once every partition has ended, or, with
    ``available_now``, once what is there has been read."""
    stream = source() if source else kafka_stream_source(spark, bootstrap_servers, topic, **options)
    query = start_measurement_stream(stream, sink, checkpoint, available_now, topic, schemas)
    await_and_stop(query, sink, timeout)
