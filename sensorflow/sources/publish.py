"""Publishing tables back as messages (A8-A11, C7, E4 use).

Messages are built as envelope rows; they are written to Kafka or to a file
topic by the caller (``write_kafka`` / ``write_file_topic``).
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorflow.schemas import ENVELOPE
from sensorflow.session import path_exists
from sensorflow.sources.envelope import file_topic_source, to_envelope, write_file_topic

log = logging.getLogger(__name__)

END_MARKER = '{"end":true}'


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def publish_rows(df: DataFrame, topic: str, offset, timestamp=None, key=None,
                 partitions: int = 1) -> DataFrame:
    """One JSON object per row (NULL fields written as ``null``).

    ``offset`` must be unique per partition (a row id); ``key`` picks the
    partition as ``pmod(xxhash64(key), partitions)``.
    """
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    part = F.pmod(F.xxhash64(_c(key)), F.lit(partitions)) if key is not None else F.lit(0)
    return to_envelope(df, value, topic, key=_c(key) if key is not None else None,
                       partition=part, offset=_c(offset),
                       timestamp=_c(timestamp) if timestamp is not None else None)


COPY_BLOCK = 100_000


def bounded_chunks(df: DataFrame, group: list[str], max_rows: int, alias: str = "__chunk") -> DataFrame:
    """Chunk id per row so that each ``group`` is split into ``ceil(n / max_rows)``
    chunks of about ``max_rows`` rows, however hot the group.

    Equal rows are first counted (map-side combined) and get a copy number, so
    a row repeated any number of times is spread like others.  Chunks follow
    from a hash of row and copy number: a stage retry assigns the same ones.
    The counts per group are an aggregate, whose real size AQE measures before
    choosing the join.
    """
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    counts = rows.groupBy(*group).agg(F.sum("__copies").alias("__n"))
    blocks = F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / COPY_BLOCK))
    rows = rows.withColumn("__block", F.explode(blocks))
    left = F.col("__copies") - F.col("__block") * COPY_BLOCK
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.least(left, F.lit(COPY_BLOCK)).cast("int"))))
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(max_rows)))
    row_hash = F.xxhash64(*df.columns, "__block", "__copy")
    return (rows.join(counts, group).withColumn(alias, F.pmod(row_hash, n_chunks))
            .select(*df.columns, alias))


def publish_array(df: DataFrame, topic: str, group: list[str], chunk: Column, offset: str,
                  timestamp: str | None = None, payload: list[str] | None = None) -> DataFrame:
    """One JSON **array** message per ``group`` + ``chunk``.

    One message per group does not scale (one task parses it, and brokers cap
    message size), so ``chunk`` must bound the rows per message, e.g.
    ``floor(row_id / 1000)``.  Element order is sorted for determinism; the
    message offset is the smallest ``offset`` of its rows.
    """
    cols = payload or [c for c in df.columns]
    grouped = (df.withColumn("__chunk", chunk)
               .groupBy(*group, "__chunk")
               .agg(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in cols]))).alias("__items"),
                    F.min(offset).alias("__offset"),
                    (F.max(timestamp) if timestamp else F.current_timestamp()).alias("__ts")))
    return to_envelope(grouped, F.to_json("__items", {"ignoreNullFields": "false"}), topic,
                       offset=F.col("__offset"), timestamp=F.col("__ts"))


def end_markers(envelope: DataFrame, marker: str = END_MARKER) -> DataFrame:
    """A control record ``{"end": true}`` for every topic partition of
    ``envelope``, at the offset after its last record (one grouped aggregate)."""
    return (envelope.groupBy("topic", "partition")
            .agg((F.max("offset") + 1).alias("offset"), F.max("timestamp").alias("timestamp"))
            .select(F.lit(None).cast("binary").alias("key"), F.lit(marker).cast("binary").alias("value"),
                    "topic", "partition", "offset", "timestamp", F.lit(0).alias("timestampType")))


def append_end_marker(envelope: DataFrame, marker: str = END_MARKER) -> DataFrame:
    """A11 on a file topic, whose readers order records by offset."""
    return envelope.unionByName(end_markers(envelope, marker))


def publish_then_end(envelope: DataFrame, write: Callable[[DataFrame], None], marker: str = END_MARKER,
                     partitions: int = 64) -> None:
    """A11 on a broker, where order is order of arrival: ``write`` all data
    records, and once they are stored the markers, partition by partition.

    The last offsets are observed by the one write of the data, so the markers fit
    what was written and the data is computed once.  ``partitions`` bounds the
    partitions that are observed; records of more, or of several topics, are
    aggregated after the write instead.  Nothing written, no marker."""
    obs = Observation(f"publish_{uuid.uuid4().hex}")
    here = [F.col("partition") == p for p in range(partitions)]
    write(envelope.observe(
        obs, F.collect_set("topic").alias("topics"), F.min("partition").alias("lowest"), F.max("partition").alias("highest"),
        *[F.max(F.when(c, F.col("offset"))).alias(f"o{p}") for p, c in enumerate(here)],
        *[F.max(F.when(c, F.col("timestamp"))).alias(f"t{p}") for p, c in enumerate(here)]))
    seen = obs.get
    if len(seen["topics"]) > 1 or (seen["highest"] or 0) >= partitions or (seen["lowest"] or 0) < 0:
        write(end_markers(envelope, marker))
        return
    rows = [(None, marker.encode(), seen["topics"][0], p, seen[f"o{p}"] + 1, seen[f"t{p}"], 0)
            for p in range(partitions) if seen.get(f"o{p}") is not None]
    if rows:
        write(envelope.sparkSession.createDataFrame(rows, ENVELOPE))


def is_topic_empty(envelope: DataFrame) -> bool:
    """No partition has ``high > low`` -- i.e. the topic holds no record.
    Asked as "is there any record", which stops at the first one instead of
    aggregating offsets over the whole topic (``offset_bounds`` gives those)."""
    return envelope.select("offset").isEmpty()


def publish_to_empty_topic(messages: DataFrame, read: Callable[[], DataFrame],
                           write: Callable[[DataFrame], None]) -> bool:
    """A10 for any topic: ``write(messages)`` only when ``read()`` holds no
    record.  When the topic cannot be read nothing is published, since it may
    hold data.  Returns whether the messages were published."""
    try:
        empty = is_topic_empty(read())
    except Exception as e:  # whatever the source raises: unknown is not empty
        log.warning("topic not readable, nothing published: %s", e)
        return False
    if empty:
        write(messages)
    return empty


def publish_if_empty(spark: SparkSession, messages: DataFrame, path: str) -> bool:
    """A10 on the file topic at ``path``; a folder that is not there yet is an
    empty topic."""
    def read() -> DataFrame:
        return file_topic_source(spark, path) if path_exists(spark, path) else spark.createDataFrame([], ENVELOPE)

    return publish_to_empty_topic(messages, read, lambda m: write_file_topic(m, path, mode="append"))
