"""Message envelopes (A1-A3).

Every message source yields the Kafka source shape ``key, value, topic,
partition, offset, timestamp, timestampType`` -- from a broker, or from a
"file topic" (a parquet folder of envelope rows) used for fixtures, replays
and tests.  Operators downstream only see this shape, in batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.schemas import ENVELOPE


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                  **extra) -> dict:
    """Options of a Kafka read of one topic (extra options pass through, e.g.
    ``{"kafka.max.partition.fetch.bytes": ...}`` for 10 MB messages)."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_batch_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                       starting_offsets: str = "earliest", ending_offsets: str = "latest",
                       min_partitions: int | None = None, **extra) -> DataFrame:
    """A1: bounded read of a topic (earliest..latest by default).

    ``min_partitions`` splits topic partitions into more Spark tasks: JSON
    parsing is CPU-bound and a topic has few partitions (3 in the original
    deployment)."""
    if min_partitions:
        extra["minPartitions"] = min_partitions
    opts = kafka_options(bootstrap_servers, topic, starting_offsets,
                         endingOffsets=ending_offsets, **extra)
    return spark.read.format("kafka").options(**opts).load()


def kafka_stream_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                        starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                        min_partitions: int | None = None, **extra) -> DataFrame:
    """A2: unbounded read.  Defaults to ``earliest``: the upsert downstream is
    idempotent, so re-reading is safe while starting late can lose messages.

    ``max_offsets_per_trigger`` bounds each micro-batch, which keeps the
    batch-side broadcasts of the upsert and FK checks within their bound
    (and a backlog from turning into one giant batch)."""
    if max_offsets_per_trigger:
        extra["maxOffsetsPerTrigger"] = max_offsets_per_trigger
    if min_partitions:
        extra["minPartitions"] = min_partitions
    opts = kafka_options(bootstrap_servers, topic, starting_offsets, **extra)
    return spark.readStream.format("kafka").options(**opts).load()


def file_topic_source(spark: SparkSession, path: str, streaming: bool = False,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelope rows stored as parquet under ``path`` (batch or file stream)."""
    if not streaming:
        return spark.read.schema(ENVELOPE).parquet(path)
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def decode_value(envelope: DataFrame, keep: tuple[str, ...] = ("timestamp", "partition", "offset")) -> DataFrame:
    """A3: message bytes -> UTF-8 string ``value`` plus the envelope columns in ``keep``."""
    return envelope.select(F.col("value").cast("string").alias("value"), *keep)


def to_envelope(df: DataFrame, value: Column, topic: str, key: Column | None = None,
                partition: Column | None = None, offset: Column | None = None,
                timestamp: Column | None = None) -> DataFrame:
    """Wrap a text column as envelope rows (what a producer writes)."""
    return df.select(
        (key.cast("string").cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        (offset if offset is not None else F.lit(0)).cast("bigint").alias("offset"),
        (timestamp if timestamp is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_file_topic(envelope: DataFrame, path: str, mode: str = "append") -> None:
    """Append envelope rows to a file topic."""
    envelope.select(*ENVELOPE.fieldNames()).write.mode(mode).parquet(path)


def write_kafka(envelope: DataFrame, bootstrap_servers: str, topic: str, **extra) -> None:
    """A8 sink: write ``key, value`` to a Kafka topic, each record to the
    ``partition`` its envelope names."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update({k: str(v) for k, v in extra.items()})
    envelope.select("key", "value", "partition").write.format("kafka").options(**opts).save()
