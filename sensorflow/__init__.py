"""sensorflow: composable PySpark operators that turn nested JSON sensor
messages into a validated, keyed star schema, in batch or as a stream.

Layout:
    sources/    envelopes (Kafka or files), keyed-table / JDBC sinks, publishing, API pages
    functions/  column-level helpers (JSON parsing, tolerant casts, keys)
    operators/  DataFrame -> DataFrame operators (explode, filters, joins, dedupe,
                aggregates, constraints, upsert)
    plans/      compositions: dimension jobs, measurement flow, ingestion, marts,
                and the driver query catalog
    streaming/  Structured Streaming runner (foreachBatch upsert with metrics)
"""

__version__ = "0.1.0"
