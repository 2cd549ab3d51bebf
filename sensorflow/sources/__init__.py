"""Sources and sinks: message envelopes (Kafka or files), publishing back to
topics, landed API pages, keyed tables (parquet) and JDBC upserts."""
