"""Structured Streaming: measurement messages -> keyed table, per micro-batch."""
