"""Structured Streaming ingest (an extension; the batch day is the unit of work elsewhere)."""
