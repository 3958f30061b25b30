"""Streaming ingest of a landing folder (file source, micro-batch gate)."""
