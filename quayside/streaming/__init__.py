"""Streaming ingest of a landing tree into an append-only table."""

from quayside.streaming.ingest import IngestOptions, ingest_table, read_table

__all__ = ["IngestOptions", "ingest_table", "read_table"]
