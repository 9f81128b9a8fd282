"""Structured Streaming ingest of new sensor files into the curated layer."""

from plantlens.streaming.ingest import (
    compact_rollup,
    sensor_stream,
    start_ingest,
    streamed_tables,
)

__all__ = ["compact_rollup", "sensor_stream", "start_ingest", "streamed_tables"]
