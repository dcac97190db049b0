"""Streaming ingestion of a landing folder (extension; see README)."""

from period_etl.streaming.landing_stream import compact_counts, process_batch, read_landing_stream, stream_landing

__all__ = ["compact_counts", "process_batch", "read_landing_stream", "stream_landing"]
