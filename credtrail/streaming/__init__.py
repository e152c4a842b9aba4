"""Incremental ingest of the input tables with Structured Streaming.

The reference loads its input CSV files in one batch; this package offers the
same load as an exactly-once file stream (``availableNow`` trigger), so new
drop files are picked up on the next run without re-reading old ones.
"""

from credtrail.streaming.ingest import ingest_stream

__all__ = ["ingest_stream"]
