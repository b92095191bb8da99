"""Structured Streaming form of the ingest (the questions themselves are batch)."""

from fleetlens.streaming.ingest import start_ingest_stream

__all__ = ["start_ingest_stream"]
