"""Structured Streaming forms of ingestion, de-duplication, windows, series features and scoring."""

from .store import Store, run_store
from .stream import events_stream, ingest_stream, raw_stream, run_available_now, score_stream

__all__ = ["Store", "events_stream", "ingest_stream", "raw_stream", "run_available_now", "run_store", "score_stream"]
