"""Structured Streaming: incremental ingest of landed source files."""

from .ingest import process_batch, run_ingest, start_ingest

__all__ = ["process_batch", "run_ingest", "start_ingest"]
