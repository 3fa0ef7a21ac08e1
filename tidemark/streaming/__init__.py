"""Incremental work with Structured Streaming."""

from .ingest import ingest_batches, ingest_files
from .totals import add_totals, compact_totals, read_totals

__all__ = ["add_totals", "compact_totals", "ingest_batches", "ingest_files", "read_totals"]
