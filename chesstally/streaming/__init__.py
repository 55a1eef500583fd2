"""Structured Streaming ingestion into the by-source store; stateful running totals."""

from chesstally.streaming.ingest import BatchSize, BatchTimes, run_ingest, start_ingest
from chesstally.streaming.totals import start_running_totals

__all__ = ["BatchSize", "BatchTimes", "run_ingest", "start_ingest", "start_running_totals"]
