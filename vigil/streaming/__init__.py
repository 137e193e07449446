"""Structured Streaming: the anomaly pipeline and the line / word jobs as foreachBatch runners."""

from vigil.streaming.ledger import KeyedLog, Ledger, committed_output
from vigil.streaming.runner import AnomalyStream, with_answers
from vigil.streaming.jobs import BatchHeaders, LineJobs, SqlJobs, WordCounts, console

__all__ = ["AnomalyStream", "KeyedLog", "Ledger", "committed_output", "with_answers", "BatchHeaders", "LineJobs", "SqlJobs", "WordCounts", "console"]
