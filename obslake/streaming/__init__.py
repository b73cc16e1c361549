"""Structured Streaming forms of the scheduled jobs (STR-1..4)."""

from obslake.streaming.ingest import dedupe_stream, first_wins_stream, start_load_stream  # noqa: F401
from obslake.streaming.first_seen import first_seen_stream, start_first_seen_stream  # noqa: F401
from obslake.streaming.score import start_score_stream  # noqa: F401
from obslake.streaming.completeness import batch_completeness  # noqa: F401
from obslake.streaming.reports import start_report_stream  # noqa: F401
