"""Structured Streaming jobs for live bars, signals, positions and summaries.

The reference's live mode polls the broker every minute and recomputes
everything; here each part is a streaming query with event-time state and
a checkpoint in the shared folder, so a restarted driver resumes where it
stopped.  Results land in an *upsert log*: every micro-batch writes the
rows it changed under its batch id (idempotent on replay), and readers take
the newest version of each key.
"""

from sessionbars.streaming.jobs import (
    read_latest, run_upsert_log, stream_account, stream_bars, stream_daily_summary, stream_exits,
    stream_mark_to_market, stream_positions, stream_signals, tick_stream,
)

__all__ = [
    "read_latest", "run_upsert_log", "stream_account", "stream_bars", "stream_daily_summary", "stream_exits",
    "stream_mark_to_market", "stream_positions", "stream_signals", "tick_stream",
]
