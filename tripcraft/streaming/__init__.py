"""Structured Streaming: the keyed trip table (J4), the whole event path, and the live trip store."""

from tripcraft.streaming.events import (
    RECEIVED,
    process_batch,
    read_stream_quarantine,
    read_stream_report,
    start_event_path,
    trace_received,
)
from tripcraft.streaming.store import TripStore
from tripcraft.streaming.trips import compact, read_event_stream, read_trip_table, start_trip_table

__all__ = [
    "RECEIVED",
    "TripStore",
    "compact",
    "process_batch",
    "read_event_stream",
    "read_stream_quarantine",
    "read_stream_report",
    "read_trip_table",
    "start_event_path",
    "start_trip_table",
    "trace_received",
]
