"""Sources: CSV files, producer lines, keyed events, the trips table."""

from tripcraft.sources.csv import check_trips_csv, read_trips_csv, write_trips_csv
from tripcraft.sources.event_log import EventLog
from tripcraft.sources.events import decode_events, encode_records, to_events
from tripcraft.sources.lines import parse_end_lines, parse_start_lines, read_lines, with_line_seq
from tripcraft.sources.trips import read_trips

__all__ = [
    "EventLog",
    "check_trips_csv",
    "decode_events",
    "encode_records",
    "parse_end_lines",
    "parse_start_lines",
    "read_lines",
    "read_trips",
    "read_trips_csv",
    "to_events",
    "with_line_seq",
    "write_trips_csv",
]
