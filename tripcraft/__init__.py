"""tripcraft: trip-event analytics as Spark DataFrame jobs.

Trip starts and ends arrive as CSV files or keyed JSON events; they are
validated, normalised, joined or merged per ``trip_id``, and summarised into
daily fare KPIs, in batch and in Structured Streaming, with built-in Spark
expressions only.
"""

__version__ = "0.1.0"
