"""Sinks: Parquet outputs of the pipelines."""

from tripcraft.sinks.parquet import OUTPUT_NAMES, write_checked, write_outputs, write_parquet
from tripcraft.sinks.versions import current, publish, read_published, write_together

__all__ = [
    "OUTPUT_NAMES",
    "current",
    "publish",
    "read_published",
    "write_checked",
    "write_outputs",
    "write_parquet",
    "write_together",
]
