"""Scan of the assembled trips table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Read the trips table (Parquet). Filters and column selections of later
    operators reach the scan (pushed filters, pruned read schema)."""
    return spark.read.parquet(path)
