"""L1: the batch path from trip CSV files to daily KPIs.

starts, ends (S1) -> P1, P2 -> J1 -> V5 -> A1 (by pickup day).

The KPIs are computed with ``kpis_over_join``: ends are reduced to one row per
trip before the join, so the join emits one row per start instead of one per
(start, end) pair, and a trip id repeated a million times costs a million
rows, not a trillion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripcraft.operators.assemble import join_trips
from tripcraft.operators.kpis import kpis_over_join
from tripcraft.operators.normalize import normalize_ends, normalize_starts
from tripcraft.operators.validate import completed
from tripcraft.schemas import TRIP_END, TRIP_START
from tripcraft.sinks.parquet import write_outputs
from tripcraft.sources.csv import read_trips_csv


def batch_outputs(starts: DataFrame, ends: DataFrame) -> dict[str, DataFrame]:
    s = normalize_starts(starts)
    e = normalize_ends(ends)
    return {
        "completed_trips": completed(join_trips(s, e)),
        "daily_kpis": kpis_over_join(s, e, by="pickup", completed_only=True),
    }


def run_batch(
    spark: SparkSession,
    start_path: str,
    end_path: str,
    out_base: str | None = None,
    infer_schema: bool = False,
) -> dict[str, DataFrame]:
    """Run L1. With ``out_base`` the outputs are written (K1) as well."""
    starts = read_trips_csv(spark, start_path, None if infer_schema else TRIP_START)
    ends = read_trips_csv(spark, end_path, None if infer_schema else TRIP_END)
    outputs = batch_outputs(starts, ends)
    if out_base:
        write_outputs(outputs, out_base)
    return outputs
