"""L3: the KPI job over the assembled trips table.

trips (S6) -> completed (V5) -> all-trips KPIs by pickup day (A2),
completed-trips KPIs by drop-off day (A3 + P7) -> four Parquet outputs (K1).

The trips table is read from storage once per output; each output is a
column-pruned scan with the completed filter pushed to Parquet, so nothing is
recomputed upstream and no cache has to hold the table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tripcraft.operators.kpis import daily_kpis_all, daily_kpis_completed_by_dropoff
from tripcraft.operators.validate import completed
from tripcraft.sinks.parquet import write_outputs
from tripcraft.sinks.versions import write_together
from tripcraft.sources.trips import read_trips


def kpi_job_outputs(trips: DataFrame, grain: str = "day") -> dict[str, DataFrame]:
    return {
        "trips_copy": trips,
        "completed_trips": completed(trips),
        "all_trips_daily_kpis": daily_kpis_all(trips),
        "completed_trips_daily_kpis": daily_kpis_completed_by_dropoff(trips, grain),
    }


def _nested(a: str, b: str) -> bool:
    """Whether one of the folders is the other or lies in it (with or without a file scheme)."""
    a, b = (re.sub(r"/+", "/", p.removeprefix("file:")).rstrip("/") + "/" for p in (a, b))
    return a.startswith(b) or b.startswith(a)


def run_kpi_job(
    spark: SparkSession,
    trips_path: str,
    out_base: str,
    grain: str = "day",
    partition_by: dict[str, str] | None = None,
    completed_files: int | None = None,
    sort_by: str | None = None,
    even: bool = False,
    together: bool = False,
) -> dict[str, str]:
    """Run L3 and return the written paths.

    No output may be the input folder, hold it or lie in it: the outputs
    overwrite, and the trips are read while they are written.

    ``completed_files`` (R1) repartitions the completed trips by pickup date
    just before their write; it never sits in front of an aggregate. ``sort_by``
    (R2) and ``even`` are those of ``layout``. With ``together`` the four
    outputs change at once: they are written as a new version and published when all are
    there (``sinks.read_published``); until then readers keep the version before.
    """
    outputs = kpi_job_outputs(read_trips(spark, trips_path), grain)
    for name in outputs:
        if _nested(trips_path, f"{out_base.rstrip('/')}/{name}"):
            raise ValueError(f"output {name!r} under {out_base!r} would overwrite its input {trips_path!r}")
        if together and _nested(trips_path, out_base):
            raise ValueError(f"versions under {out_base!r} must not touch their input {trips_path!r}")
    layouts = {}
    if completed_files or sort_by or even:
        layouts["completed_trips"] = {"n": completed_files, "by": "pickup_datetime", "sort_by": sort_by, "even": even}

    def write(base: str) -> dict[str, str]:
        return write_outputs(outputs, base, partition_by=partition_by, layouts=layouts)

    return write_together(spark, out_base, write) if together else write(out_base)
