"""Fare KPIs.

``count_trips`` counts non-null fares (not rows), ``average_fare`` is their
mean, and a null date forms its own group, exactly as ``groupBy`` does. Every
KPI is a partial + final hash aggregate: each task combines its rows per day
before the shuffle, so a day holding a third of all trips costs one row per
task in the exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcraft.operators.validate import Checked, completed

FARE = "fare_amount"


def kpi_aggs(fare: str = FARE) -> list[Column]:
    f = F.col(fare)
    return [
        F.sum(f).alias("total_fare"),
        F.count(f).alias("count_trips"),
        F.avg(f).alias("average_fare"),
        F.max(f).alias("max_fare"),
        F.min(f).alias("min_fare"),
    ]


def fare_kpis(df: DataFrame, *keys: str | Column, fare: str = FARE) -> DataFrame:
    """A0: total, count (non-null fares), average, maximum and minimum per key."""
    return df.groupBy(*keys).agg(*kpi_aggs(fare))


def daily_kpis_completed_by_pickup(trips: DataFrame) -> DataFrame:
    """A1: completed trips, grouped by pickup date."""
    return fare_kpis(completed(trips), "pickup_datetime")


def daily_kpis_all(trips: DataFrame) -> DataFrame:
    """A2: all trips, grouped by pickup date."""
    return fare_kpis(trips, "pickup_datetime")


def _dropoff_key(grain: str) -> Column:
    d = F.col("dropoff_datetime")
    if grain == "day":
        return F.to_date(d)
    if grain == "raw":
        return d
    raise ValueError(f"grain must be 'day' or 'raw', got {grain!r}")


def daily_kpis_completed_by_dropoff(trips: DataFrame, grain: str = "day") -> DataFrame:
    """A3 + P7: completed trips by drop-off day, key named ``DAY``.

    ``grain='raw'`` groups by the drop-off value as stored (the event path's
    job grouped full timestamps), ``'day'`` by its calendar date.
    """
    return fare_kpis(completed(trips), _dropoff_key(grain).alias("DAY"))


# --- KPIs over the J1 join without materialising the pairs ------------------------


def kpis_over_join(
    starts: DataFrame,
    ends: DataFrame,
    by: str = "pickup",
    completed_only: bool = True,
    grain: str = "day",
    key: str = "trip_id",
) -> DataFrame:
    """The A1/A2/A3 result over ``join_trips(starts, ends)``, computed linearly.

    The inner join repeats every start of a key for every end of that key. A
    fare KPI over those pairs only needs, per key, how many starts there are
    (or the sums of the ends), so both sides are reduced before the join: the
    one that carries the grouping key to one row per ``trip_id`` and day, the
    other to one row per ``trip_id``. Both aggregate partially before their
    shuffle, so a key holding a third of all rows neither squares nor fills one
    task: it sends one row per day from each task. Totals are sums of per-key products and equal
    the pair-wise result up to floating-point summation order.

    ``by='pickup'`` groups by the start's ``pickup_datetime`` (A1, or A2 with
    ``completed_only=False``); ``by='dropoff'`` by the end's drop-off ``DAY``.
    """
    if completed_only:
        ends = completed(ends)
    fare = F.col(FARE)
    if by == "pickup":
        per_key = ends.groupBy(key).agg(
            F.sum(fare).alias("_sum"),
            F.count(fare).alias("_cnt"),
            F.max(fare).alias("_max"),
            F.min(fare).alias("_min"),
        )
        rows = starts.groupBy(key, F.col("pickup_datetime").alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        joined = rows.join(per_key, key, "inner")
        weight = F.col("_n")
        out_key = "pickup_datetime"
    elif by == "dropoff":
        per_key = starts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        rows = ends.groupBy(key, _dropoff_key(grain).alias("_k")).agg(
            F.sum(fare).alias("_sum"),
            F.count(fare).alias("_cnt"),
            F.max(fare).alias("_max"),
            F.min(fare).alias("_min"),
        )
        joined = rows.join(per_key, key, "inner")
        weight = F.col("_n")
        out_key = "DAY"
    else:
        raise ValueError(f"by must be 'pickup' or 'dropoff', got {by!r}")
    total = F.sum(F.col("_sum") * weight)
    count = F.sum(F.col("_cnt") * weight)
    return joined.groupBy(F.col("_k").alias(out_key)).agg(
        total.alias("total_fare"),
        count.cast("bigint").alias("count_trips"),
        F.when(count > 0, total / count).alias("average_fare"),
        F.max("_max").alias("max_fare"),
        F.min("_min").alias("min_fare"),
    )


# --- A4 ----------------------------------------------------------------------------


def run_report(*stages: Checked) -> DataFrame:
    """A4: processed / failed counts per stage and reason.

    Each stage is one aggregation over its own tagged rows (outcome, reason),
    unioned; no row reaches the driver.
    """
    return reduce(DataFrame.unionByName, [s.outcome_counts() for s in stages])


def rounded_kpis(df: DataFrame) -> DataFrame:
    """Round sums to cents and rebuild the mean from the rounded total.

    For comparisons only: floating-point sums depend on summation order, the
    library results themselves stay unrounded.
    """
    n = F.col("count_trips")
    return df.withColumns(
        {
            "total_fare": F.round("total_fare", 2),
            "average_fare": F.round(F.col("average_fare") * n, 2) / F.nullif(n, F.lit(0)),
        }
    )
