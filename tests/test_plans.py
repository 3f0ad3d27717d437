"""Plan shape: the properties the scale design relies on, checked on real plans."""

from tripcraft.operators import assemble_trips, daily_kpis_completed_by_dropoff, kpis_over_join
from tripcraft.operators import normalize_ends, normalize_starts
from tripcraft.plans import queries as Q
from tripcraft.session import scratch_path
from tripcraft.sources import read_trips
from tripcraft.sources import supplied as S

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_kpi_job_scan_is_pruned_and_filtered(spark):
    path = scratch_path(spark, "plan-trips")
    assemble_trips(Q._trip_events(spark, SF), "replay").write.parquet(path)
    plan = _plan(daily_kpis_completed_by_dropoff(read_trips(spark, path)))
    assert "PushedFilters: [IsNotNull(dropoff_datetime)]" in plan
    assert "ReadSchema: struct<dropoff_datetime:timestamp_ntz,fare_amount:double>" in plan
    # Partial aggregate below the exchange, final above it.
    assert plan.index("partial_sum") > plan.index("Exchange")


def test_keyed_merge_aggregates_before_the_shuffle(spark):
    plan = _plan(assemble_trips(Q._trip_events(spark, SF), "replay"))
    assert plan.count("Exchange") == 1
    assert "partial_max" in plan and plan.index("partial_max") > plan.index("Exchange")
    assert "collect_list" not in plan and "Generate" not in plan


def test_kpis_over_join_never_joins_raw_pairs(spark):
    starts = normalize_starts(S.large_starts(spark, SF))
    ends = normalize_ends(S.large_ends(spark, SF))
    plan = _plan(kpis_over_join(starts, ends, by="pickup"))
    # The end side is reduced per trip (partial + final) before it meets the join.
    assert plan.count("HashAggregate") >= 4
    assert "partial_count" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_explicit_broadcast_hints(spark):
    df = Q.q_joined_trips(spark, SF)
    logical = df._jdf.queryExecution().logical().toString()
    assert "broadcast" not in logical.lower()
