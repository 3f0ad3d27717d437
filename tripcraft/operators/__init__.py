"""DataFrame-in, DataFrame-out operators of the trip pipeline."""

from tripcraft.operators.assemble import (
    assemble_trips,
    join_trips,
    keyed_put,
    keyed_update,
)
from tripcraft.operators.kpis import (
    daily_kpis_all,
    daily_kpis_completed_by_dropoff,
    daily_kpis_completed_by_pickup,
    fare_kpis,
    kpis_over_join,
    rounded_kpis,
    run_report,
)
from tripcraft.operators.layout import layout
from tripcraft.operators.normalize import (
    conform,
    distinct_values,
    normalize_ends,
    normalize_start_events,
    normalize_starts,
    select_valid_fields,
)
from tripcraft.operators.validate import (
    Checked,
    completed,
    fully_described,
    mask_invalid,
    quarantine,
    require_any,
    require_key,
)

__all__ = [
    "Checked",
    "assemble_trips",
    "completed",
    "conform",
    "daily_kpis_all",
    "daily_kpis_completed_by_dropoff",
    "daily_kpis_completed_by_pickup",
    "distinct_values",
    "fare_kpis",
    "fully_described",
    "join_trips",
    "keyed_put",
    "keyed_update",
    "kpis_over_join",
    "layout",
    "mask_invalid",
    "normalize_ends",
    "normalize_start_events",
    "normalize_starts",
    "quarantine",
    "require_any",
    "require_key",
    "rounded_kpis",
    "run_report",
    "select_valid_fields",
]
