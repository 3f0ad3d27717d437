"""K1 and the quarantine sink.

Writes overwrite by default so a rerun gives the same result. Optional
``partition_by`` gives date-partitioned outputs (pruned by later scans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.operators.layout import layout
from tripcraft.operators.validate import NOTE, REASON, RECORD, Checked, reasons

OUTPUT_NAMES = ("trips_copy", "completed_trips", "all_trips_daily_kpis", "completed_trips_daily_kpis")


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | list[str] | None = None,
) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_outputs(
    outputs: dict[str, DataFrame],
    base: str,
    mode: str = "overwrite",
    partition_by: dict[str, str | list[str]] | None = None,
    layouts: dict[str, dict] | None = None,
) -> dict[str, str]:
    """K1: write each named DataFrame as Parquet under ``base/<name>``.

    ``layouts`` maps a name to ``layout()`` options (R1 ``n``/``by``, R2
    ``sort_by``) applied just before that write. Returns the written paths.
    """
    paths = {}
    for name, df in outputs.items():
        opts = (layouts or {}).get(name)
        if opts:
            df = layout(df, **opts)
        path = f"{base.rstrip('/')}/{name}"
        write_parquet(df, path, mode, (partition_by or {}).get(name))
        paths[name] = path
    return paths


def write_checked(checked: Checked, path: str, mode: str = "overwrite") -> tuple[str, str]:
    """Write accepted and refused rows of a stage in one pass.

    The tagged rows are evaluated once and split into ``status=accepted`` and
    ``status=rejected`` folders, instead of running the stage twice.
    """
    t = checked.tagged
    # All reasons of the row, refusal first; null where there are none.
    reason = F.nullif(F.array_join(reasons(t), ","), F.lit(""))
    status = F.when(F.col(REASON).isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    cols = {"status": status, "reason": reason, "stage": F.lit(checked.stage)}
    if RECORD in t.columns:
        # The raw record is kept for refused and noted rows only.
        cols[RECORD] = F.when(reason.isNotNull(), F.col(RECORD))
    out = t.withColumns(cols)
    out = out.drop(REASON, *( [NOTE] if NOTE in t.columns else []))
    write_parquet(out, path, mode, "status")
    base = path.rstrip("/")
    return f"{base}/status=accepted", f"{base}/status=rejected"
