"""Projections and normalisation.

All rules are single projections of built-in expressions, so Catalyst fuses
them with the scan and the filters around them into one code-generated stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft.functions.datetime import (
    parse_date_text,
    parse_datetime_text,
    time_of_day,
    to_ntz,
)
from tripcraft.functions.validity import finite, number_or_null
from tripcraft.operators.validate import NOTE, REASON, Checked, notes
from tripcraft.schemas import START_EVENT

# --- P1, P2: batch rows with typed timestamps ----------------------------------


def normalize_starts(df: DataFrame) -> DataFrame:
    """Add ``pickup_time``, truncate the pickup to its date, round the estimate.

    One projection: every new value reads the *input* columns, so the time of
    day is taken before the truncation.
    """
    return df.withColumns(
        {
            "pickup_time": time_of_day(F.col("pickup_datetime")),
            "pickup_datetime": F.to_date(F.col("pickup_datetime")),
            "estimated_fare_amount": F.round(F.col("estimated_fare_amount"), 2),
        }
    )


def normalize_ends(df: DataFrame) -> DataFrame:
    """Add ``dropoff_time``, truncate the drop-off to its date, round the fare."""
    return df.withColumns(
        {
            "dropoff_time": time_of_day(F.col("dropoff_datetime")),
            "dropoff_datetime": F.to_date(F.col("dropoff_datetime")),
            "fare_amount": F.round(F.col("fare_amount"), 2),
        }
    )


# --- P3-P6: start events with text times ---------------------------------------


def _present(c: Column) -> Column:
    # A value counts as sent when it is a non-empty text (blank is "sent").
    return c.isNotNull() & (c.cast("string") != "")


def normalize_start_events(df: DataFrame, stage: str = "normalize_start") -> Checked:
    """P3 + P5: normalise decoded start events.

    Pickup text: a full date-time gives its date and ``HH:mm:ss``; a date
    alone gives the date and no time; empty gives neither. Anything else is
    malformed: the record is still kept, the date is null and a note is
    quarantined (one for each malformed time); as in the reference, no estimated drop-off time is derived
    for such a record. The estimated drop-off keeps a full date-time (time of
    day derived) or a date (midnight, no time). The estimate is rounded to two
    places; a sent estimate that is not a finite number refuses the record.
    """
    pickup = F.col("pickup_datetime").cast("string")
    pickup_full = parse_datetime_text(pickup)
    pickup_date = parse_date_text(pickup)
    pickup_bad = _present(pickup) & pickup_full.isNull() & pickup_date.isNull()

    est_drop = F.col("estimated_dropoff_datetime").cast("string")
    est_full = parse_datetime_text(est_drop)
    est_date = parse_date_text(est_drop)
    est_drop_bad = _present(est_drop) & est_full.isNull() & est_date.isNull()

    fare_in = F.col("estimated_fare_amount")
    fare = number_or_null(fare_in)
    fare_bad = fare_in.isNotNull() & ~finite(fare)

    note = notes(
        F.when(pickup_bad, F.lit("malformed_pickup_datetime")),
        F.when(est_drop_bad, F.lit("malformed_estimated_dropoff_datetime")),
    )
    # One projection: reasons, notes and new values all read the input columns.
    normalized = df.withColumns(
        {
            "pickup_datetime": F.coalesce(F.to_date(pickup_full), pickup_date),
            "pickup_time": time_of_day(pickup_full),
            "estimated_dropoff_datetime": F.coalesce(est_full, to_ntz(est_date)),
            "estimated_dropoff_time": F.when(~pickup_bad, time_of_day(est_full)),
            "estimated_fare_amount": F.round(fare, 2),
            REASON: F.when(fare_bad, F.lit("bad_estimated_fare_amount")),
            NOTE: note,
        }
    )
    return Checked(normalized, stage)


def select_valid_fields(df: DataFrame, schema: T.StructType = START_EVENT) -> DataFrame:
    """Keep only the known fields (extra fields never reach the store)."""
    keep = [f.name for f in schema.fields if f.name in df.columns]
    extra = [c for c in df.columns if c.startswith("_") or c in ("seq", "kind", "key")]
    return df.select(*keep, *[c for c in extra if c not in keep])


def conform(df: DataFrame, schema: T.StructType = START_EVENT) -> DataFrame:
    """Typed rows of the fixed schema; absent fields are null."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in schema.fieldNames() and (c.startswith("_") or c in ("seq", "kind"))]
    return df.select(*cols, *extra)


# --- P8 ---------------------------------------------------------------------------


def distinct_values(df: DataFrame, column: str | Column) -> DataFrame:
    """The distinct values of one column (partial + final hash aggregate)."""
    return df.select(column).distinct()
