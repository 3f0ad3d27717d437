"""Joins and keyed merges.

J1 is the batch path's plain inner join. J2-J4 rebuild the keyed trip table of
the event path: a start replaces the whole row of its key, an end updates only
its valid fields, and the outcome depends on arrival order (``seq``).

J4 is one ``groupBy(trip_id).agg(...)``: per key the latest start as
``max(struct(seq, fields))`` and, per end field, the latest valid value as
``max(struct(seq, value))``. ``max`` is associative, so Spark computes it as a
partial aggregate before the shuffle (a key holding a third of all events still
sends one row per task), and the same expression runs unchanged as a streaming
aggregation whose state is one row per trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcraft.schemas import END_FIELDS, START_FIELDS

MODES = ("replay", "merge")


def join_trips(starts: DataFrame, ends: DataFrame, key: str = "trip_id") -> DataFrame:
    """Inner equi-join on ``trip_id``; one key column; repeated keys fan out.

    Catalyst picks the strategy from sizes (AQE re-plans with real ones and
    splits skewed partitions), so no hint is given here.
    """
    return starts.join(ends, on=key, how="inner")


def _start_state(seq: str, fields: list[str]) -> Column:
    return F.max(
        F.when(
            F.col("kind") == "start",
            F.struct(F.col(seq).alias("seq"), *[F.col(f) for f in fields]),
        )
    )


def _end_state(seq: str, field: str) -> Column:
    # Only a valid (non-null after V2) value overwrites the field.
    return F.max(
        F.when(
            (F.col("kind") == "end") & F.col(field).isNotNull(),
            F.struct(F.col(seq).alias("seq"), F.col(field).alias("v")),
        )
    )


def trip_state_aggs(
    start_fields: list[str], end_fields: list[str], seq: str = "seq"
) -> list[Column]:
    """Aggregate expressions of the keyed state (shared by batch and streaming)."""
    aggs = []
    if start_fields:
        aggs.append(_start_state(seq, start_fields).alias("_s"))
    aggs += [_end_state(seq, f).alias(f"_e_{f}") for f in end_fields]
    return aggs


def trip_state_columns(
    start_fields: list[str], end_fields: list[str], mode: str, key: str = "trip_id"
) -> list[Column]:
    """Project the aggregated state to one trip row.

    ``replay``: an end value survives only if it arrived after the latest
    start (a later start replaces the whole row). If the last valid value of a
    field precedes the last start, every earlier one does too, so comparing
    the two maxima is exact. ``merge``: a start never erases end fields.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    cols = [F.col(key)]
    cols += [F.col(f"_s.{f}").alias(f) for f in start_fields]
    for f in end_fields:
        e = F.col(f"_e_{f}")
        if mode == "replay" and start_fields:
            s_seq = F.col("_s.seq")
            cols.append(F.when(s_seq.isNull() | (e["seq"] > s_seq), e["v"]).alias(f))
        else:
            cols.append(e["v"].alias(f))
    return cols


def assemble_trips(
    events: DataFrame,
    mode: str = "replay",
    key: str = "trip_id",
    seq: str = "seq",
    start_fields: list[str] | None = None,
    end_fields: list[str] | None = None,
) -> DataFrame:
    """One row per trip from start and end events.

    ``events`` has ``seq``, ``trip_id``, ``kind`` ('start' | 'end') and the
    typed fields of both kinds, already through P3-P6 / V1-V3 (an end with no
    valid field must be gone, or it creates an empty trip). ``seq`` must be
    unique per trip; on a tie the larger value wins (struct ordering).
    """
    start_fields = [f for f in (START_FIELDS if start_fields is None else start_fields) if f in events.columns]
    end_fields = [f for f in (END_FIELDS if end_fields is None else end_fields) if f in events.columns]
    state = events.groupBy(key).agg(*trip_state_aggs(start_fields, end_fields, seq))
    return state.select(*trip_state_columns(start_fields, end_fields, mode, key))


def keyed_put(starts: DataFrame, key: str = "trip_id", seq: str = "seq") -> DataFrame:
    """J2 alone: the latest start per key replaces the whole row."""
    events = starts.withColumn("kind", F.lit("start"))
    return assemble_trips(events, "merge", key, seq, end_fields=[])


def keyed_update(ends: DataFrame, key: str = "trip_id", seq: str = "seq") -> DataFrame:
    """J3 alone: each valid end field overwrites that field only."""
    events = ends.withColumn("kind", F.lit("end"))
    return assemble_trips(events, "merge", key, seq, start_fields=[])
