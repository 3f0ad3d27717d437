"""The event path as DataFrame stages (L2 in batch form).

start lines -> S2 -> S4 -> S5 -> V1 -> P3/P5 -> P4/P6 -> start events
end lines   -> S3 -> S4 -> S5 -> V1 -> V2 -> V3 -> P6   -> end events
both        -> J4 -> trips table

Every stage is a per-record projection or filter (no shuffle) until J4,
which is a single keyed aggregate. The ``trace_`` functions keep refused records
in the plan with their reasons, so quarantine and report need one scan a side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft.operators.assemble import assemble_trips
from tripcraft.operators.normalize import conform, normalize_start_events, select_valid_fields
from tripcraft.operators.trace import STATUS, TRACE, Traced, carry
from tripcraft.operators.validate import RECORD, Checked, mask_invalid, require_any, require_key
from tripcraft.schemas import END_COLUMNS, END_EVENT, START_COLUMNS, START_EVENT, TRIP
from tripcraft.sources.events import decode_events, encode_records, to_events
from tripcraft.sources.lines import parse_end_lines, parse_start_lines, read_lines, with_line_seq

# What the consumers read from a start body (times and estimate as sent).
START_BODY = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("pickup_location_id", T.LongType()),
        T.StructField("dropoff_location_id", T.LongType()),
        T.StructField("vendor_id", T.LongType()),
        T.StructField("pickup_datetime", T.StringType()),
        T.StructField("estimated_dropoff_datetime", T.StringType()),
        T.StructField("estimated_fare_amount", T.StringType()),
    ]
)
# What the consumers read from an end body: text fields and numbers.
END_BODY = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("dropoff_datetime", T.StringType()),
        T.StructField("rate_code", T.StringType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("trip_type", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Path:
    """One event kind: its stages, the records that passed all of them, and both sides with their outcomes."""

    stages: list[Checked]
    events: DataFrame  # keyed JSON events as produced (S4)
    accepted: DataFrame
    produced: Traced
    consumed: Traced

    @property
    def rejects(self) -> DataFrame:
        return self.produced.quarantine.unionByName(self.consumed.quarantine)

    @property
    def report(self) -> DataFrame:
        return self.produced.report.unionByName(self.consumed.report)


def _seq_col(df: DataFrame) -> str | None:
    return "seq" if "seq" in df.columns else None


Handoff = Callable[[DataFrame], DataFrame]


def _direct(df: DataFrame) -> DataFrame:
    return df


def produce_start_events(lines: DataFrame) -> tuple[Checked, DataFrame]:
    """Producer side: start lines -> keyed events (key = pickup text)."""
    parsed = parse_start_lines(lines)
    events = to_events(parsed.accepted, "pickup_datetime", START_COLUMNS, _seq_col(lines))
    return parsed, events


def consume_start_events(received: DataFrame) -> tuple[list[Checked], DataFrame]:
    """Consumer side: received (base64) start events -> normalised starts."""
    decoded = decode_events(received, START_BODY, "coerce", stage="decode_start")
    keyed = require_key(decoded.accepted, stage="require_key_start")
    normalized = normalize_start_events(keyed.accepted)
    accepted = conform(select_valid_fields(normalized.accepted.drop("key", RECORD)), START_EVENT)
    return [decoded, keyed, normalized], accepted


def produce_end_events(lines: DataFrame) -> tuple[Checked, DataFrame]:
    """Producer side: end lines -> keyed events (key = trip_id), all text."""
    parsed = parse_end_lines(lines)
    events = to_events(parsed.accepted, "trip_id", END_COLUMNS, _seq_col(lines))
    return parsed, events


def consume_end_events(received: DataFrame, mode: str = "coerce") -> tuple[list[Checked], DataFrame]:
    """Consumer side: received end events -> validated end events."""
    decoded = decode_events(received, END_BODY, mode, stage="decode_end")
    keyed = require_key(decoded.accepted, stage="require_key_end")
    masked = mask_invalid(keyed.accepted, mode)
    anyvalid = require_any(masked, stage="require_any_end")
    accepted = conform(anyvalid.accepted.drop("key", RECORD), END_EVENT)
    return [decoded, keyed, anyvalid], accepted


def trace_start_events(received: DataFrame) -> Traced:
    """``consume_start_events`` with every received record and its outcomes."""
    decoded = decode_events(received, START_BODY, "coerce", stage="decode_start")
    keyed = require_key(carry(decoded), stage="require_key_start")
    normalized = normalize_start_events(carry(keyed))
    rows = conform(select_valid_fields(carry(normalized).drop("key")), START_EVENT)
    return Traced(rows, (decoded.stage, keyed.stage, normalized.stage))


def trace_end_events(received: DataFrame, mode: str = "coerce") -> Traced:
    """``consume_end_events`` with every received record and its outcomes."""
    decoded = decode_events(received, END_BODY, mode, stage="decode_end")
    keyed = require_key(carry(decoded), stage="require_key_end")
    anyvalid = require_any(mask_invalid(carry(keyed), mode), stage="require_any_end")
    rows = conform(carry(anyvalid).drop("key"), END_EVENT)
    return Traced(rows, (decoded.stage, keyed.stage, anyvalid.stage))


def start_path(lines: DataFrame, handoff: Handoff = _direct) -> Path:
    """Start lines to normalised start events.

    ``handoff`` carries the received-form events from producer to consumer;
    in a deployment that is the stream (or a written table), which also keeps
    the two halves in separate plans.
    """
    parsed, events = produce_start_events(lines)
    received = handoff(encode_records(events))
    stages, accepted = consume_start_events(received)
    return Path([parsed, *stages], events, accepted, Traced(carry(parsed), (parsed.stage,)),
                trace_start_events(received))


def end_path(lines: DataFrame, mode: str = "coerce", handoff: Handoff = _direct) -> Path:
    """End lines to validated end events (``mode``: coerce | strict numbers)."""
    parsed, events = produce_end_events(lines)
    received = handoff(encode_records(events))
    stages, accepted = consume_end_events(received, mode)
    return Path([parsed, *stages], events, accepted, Traced(carry(parsed), (parsed.stage,)),
                trace_end_events(received, mode))


def trip_events(starts: DataFrame, ends: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Both kinds in the keyed-merge input layout (seq, kind, trip fields and ``extra`` columns of both)."""
    names = ["seq", "kind"] + TRIP.fieldNames() + (extra or [])
    types = {f.name: f.dataType for f in TRIP} | {"seq": next(
        (df.schema["seq"].dataType for df in (starts, ends) if "seq" in df.columns), T.LongType())}

    def widen(df: DataFrame, kind: str) -> DataFrame:
        cols = []
        for n in names:
            if n == "kind":
                cols.append(F.lit(kind).alias("kind"))
            elif n in df.columns:
                cols.append(F.col(n))
            else:
                cols.append(F.lit(None).cast(types[n]).alias(n))
        return df.select(*cols)

    return widen(starts, "start").unionByName(widen(ends, "end"))


def assemble_from_lines(
    start_lines: DataFrame,
    end_lines: DataFrame,
    mode: str = "replay",
    numbers: str = "coerce",
    handoff: Handoff = _direct,
) -> tuple[DataFrame, Path, Path]:
    """Both paths and J4. Lines must carry ``seq`` (see ``with_line_seq``)."""
    sp = start_path(start_lines, handoff)
    ep = end_path(end_lines, numbers, handoff)
    trips = assemble_trips(trip_events(sp.accepted, ep.accepted), mode)
    return trips, sp, ep


def run_events(
    spark: SparkSession,
    start_lines_path: str,
    end_lines_path: str,
    out_base: str,
    mode: str = "replay",
    numbers: str = "coerce",
) -> dict[str, str]:
    """L2 in batch form: producer line files -> trips table, quarantine, report.

    Lines are read once and received events decoded once: each side of each
    kind is one plan, written once with its outcomes under ``out_base`` by
    ``status``. The trips, every refused record and the run counters come from
    those tables and are written as Parquet. Returns the paths.
    """
    base = out_base.rstrip("/")

    def stored(traced: Traced, name: str) -> Traced:
        path = f"{base}/{name}"
        rows = traced.with_status()
        rows.write.mode("overwrite").partitionBy(STATUS).parquet(path)
        return Traced(spark.read.schema(rows.schema).parquet(path), traced.stages)

    def accepted(traced: Traced) -> DataFrame:
        return traced.rows.filter(F.col(STATUS) == "accepted").drop(STATUS, TRACE, RECORD)

    starts = with_line_seq(read_lines(spark, start_lines_path), 0)
    ends = with_line_seq(read_lines(spark, end_lines_path), 1)
    sides: list[Traced] = []
    consumed: list[Traced] = []
    for kind, lines, parse, key, columns, consume in (
        ("start", starts, parse_start_lines, "pickup_datetime", START_COLUMNS, trace_start_events),
        ("end", ends, parse_end_lines, "trip_id", END_COLUMNS, lambda received: trace_end_events(received, numbers)),
    ):
        parsed = parse(lines)
        produced = stored(Traced(carry(parsed), (parsed.stage,)), f"produced/{kind}")
        events = to_events(accepted(produced), key, columns, "seq")
        consumed.append(stored(consume(encode_records(events)), f"consumed/{kind}"))
        sides += [produced, consumed[-1]]
    trips = assemble_trips(trip_events(*[accepted(c) for c in consumed]), mode)
    paths = {
        "trips": f"{base}/trips",
        "rejects": f"{base}/rejects",
        "report": f"{base}/report",
    }
    trips.write.mode("overwrite").parquet(paths["trips"])
    reduce(DataFrame.unionByName, [s.quarantine for s in sides]).write.mode("overwrite").parquet(paths["rejects"])
    reduce(DataFrame.unionByName, [s.report for s in sides]).write.mode("overwrite").parquet(paths["report"])
    return paths
