"""Filters, validity masks and the quarantine (V1-V6).

Stages that can refuse records return a :class:`Checked`: the input rows with a
``_reason`` column (null = accepted) and an optional ``_note``: an array with a
text for every field that was set to null although the record is kept.
``accepted`` and ``rejects`` are two filters over that one projection, so a job
that writes both should write the tagged frame once (see
``sinks.write_checked``) or carry the outcomes along (see ``operators.trace``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft.functions.datetime import parse_date_text, parse_datetime_text, to_ntz
from tripcraft.functions.validity import number_or_null, valid_number, valid_text
from tripcraft.schemas import DESCRIPTIVE_FIELDS, END_FIELD_KINDS, END_FIELDS

REASON = "_reason"
NOTE = "_note"
RECORD = "_record"


@dataclass(frozen=True)
class Checked:
    """Rows of one stage with the reason each refused row was set aside."""

    tagged: DataFrame
    stage: str

    @property
    def accepted(self) -> DataFrame:
        # The raw record stays, so that a later stage can set it aside unchanged.
        keep = [c for c in self.tagged.columns if c not in (REASON, NOTE)]
        return self.tagged.filter(F.col(REASON).isNull()).select(*keep)

    @property
    def rejects(self) -> DataFrame:
        """A row per refusal and per note, in the quarantine schema."""
        t = self.tagged
        record = F.col(RECORD) if RECORD in t.columns else F.to_json(
            F.struct(*[c for c in t.columns if c not in (REASON, NOTE)])
        )
        trip = F.col("trip_id").cast("string") if "trip_id" in t.columns else F.lit(None)
        return t.filter(F.size(reasons(t)) > 0).select(
            F.lit(self.stage).alias("stage"),
            F.explode(reasons(t)).alias("reason"),
            trip.cast("string").alias("trip_id"),
            record.cast("string").alias("record"),
        )

    def outcome_counts(self) -> DataFrame:
        """(stage, outcome, reason, n) for the run report; one aggregation."""
        t = self.tagged
        reason = F.col(REASON)
        return t.groupBy(
            F.when(reason.isNull(), F.lit("processed")).otherwise(F.lit("failed")).alias("outcome"),
            F.coalesce(reason, F.lit("accepted")).alias("reason"),
        ).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(self.stage).alias("stage"), "outcome", "reason", "n"
        )


def notes(*found: Column) -> Column:
    """The note array of texts that are null where nothing was found."""
    return F.array_compact(F.array(*found))


def reasons(tagged: DataFrame) -> Column:
    """All reasons of a row: its refusal, if any, and its notes."""
    refusal = F.array_compact(F.array(F.col(REASON)))
    return F.concat(refusal, F.col(NOTE)) if NOTE in tagged.columns else refusal


def tag(df: DataFrame, reason: Column, stage: str, note: Column | None = None) -> Checked:
    """Attach a refusal reason (first matching rule wins) to every row."""
    if REASON in df.columns:
        reason = F.coalesce(F.col(REASON), reason)
    cols = {REASON: reason}
    if note is not None:
        cols[NOTE] = note
    return Checked(df.withColumns(cols), stage)


def quarantine(*checked: Checked) -> DataFrame:
    """V4: every refused or noted record of the given stages, with its reason."""
    frames = [c.rejects for c in checked]
    if not frames:
        raise ValueError("quarantine needs at least one stage")
    return reduce(DataFrame.unionByName, frames)


# --- V1 ------------------------------------------------------------------------


def require_key(df: DataFrame, stage: str = "require_key", key: str = "trip_id") -> Checked:
    """V1: refuse records whose key is missing or empty."""
    k = F.col(key)
    return tag(df, F.when(k.isNull() | (k.cast("string") == ""), F.lit("missing_trip_id")), stage)


# --- V2 ------------------------------------------------------------------------


def _text_value(df: DataFrame, name: str, mode: str) -> Column:
    c = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.when(valid_text(c), c)
    # A typed non-text value is not text: the strict reading refuses it.
    return F.lit(None).cast("string") if mode == "strict" else c.cast("string")


def _number_value(df: DataFrame, name: str, mode: str) -> Column:
    c = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        # Numbers that arrive as text: coerce reads them, strict refuses them.
        n = number_or_null(c) if mode == "coerce" else F.lit(None).cast("double")
    else:
        n = c.cast("double")
    return F.when(valid_number(n), n)


def _dropoff_value(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        # Non-blank text that is a date-time (or a date, read as midnight).
        return F.when(
            valid_text(c),
            F.coalesce(parse_datetime_text(c), to_ntz(parse_date_text(c))),
        )
    if isinstance(dtype, T.DateType):
        return to_ntz(c)
    return c.cast("timestamp_ntz")


def mask_invalid(df: DataFrame, mode: str = "coerce") -> DataFrame:
    """V2: each end field that is not valid becomes null ("not sent").

    ``coerce`` accepts numbers sent as text; ``strict`` accepts only real
    numbers (so the all-text producer gets no number through, as coded in the
    reference consumer). Columns may arrive as text or already typed. A
    drop-off sent as text that is no date-time becomes null with a note.
    """
    if mode not in ("coerce", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    cols = {}
    for name, kind in END_FIELD_KINDS.items():
        if name not in df.columns:
            continue
        if name == "dropoff_datetime":
            cols[name] = _dropoff_value(df, name)
        elif kind == "text":
            cols[name] = _text_value(df, name, mode)
        else:
            cols[name] = _number_value(df, name, mode)
    if "dropoff_datetime" in cols and isinstance(df.schema["dropoff_datetime"].dataType, T.StringType):
        unread = valid_text(F.col("dropoff_datetime")) & cols["dropoff_datetime"].isNull()
        cols[NOTE] = notes(F.when(unread, F.lit("malformed_dropoff_datetime")))
    return df.withColumns(cols)


# --- V3 ------------------------------------------------------------------------


def require_any(df: DataFrame, cols: list[str] | None = None, stage: str = "require_any") -> Checked:
    """V3: refuse end events in which no field is valid (after V2).

    A field that was sent but not understood (noted by V2) counts as sent.
    """
    cols = [c for c in (cols or END_FIELDS) if c in df.columns]
    none_valid = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])
    if NOTE in df.columns:
        none_valid = none_valid & (F.size(NOTE) == 0)
    return tag(df, F.when(none_valid, F.lit("no_valid_field")), stage)


# --- V5, V6 --------------------------------------------------------------------


def completed(df: DataFrame) -> DataFrame:
    """V5: trips with a drop-off time."""
    return df.filter(F.col("dropoff_datetime").isNotNull())


def fully_described(df: DataFrame) -> DataFrame:
    """V6: trips whose rate code, passenger count, payment and trip type are set."""
    return df.dropna(how="any", subset=DESCRIPTIVE_FIELDS)


__all__ = [
    "Checked",
    "completed",
    "fully_described",
    "mask_invalid",
    "notes",
    "quarantine",
    "reasons",
    "require_any",
    "require_key",
    "tag",
]
