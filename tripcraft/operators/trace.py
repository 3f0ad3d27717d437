"""V4 and A4 in one pass: outcomes carried along with the records.

A stage's refusal and notes move into the array ``_trace`` of (stage, reason,
refused), and the record goes on through the next stages whether it was
refused or not; a stage looks no further at what an earlier one refused. So one
plan over one scan holds the accepted records, every quarantine row and all
counters, and can be written once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcraft.operators.validate import NOTE, REASON, RECORD, Checked

TRACE = "_trace"
STATUS = "status"
_OUTCOMES = "array<struct<stage:string,reason:string,refused:boolean>>"


def _refusals() -> Column:
    return F.filter(F.col(TRACE), lambda o: o["refused"])


def carry(checked: Checked) -> DataFrame:
    """All rows of a stage, with its outcomes appended to their trace."""
    t = checked.tagged

    def outcome(reason: Column, refused: bool) -> Column:
        return F.struct(F.lit(checked.stage).alias("stage"), reason.alias("reason"), F.lit(refused).alias("refused"))

    new = F.transform(F.array_compact(F.array(F.col(REASON))), lambda r: outcome(r, True))
    if NOTE in t.columns:
        new = F.concat(new, F.transform(NOTE, lambda n: outcome(n, False)))
    if TRACE in t.columns:
        new = F.concat(TRACE, F.when(F.size(_refusals()) == 0, new).otherwise(F.array().cast(_OUTCOMES)))
    return t.withColumn(TRACE, new.cast(_OUTCOMES)).drop(REASON, NOTE)


@dataclass(frozen=True)
class Traced:
    """Records that went through ``stages`` (in order), each with its trace."""

    rows: DataFrame
    stages: tuple[str, ...]

    def refuse(self, stage: str, when: Column, reason: str) -> Traced:
        """One more stage, which refuses the records that ``when`` holds for (null: it doesn't) and none refused before."""
        late = F.array(F.struct(F.lit(stage).alias("stage"), F.lit(reason).alias("reason"), F.lit(True).alias("refused")))
        new = F.when((F.size(_refusals()) == 0) & when, late).otherwise(F.array().cast(_OUTCOMES))
        return Traced(self.rows.withColumn(TRACE, F.concat(TRACE, new).cast(_OUTCOMES)), (*self.stages, stage))

    @property
    def accepted(self) -> DataFrame:
        return self.rows.filter(F.size(_refusals()) == 0).drop(TRACE, RECORD)

    @property
    def quarantine(self) -> DataFrame:
        """V4: a row per refusal and note (stage, reason, trip_id, record)."""
        trip = F.col("trip_id").cast("string") if "trip_id" in self.rows.columns else F.lit(None).cast("string")
        # A row without outcomes expands to none. Expanding the column itself, or a filter on its size, would be
        # pushed below the stages with their expressions inlined: all rules would be evaluated twice a record.
        outcomes = F.transform(TRACE, lambda o: F.struct(o["stage"].alias("stage"), o["reason"].alias("reason")))
        return (self.rows.select(trip.alias("trip_id"), F.col(RECORD).alias("record"), F.inline(outcomes))
                .select("stage", "reason", "trip_id", "record"))

    @property
    def report(self) -> DataFrame:
        """A4: (stage, outcome, reason, n) from one aggregate.

        Records are counted by the refusal that ended them, if any. What a stage
        processed is all records less those refused there or before.
        """
        refusal = F.get(_refusals(), F.lit(0))
        counts = self.rows.groupBy(refusal["stage"].alias("stage"), refusal["reason"].alias("reason")).agg(
            F.count(F.lit(1)).alias("n"))
        # One row: there are as many entries as kinds of refusals.
        known = counts.agg(F.sum("n").alias("total"), F.collect_list(
            F.when(F.col("stage").isNotNull(), F.struct("stage", "reason", "n"))).alias("refused"))
        order = F.array(*[F.lit(s) for s in self.stages])

        def of_stage(stage: Column, at: Column) -> Column:
            ended = F.aggregate(
                F.filter("refused", lambda r: F.array_position(order, r["stage"]) <= at + 1),
                F.lit(0).cast("long"), lambda n, r: n + r["n"])
            processed = F.struct(stage.alias("stage"), F.lit("processed").alias("outcome"),
                                 F.lit("accepted").alias("reason"), (F.col("total") - ended).alias("n"))
            failed = F.transform(
                F.filter("refused", lambda r: r["stage"] == stage),
                lambda r: F.struct(stage.alias("stage"), F.lit("failed").alias("outcome"),
                                   r["reason"].alias("reason"), r["n"].alias("n")))
            return F.concat(F.array(processed), failed)

        return known.select(F.inline(F.flatten(F.transform(order, of_stage)))).where(F.col("n") > 0)

    def with_status(self) -> DataFrame:
        """The rows for one write: ``status`` accepted or refused; the raw record only where it is needed."""
        status = F.when(F.size(_refusals()) == 0, F.lit("accepted")).otherwise(F.lit("refused"))
        return self.rows.withColumns({
            STATUS: status, RECORD: F.when(F.size(TRACE) > 0, F.col(RECORD))})
