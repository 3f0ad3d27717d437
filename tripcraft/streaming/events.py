"""The event path from received records under Structured Streaming.

A micro-batch is decoded and checked in one plan whose rows keep their outcomes
(``operators.trace``); they are written once and give the batch's trip state,
quarantine rows and counters. Every output lies under ``batch_id=<n>`` and is
overwritten, so a batch that failed between two outputs is repeated as a whole
after the restart with nothing lost or doubled.

``expire_after`` (off by default) closes old trips: an event whose own time lies that
long before the newest time of the earlier micro-batches is refused as late, with its
record in the quarantine. What the earlier batches saw is an output of theirs, so a
repeated batch refuses the same events.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripcraft.operators.trace import STATUS, TRACE, Traced
from tripcraft.operators.validate import RECORD
from tripcraft.plans.events import trace_end_events, trace_start_events, trip_events
from tripcraft.session import default_parallelism
from tripcraft.streaming.store import TripStore, read_parquet_or_empty

#: Received records: ``kind`` (start or end), base64 body and arrival order.
RECEIVED = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("data", T.StringType()), T.StructField("seq", T.LongType())])


def trace_received(received: DataFrame, numbers: str = "coerce") -> list[Traced]:
    """Both kinds of received records with their outcomes; each record is decoded once."""
    def of(kind: str) -> DataFrame:
        return received.where(F.col("kind") == kind).select("data", "seq")

    return [trace_start_events(of("start")), trace_end_events(of("end"), numbers)]


def _both(traced: list[Traced]) -> Traced:
    """One frame in the layout of trip events, traces and raw records kept."""
    starts, ends = (t.with_status() for t in traced)
    extra = [STATUS, TRACE, RECORD]
    rows = trip_events(starts, ends, extra)
    return Traced(rows, tuple(s for t in traced for s in t.stages))


def _event_time(kind: str) -> tuple[Column, Column]:
    """Earliest and latest time of an event, null if it tells none: a start tells the day of its pickup."""
    if kind == "end":
        return F.col("dropoff_datetime"), F.col("dropoff_datetime")
    day = F.col("pickup_datetime").cast("date").cast("timestamp_ntz")
    return day, day + F.expr("INTERVAL 1 DAY")


def _closed_before(spark: SparkSession, base: str, batch_id: int, expire_after: str) -> str | None:
    """The time before which trips are closed for this batch, as text; none before the first event time."""
    seen = read_parquet_or_empty(spark, f"{base}/event_times", "newest timestamp_ntz, batch_id long")
    newest = seen.where(F.col("batch_id") < batch_id).agg(F.max("newest").alias("newest"))
    return newest.select((F.col("newest") - F.expr(f"INTERVAL {expire_after}")).cast("string")).first()[0]


def process_batch(batch: DataFrame, batch_id: int, path: str, numbers: str = "coerce",
                  after: Callable[[str], None] = lambda output: None, expire_after: str | None = None) -> None:
    """All outputs of one micro-batch under ``path``. ``after`` is called with the name of each written output.

    ``expire_after`` is the text of an interval, such as ``7 DAYS``. Events that
    tell no time are never late; a table of a path must always be written with
    the option or always without it.
    """
    spark, base = batch.sparkSession, path.rstrip("/")
    # A micro-batch may come from a few files or partitions; its records are decoded on all cores.
    dealt = batch.repartition(default_parallelism(spark), F.xxhash64(*batch.columns))
    traced = trace_received(dealt, numbers)
    if expire_after:
        closed = F.lit(_closed_before(spark, base, batch_id, expire_after)).cast("timestamp_ntz")
        traced = [t.refuse(f"expiry_{kind}", _event_time(kind)[1] < closed, f"late_{kind}")
                  for kind, t in zip(("start", "end"), traced, strict=True)]
    rows = _both(traced).rows
    staged = f"{base}/staged"  # of the batch at hand only
    rows.write.mode("overwrite").partitionBy("kind", STATUS).parquet(staged)
    after("staged")
    stored = spark.read.schema(rows.schema).parquet(staged)
    TripStore(spark, base).add(stored.where(F.col(STATUS) == "accepted"), batch_id)
    after("deltas")
    if expire_after:
        kind = F.col("kind")
        time = F.when(kind == "start", _event_time("start")[0]).when(kind == "end", _event_time("end")[0])
        (stored.where(F.col(STATUS) == "accepted").agg(F.max(time).alias("newest"))
         .write.mode("overwrite").parquet(f"{base}/event_times/batch_id={batch_id}"))
        after("event_times")
    sides = [Traced(stored.where(F.col("kind") == kind), t.stages)
             for kind, t in zip(("start", "end"), traced, strict=True)]
    outputs = {"quarantine": [s.quarantine for s in sides], "report": [s.report for s in sides]}
    for name, frames in outputs.items():
        reduce(DataFrame.unionByName, frames).write.mode("overwrite").parquet(f"{base}/{name}/batch_id={batch_id}")
        after(name)


def start_event_path(
    received: DataFrame,
    path: str,
    checkpoint: str,
    numbers: str = "coerce",
    available_now: bool = True,
    processing_time: str | None = None,
    after: Callable[[str], None] = lambda output: None,
    expire_after: str | None = None,
) -> StreamingQuery:
    """Keep trips, quarantine and counters under ``path`` up to date with a stream of received records."""
    writer = received.writeStream.foreachBatch(
        lambda batch, batch_id: process_batch(batch, batch_id, path, numbers, after, expire_after)
    ).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_stream_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Every quarantine row so far (stage, reason, trip_id, record)."""
    return spark.read.parquet(f"{path.rstrip('/')}/quarantine").drop("batch_id")


def read_stream_report(spark: SparkSession, path: str) -> DataFrame:
    """Counters of all micro-batches so far (stage, outcome, reason, n)."""
    return (spark.read.parquet(f"{path.rstrip('/')}/report")
            .groupBy("stage", "outcome", "reason").agg(F.sum("n").alias("n")))
