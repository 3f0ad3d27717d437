"""Registered queries over the supplied tables (one per operator group).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose work grows
with the supplied tables. Queries that exercise a file format or a sink write
their input under the shared root (``spark.checkpoint.dir``) and read it back.
KPI outputs are passed through ``rounded_kpis`` so that floating-point
summation order cannot change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcraft.operators import (
    assemble_trips,
    completed,
    distinct_values,
    fully_described,
    join_trips,
    keyed_put,
    keyed_update,
    kpis_over_join,
    mask_invalid,
    normalize_ends,
    normalize_starts,
    rounded_kpis,
)
from tripcraft.operators.validate import RECORD, REASON
from tripcraft.plans.events import START_BODY, assemble_from_lines, end_path, start_path, trip_events
from tripcraft.plans.kpi_job import kpi_job_outputs, run_kpi_job
from tripcraft.schemas import END_COLUMNS, END_FIELDS, START_COLUMNS, TRIP_END, TRIP_START
from tripcraft.session import default_parallelism, scratch_path
from tripcraft.sinks import read_published, write_outputs
from tripcraft.sources import supplied as S
from tripcraft.sources.csv import check_trips_csv, read_trips_csv, write_trips_csv
from tripcraft.sources.event_log import EventLog
from tripcraft.sources.events import to_events
from tripcraft.sources.lines import read_lines, with_line_seq
from tripcraft.sources.trips import read_trips
from tripcraft.streaming import (
    RECEIVED,
    TripStore,
    read_event_stream,
    read_stream_quarantine,
    read_stream_report,
    read_trip_table,
    start_event_path,
    start_trip_table,
    trace_received,
)

Query = Callable[[SparkSession, str], DataFrame]


# --- shared inputs -------------------------------------------------------------------


def _starts(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_starts(S.paired_starts(spark, sf))


def _ends(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_ends(S.paired_ends(spark, sf))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    return join_trips(_starts(spark, sf), _ends(spark, sf))


def _lines(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write producer lines as text files and read them back (the file source).

    The fixture is written as one file per core, as a producer drop of many
    files would be; the events table itself is a single small file.
    """
    path = scratch_path(spark, name)
    df.repartition(default_parallelism(spark)).write.mode("overwrite").text(path)
    return read_lines(spark, path)


def _handoff(spark: SparkSession):
    """Producer -> consumer hand-off through a written table (the "stream")."""

    def through_storage(received: DataFrame) -> DataFrame:
        path = scratch_path(spark, "events")
        received.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return through_storage


def _start_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, S.start_lines(spark, sf), "start-lines")


def _end_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, S.end_lines(spark, sf), "end-lines")


def _trip_events(spark: SparkSession, sf: str) -> DataFrame:
    """Interleaved events after V2 (invalid end fields are null)."""
    ev = mask_invalid(S.interleaved_events(spark, sf))
    any_valid = F.lit(False)
    for f in END_FIELDS:
        any_valid = any_valid | F.col(f).isNotNull()
    # V3: an end with nothing valid must not reach the keyed merge.
    return ev.filter((F.col("kind") == "start") | any_valid)


def _drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(RECORD, REASON, "_note", "key", "seq")


# --- S1-S6 ---------------------------------------------------------------------------


def q_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "trip-start-csv")
    write_trips_csv(S.paired_starts(spark, sf), path)
    return read_trips_csv(spark, path, TRIP_START)


def q_csv_scan_ends(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "trip-end-csv")
    write_trips_csv(S.paired_ends(spark, sf), path)
    return read_trips_csv(spark, path, TRIP_END)


def q_csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Quarantine rows of a CSV whose fields don't all parse."""
    path = scratch_path(spark, "damaged-csv")
    S.damaged_start_csv(spark, sf).write.mode("overwrite").option("header", "true").csv(path)
    return check_trips_csv(spark, path, TRIP_START).rejects


def q_event_log(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends of keyed start events (S4), numbered in the order of their times."""
    log = EventLog(spark, scratch_path(spark, "event-log"))
    starts = S.paired_starts(spark, sf)
    late = F.col("pickup_datetime") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for rows in (starts.where(~late), starts.where(late)):
        events = to_events(rows, "pickup_datetime", START_COLUMNS)
        log.append(events.withColumn("trip_id", F.get_json_object("value", "$.trip_id").cast("long")),
                   ["key", "trip_id"])
    return log.read().select("seq", "trip_id")


def q_parse_start_lines(spark: SparkSession, sf: str) -> DataFrame:
    from tripcraft.sources.lines import parse_start_lines

    return _drop_internal(parse_start_lines(_start_lines(spark, sf)).accepted)


def q_parse_end_lines(spark: SparkSession, sf: str) -> DataFrame:
    from tripcraft.sources.lines import parse_end_lines

    return _drop_internal(parse_end_lines(_end_lines(spark, sf)).accepted)


def q_line_rejects(spark: SparkSession, sf: str) -> DataFrame:
    sp = start_path(_start_lines(spark, sf), _handoff(spark))
    ep = end_path(_end_lines(spark, sf), handoff=_handoff(spark))
    rejects = sp.rejects.unionByName(ep.rejects)  # one scan of the lines and one of the events of each kind
    return rejects.groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n"))


def q_start_events(spark: SparkSession, sf: str) -> DataFrame:
    events = start_path(_start_lines(spark, sf), _handoff(spark)).events
    body = F.from_json(F.col("value"), START_BODY)
    out = events.select("key", body.alias("b")).select("key", "b.*")
    return out.withColumn("estimated_fare_amount", F.col("estimated_fare_amount").try_cast("double"))


def q_end_events(spark: SparkSession, sf: str) -> DataFrame:
    events = end_path(_end_lines(spark, sf), handoff=_handoff(spark)).events
    body = F.from_json(F.col("value"), ", ".join(f"{c} string" for c in END_COLUMNS))
    return events.select("key", body.alias("b")).select("key", "b.*")


def q_decoded_events(spark: SparkSession, sf: str) -> DataFrame:
    sp = start_path(_start_lines(spark, sf), _handoff(spark))
    decoded = sp.stages[1].accepted
    return _drop_internal(decoded).withColumn(
        "estimated_fare_amount", F.col("estimated_fare_amount").try_cast("double")
    )


def q_read_trips(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "trips")
    assemble_trips(_trip_events(spark, sf), "replay").write.mode("overwrite").parquet(path)
    return read_trips(spark, path)


# --- P1-P8 ---------------------------------------------------------------------------


def q_normalize_starts(spark: SparkSession, sf: str) -> DataFrame:
    return _starts(spark, sf)


def q_normalize_ends(spark: SparkSession, sf: str) -> DataFrame:
    return _ends(spark, sf)


def q_normalize_start_events(spark: SparkSession, sf: str) -> DataFrame:
    return start_path(_start_lines(spark, sf), _handoff(spark)).accepted


def q_distinct_dropoff_days(spark: SparkSession, sf: str) -> DataFrame:
    # Distinct end-side values over the inner join = over ends that have a
    # start: a semi join, which never fans out on repeated keys.
    matched = _ends(spark, sf).join(_starts(spark, sf).select("trip_id"), "trip_id", "left_semi")
    return distinct_values(matched, "dropoff_datetime")


def q_distinct_dropoff_times(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_values(S.paired_ends(spark, sf), "dropoff_datetime")


# --- V1-V6 ---------------------------------------------------------------------------


def q_valid_end_fields(spark: SparkSession, sf: str) -> DataFrame:
    return end_path(_end_lines(spark, sf), "coerce", _handoff(spark)).accepted


def q_strict_end_fields(spark: SparkSession, sf: str) -> DataFrame:
    return end_path(_end_lines(spark, sf), "strict", _handoff(spark)).accepted


def q_completed_trips(spark: SparkSession, sf: str) -> DataFrame:
    return completed(_joined(spark, sf))


def q_fully_described_trips(spark: SparkSession, sf: str) -> DataFrame:
    return fully_described(completed(_joined(spark, sf)))


# --- J1-J4 ---------------------------------------------------------------------------


def q_joined_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf)


def q_trips_put_only(spark: SparkSession, sf: str) -> DataFrame:
    ev = _trip_events(spark, sf)
    starts = ev.filter(F.col("kind") == "start")
    cols = ["seq", "trip_id", "pickup_location_id", "dropoff_location_id", "vendor_id",
            "pickup_datetime", "pickup_time", "estimated_dropoff_datetime",
            "estimated_dropoff_time", "estimated_fare_amount"]
    return keyed_put(starts.select(*cols))


def q_trips_update_only(spark: SparkSession, sf: str) -> DataFrame:
    ev = _trip_events(spark, sf)
    ends = ev.filter(F.col("kind") == "end")
    cols = ["seq", "trip_id", "dropoff_datetime", "rate_code", "passenger_count",
            "trip_distance", "fare_amount", "tip_amount", "payment_type", "trip_type"]
    return keyed_update(ends.select(*cols))


def q_trips_replay(spark: SparkSession, sf: str) -> DataFrame:
    return assemble_trips(_trip_events(spark, sf), "replay")


def q_trips_merge(spark: SparkSession, sf: str) -> DataFrame:
    return assemble_trips(_trip_events(spark, sf), "merge")


def q_trips_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Both line files through the whole event path to J4, in the order of the files."""
    starts = with_line_seq(_start_lines(spark, sf), 0)
    ends = with_line_seq(_end_lines(spark, sf), 1)
    return assemble_from_lines(starts, ends, handoff=_handoff(spark))[0]


def q_trips_replay_stream(spark: SparkSession, sf: str) -> DataFrame:
    """J4 as a streaming aggregation over event files, out of order.

    The events are written as several files split by a hash of ``seq``, so
    every micro-batch holds events of many trips in no particular order.
    """
    src = scratch_path(spark, "trip-events")
    events = _trip_events(spark, sf)
    events.repartition(default_parallelism(spark), F.xxhash64("seq")).write.mode("overwrite").parquet(src)
    stream = read_event_stream(spark, src, events.schema, "parquet", max_files_per_trigger=1)
    out = scratch_path(spark, "trip-table")
    q = start_trip_table(stream, out, scratch_path(spark, "trip-table-checkpoint"), "replay")
    q.awaitTermination()
    return read_trip_table(spark, out)


def _received(spark: SparkSession, sf: str) -> DataFrame:
    return S.received_events(spark, sf, default_parallelism(spark))


def _received_stream(spark: SparkSession, sf: str) -> str:
    """Received records as files for the stream, dealt by a hash of the event; the folder of the finished run.

    Every micro-batch holds records of many trips in no particular order, and
    the deltas are compacted in the middle of the run.
    """
    src, out = scratch_path(spark, "received"), scratch_path(spark, "event-path")
    _received(spark, sf).write.mode("overwrite").parquet(src)  # one file per core

    def compact_once(output: str) -> None:
        if output == "report" and not done:
            done.append(TripStore(spark, out).compact())

    done: list[int] = []
    stream = read_event_stream(spark, src, RECEIVED, "parquet", max_files_per_trigger=3)
    start_event_path(stream, out, scratch_path(spark, "event-path-checkpoint"), after=compact_once).awaitTermination()
    return out


def q_events_to_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Received records to J4 in one batch."""
    starts, ends = trace_received(_received(spark, sf))
    return assemble_trips(trip_events(starts.accepted, ends.accepted), "replay")


def q_events_to_trips_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Received records to the live trip store, base and deltas merged."""
    return TripStore(spark, _received_stream(spark, sf)).trips("replay")


def q_quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every refusal and note of the received records, with the record."""
    starts, ends = trace_received(_received(spark, sf))
    return starts.quarantine.unionByName(ends.quarantine)


def q_quarantine_rows_stream(spark: SparkSession, sf: str) -> DataFrame:
    return read_stream_quarantine(spark, _received_stream(spark, sf))


def q_consumer_report(spark: SparkSession, sf: str) -> DataFrame:
    """Processed and refused records of each consumer stage."""
    starts, ends = trace_received(_received(spark, sf))
    return starts.report.unionByName(ends.report)


def q_consumer_report_stream(spark: SparkSession, sf: str) -> DataFrame:
    return read_stream_report(spark, _received_stream(spark, sf))


# --- A0-A4 ---------------------------------------------------------------------------


def q_daily_kpis_completed_by_pickup(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_kpis(kpis_over_join(_starts(spark, sf), _ends(spark, sf), by="pickup"))


def q_daily_kpis_all(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_kpis(kpis_over_join(_starts(spark, sf), _ends(spark, sf), by="pickup", completed_only=False))


def q_daily_kpis_completed_by_dropoff(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_kpis(kpis_over_join(_starts(spark, sf), _ends(spark, sf), by="dropoff"))


def q_run_report(spark: SparkSession, sf: str) -> DataFrame:
    sp = start_path(_start_lines(spark, sf), _handoff(spark))
    ep = end_path(_end_lines(spark, sf), handoff=_handoff(spark))
    return sp.report.unionByName(ep.report)


def q_kpis_large(spark: SparkSession, sf: str) -> DataFrame:
    starts = normalize_starts(S.large_starts(spark, sf))
    ends = normalize_ends(S.large_ends(spark, sf))
    return rounded_kpis(kpis_over_join(starts, ends, by="pickup"))


def q_kpis_large_by_dropoff(spark: SparkSession, sf: str) -> DataFrame:
    starts = normalize_starts(S.large_starts(spark, sf))
    ends = S.large_ends(spark, sf).withColumn("fare_amount", F.round("fare_amount", 2))
    return rounded_kpis(kpis_over_join(starts, ends, by="dropoff"))


# --- K1, R1, R2 ----------------------------------------------------------------------


def q_write_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """The KPI job's four outputs written and read back: rows per dataset."""
    trips_path = scratch_path(spark, "trips")
    assemble_trips(_trip_events(spark, sf), "replay").write.mode("overwrite").parquet(trips_path)
    outputs = kpi_job_outputs(read_trips(spark, trips_path))
    base = scratch_path(spark, "kpis")
    paths = write_outputs(
        outputs,
        base,
        layouts={"completed_trips": {"n": default_parallelism(spark), "by": "trip_id", "sort_by": "rate_code"}},
    )
    counts = [
        spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("dataset"), "n"
        )
        for name, p in paths.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def q_kpi_job_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values of the KPI job's outputs read back, with both grains of the drop-off key."""
    trips_path = scratch_path(spark, "trips")
    assemble_trips(_trip_events(spark, sf), "replay").write.mode("overwrite").parquet(trips_path)
    by_day = run_kpi_job(spark, trips_path, scratch_path(spark, "kpis"))
    raw = run_kpi_job(spark, trips_path, scratch_path(spark, "kpis-raw"), grain="raw")

    def values(name: str, path: str, key: str) -> DataFrame:
        day = F.date_format(F.col(key).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
        return rounded_kpis(spark.read.parquet(path)).select(
            F.lit(name).alias("dataset"), day.alias("day"),
            "total_fare", "count_trips", "average_fare", "max_fare", "min_fare")

    return (values("all_trips_daily_kpis", by_day["all_trips_daily_kpis"], "pickup_datetime")
            .unionByName(values("completed_trips_daily_kpis", by_day["completed_trips_daily_kpis"], "DAY"))
            .unionByName(values("raw_grain", raw["completed_trips_daily_kpis"], "DAY")))


def q_kpi_published_values(spark: SparkSession, sf: str) -> DataFrame:
    """The KPI outputs as a version published at once, after an older version of fewer trips."""
    trips_path, base = scratch_path(spark, "trips"), scratch_path(spark, "kpi-versions")
    trips = assemble_trips(_trip_events(spark, sf), "replay")
    for some in (completed(trips), trips):
        some.write.mode("overwrite").parquet(trips_path)
        run_kpi_job(spark, trips_path, base, together=True)
    keys = {"all_trips_daily_kpis": "pickup_datetime", "completed_trips_daily_kpis": "DAY"}
    frames = [rounded_kpis(read_published(spark, base, name)).select(
        F.lit(name).alias("dataset"), F.date_format(key, "yyyy-MM-dd").alias("day"),
        "total_fare", "count_trips", "average_fare", "max_fare", "min_fare") for name, key in keys.items()]
    return frames[0].unionByName(frames[1])


def q_layout_rows(spark: SparkSession, sf: str) -> DataFrame:
    """R1 and R2 as written by the KPI job: rows, and whether the files are even and each is sorted.

    Half of the trips are given one pickup day and a sixth none, so that files by day alone would not be even.
    """
    trips_path, n = scratch_path(spark, "trips"), default_parallelism(spark)
    third = F.pmod(F.xxhash64("trip_id"), F.lit(6))
    trips = assemble_trips(_trip_events(spark, sf), "replay").withColumn(
        "pickup_datetime", F.when(third < 3, F.lit("2024-02-01").cast("date")).when(third < 5, F.col("pickup_datetime")))
    trips.write.mode("overwrite").parquet(trips_path)
    paths = run_kpi_job(spark, trips_path, scratch_path(spark, "kpis"), completed_files=n, sort_by="rate_code", even=True)
    rows = spark.read.parquet(paths["completed_trips"]).select(
        "rate_code", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    before = F.lag(F.struct("rate_code")).over(Window.partitionBy("file").orderBy("at"))
    files = rows.withColumn("falls", before > F.struct("rate_code")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max("falls"), F.lit(False)).alias("falls"))
    return files.agg(F.sum("n").alias("n"), (F.max("n") <= 2 * F.sum("n") / F.lit(n)).alias("even"),
                     (~F.max("falls")).alias("ordered"))


QUERIES: dict[str, Query] = {
    "csv_scan": q_csv_scan,
    "csv_scan_ends": q_csv_scan_ends,
    "csv_rejects": q_csv_rejects,
    "event_log": q_event_log,
    "parse_start_lines": q_parse_start_lines,
    "parse_end_lines": q_parse_end_lines,
    "line_rejects": q_line_rejects,
    "start_events": q_start_events,
    "end_events": q_end_events,
    "decoded_events": q_decoded_events,
    "read_trips": q_read_trips,
    "normalize_starts": q_normalize_starts,
    "normalize_ends": q_normalize_ends,
    "normalize_start_events": q_normalize_start_events,
    "valid_end_fields": q_valid_end_fields,
    "strict_end_fields": q_strict_end_fields,
    "completed_trips": q_completed_trips,
    "fully_described_trips": q_fully_described_trips,
    "distinct_dropoff_days": q_distinct_dropoff_days,
    "distinct_dropoff_times": q_distinct_dropoff_times,
    "joined_trips": q_joined_trips,
    "trips_put_only": q_trips_put_only,
    "trips_update_only": q_trips_update_only,
    "trips_replay": q_trips_replay,
    "trips_merge": q_trips_merge,
    "trips_from_lines": q_trips_from_lines,
    "trips_replay_stream": q_trips_replay_stream,
    "events_to_trips": q_events_to_trips,
    "events_to_trips_stream": q_events_to_trips_stream,
    "quarantine_rows": q_quarantine_rows,
    "quarantine_rows_stream": q_quarantine_rows_stream,
    "consumer_report": q_consumer_report,
    "consumer_report_stream": q_consumer_report_stream,
    "daily_kpis_completed_by_pickup": q_daily_kpis_completed_by_pickup,
    "daily_kpis_all": q_daily_kpis_all,
    "daily_kpis_completed_by_dropoff": q_daily_kpis_completed_by_dropoff,
    "run_report": q_run_report,
    "write_outputs": q_write_outputs,
    "kpi_job_values": q_kpi_job_values,
    "kpi_published_values": q_kpi_published_values,
    "layout_rows": q_layout_rows,
    "kpis_large": q_kpis_large,
    "kpis_large_by_dropoff": q_kpis_large_by_dropoff,
}
