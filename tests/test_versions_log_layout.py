"""Published versions, the ordered event log, CSV quarantine and even files."""

import pytest
from pyspark.sql import functions as F

from tripcraft.operators import layout
from tripcraft.plans import kpi_job
from tripcraft.plans.kpi_job import run_kpi_job
from tripcraft.schemas import TRIP_START
from tripcraft.session import scratch_path
from tripcraft.sinks import current, read_published
from tripcraft.sources import EventLog, check_trips_csv, read_trips_csv


def trips(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("trip_id"), F.lit("2024-03-01").cast("date").alias("pickup_datetime"),
        F.lit("2024-03-01 10:00:00").cast("timestamp_ntz").alias("dropoff_datetime"),
        F.lit(2.5).alias("fare_amount"), F.lit("1").alias("rate_code"))


def test_failure_between_outputs_leaves_the_old_set(spark, monkeypatch):
    src, base = scratch_path(spark, "trips"), scratch_path(spark, "versions")
    trips(spark, 10).write.parquet(src)
    run_kpi_job(spark, src, base, together=True)
    trips(spark, 25).write.mode("overwrite").parquet(src)
    write = kpi_job.write_outputs

    def fail_after_two(outputs, folder, **options):
        write(dict(list(outputs.items())[:2]), folder, **options)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(kpi_job, "write_outputs", fail_after_two)
    with pytest.raises(RuntimeError):
        run_kpi_job(spark, src, base, together=True)
    assert current(spark, base)[0] == 0
    assert read_published(spark, base, "trips_copy").count() == 10
    assert read_published(spark, base, "all_trips_daily_kpis").first()["count_trips"] == 10
    monkeypatch.undo()
    run_kpi_job(spark, src, base, together=True)
    assert current(spark, base)[0] == 1
    assert read_published(spark, base, "trips_copy").count() == 25
    assert read_published(spark, base, "completed_trips_daily_kpis").first()["count_trips"] == 25
    with pytest.raises(ValueError):
        run_kpi_job(spark, read_published(spark, base, "trips_copy").inputFiles()[0], base, together=True)


def _events(spark, first, n):
    return spark.range(first, first + n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").cast("string").alias("value"), F.col("id").alias("at")).repartition(5)


def test_log_numbers_without_gaps_over_appends(spark):
    log = EventLog(spark, scratch_path(spark, "log"), buckets=3)
    assert log.append(_events(spark, 0, 500), ["at"]) == (0, 500)
    assert log.append(_events(spark, 500, 0), ["at"]) == (500, 500)
    assert log.append(_events(spark, 500, 321)) == (500, 821)
    rows = log.read().collect()
    assert sorted(r.seq for r in rows) == list(range(821))
    assert all(r.seq == r["at"] for r in rows if r["at"] < 500)  # in order of ``at``
    assert sorted(r["at"] for r in rows) == list(range(821))


def test_log_after_a_failure_before_publishing(spark, monkeypatch):
    log = EventLog(spark, scratch_path(spark, "log"), buckets=2)
    log.append(_events(spark, 0, 40), ["at"])
    monkeypatch.setattr("tripcraft.sources.event_log.publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        log.append(_events(spark, 40, 30), ["at"])
    assert log.read().count() == 40  # a segment counts once it is published
    monkeypatch.undo()
    assert log.append(_events(spark, 70, 20), ["at"]) == (70, 90)  # the finished segment is kept
    rows = log.read().collect()
    assert sorted((r.seq, r["at"]) for r in rows) == [(i, i) for i in range(90)]


def test_log_as_a_stream(spark):
    log = EventLog(spark, scratch_path(spark, "log"), buckets=3)
    for first in (0, 60):
        log.append(_events(spark, first, 60), ["at"])
    out = scratch_path(spark, "log-stream")
    stream = log.read_stream(log.read().schema, max_files_per_trigger=1)
    query = (stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "log-checkpoint"))
             .trigger(availableNow=True).start(out))
    query.awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == list(range(120))


def test_csv_fields_that_do_not_parse_are_named(spark, tmp_path):
    header = ",".join(TRIP_START.fieldNames())
    lines = ["a,1,2,3,2024-01-01 10:00:00,2024-01-01T10:10:00,1.5", "b,x,2.0,3,noon,,", "c,1,2",
             "d,1,2,3,2024-01-01,2024-01-01 10:00,9,more", '"e,e",1,2,3,2024-01-01 10:00:00,,12d']
    (tmp_path / "t.csv").write_text("\n".join([header, *lines]) + "\n")
    checked = check_trips_csv(spark, str(tmp_path), TRIP_START)
    got = sorted((r.trip_id, r.reason) for r in checked.rejects.collect())
    assert got == [("b", "bad_dropoff_location_id"), ("b", "bad_pickup_datetime"), ("b", "bad_pickup_location_id"),
                   ("c", "field_count"), ("d", "field_count"), ("e,e", "bad_estimated_fare_amount")]
    records = {r.reason: r.record for r in checked.rejects.collect()}
    assert records["field_count"] in lines[2:4] and '"pickup_datetime":"noon"' in records["bad_pickup_datetime"]
    rows = {r.trip_id: r for r in checked.accepted.drop("_record").collect()}
    assert set(rows) == {"a", "b", "c", "d", "e,e"} and rows["b"].vendor_id == 3 and rows["b"].pickup_datetime is None
    plain = {r.trip_id: r for r in read_trips_csv(spark, str(tmp_path), TRIP_START).collect()}
    assert rows["a"] == plain["a"] and checked.tagged.schema[4].dataType == TRIP_START[4].dataType


def test_even_files_with_a_hot_day_and_the_null_day(spark):
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-01-07")).when(F.col("id") % 3 == 1, F.date_format(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")), "yyyy-MM-dd"))
    df = spark.range(12000).select(F.col("id").cast("string").alias("trip_id"), day.cast("date").alias("d"))
    out = scratch_path(spark, "even")
    layout(df, n=6, by="d", even=True, sort_by="trip_id").write.parquet(out)
    sizes = [r["count"] for r in spark.read.parquet(out).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 12000 and max(sizes) <= 2 * 12000 / 6
    by_day = scratch_path(spark, "by-day")
    layout(df, n=6, by="d").write.parquet(by_day)
    sizes = [r["count"] for r in spark.read.parquet(by_day).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(sizes) >= 4000  # what the even layout avoids
