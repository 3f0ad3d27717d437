"""K1 outputs, R1/R2 layout, one-pass accepted/refused split, line order."""

import pytest
from pyspark.sql import functions as F

from tripcraft.operators import layout
from tripcraft.plans.kpi_job import run_kpi_job
from tripcraft.session import scratch_path
from tripcraft.sinks import OUTPUT_NAMES, write_checked
from tripcraft.sources import parse_start_lines, read_lines, with_line_seq
from tripcraft.schemas import START_HEADER


def _trips(spark):
    return spark.createDataFrame(
        [
            ("1", "2023-01-01", "2023-01-01 10:30:00", 16.0, "1"),
            ("2", "2023-01-01", None, 20.0, None),
            ("3", "2023-01-02", "2023-01-03 09:00:00", None, "2"),
        ],
        "trip_id string, pickup_datetime string, dropoff_datetime string, fare_amount double, "
        "rate_code string",
    ).withColumns(
        {
            "pickup_datetime": F.to_date("pickup_datetime"),
            "dropoff_datetime": F.to_timestamp_ntz("dropoff_datetime"),
        }
    )


def test_kpi_job_writes_four_outputs(spark):
    src = scratch_path(spark, "trips-src")
    _trips(spark).write.parquet(src)
    out = scratch_path(spark, "kpi-out")
    paths = run_kpi_job(spark, src, out, partition_by={"completed_trips": "pickup_datetime"},
                        completed_files=2)
    assert set(paths) == set(OUTPUT_NAMES)
    counts = {n: spark.read.parquet(p).count() for n, p in paths.items()}
    assert counts == {"trips_copy": 3, "completed_trips": 2, "all_trips_daily_kpis": 2,
                      "completed_trips_daily_kpis": 2}
    day = spark.read.parquet(paths["completed_trips_daily_kpis"]).orderBy("DAY").first()
    assert (day.total_fare, day.count_trips) == (16.0, 1)
    # Rerun overwrites: same result, not doubled.
    run_kpi_job(spark, src, out)
    assert spark.read.parquet(paths["trips_copy"]).count() == 3


def test_kpi_job_refuses_to_overwrite_its_input(spark):
    base = scratch_path(spark, "one-base")
    _trips(spark).write.parquet(f"{base}/trips")
    paths = run_kpi_job(spark, f"{base}/trips", base)  # the usual layout: one base for both jobs
    assert spark.read.parquet(f"{base}/trips").count() == 3
    for source in (paths["completed_trips"], f"file:{paths['trips_copy']}/"):
        with pytest.raises(ValueError, match="overwrite its input"):
            run_kpi_job(spark, source, base)
    assert spark.read.parquet(paths["trips_copy"]).count() == 3


def test_java_number_texts_and_wide_ids(spark):
    lines = spark.createDataFrame(
        [(f"t{i},{x},1,1,2021-01-01 00:00:00,2021-01-01 00:10:00,{y}",) for i, (x, y) in enumerate(
            [(3_000_000_000, "12"), (1, "12d"), (1, "0x1p3"), (1, "1.5e1"), (1, "12f"), ("1.7", "1")])],
        "value string")
    checked = parse_start_lines(lines)
    assert sorted(r.trip_id for r in checked.accepted.collect()) == ["t0", "t3"]


def test_layout_repartition_and_sort(spark):
    df = layout(_trips(spark), n=2, by="pickup_datetime", sort_by="rate_code")
    assert df.rdd.getNumPartitions() == 2
    for part in df.rdd.glom().collect():
        codes = [r.rate_code for r in part]
        assert codes == sorted(codes, key=lambda c: (c is not None, c))


def test_write_checked_one_pass(spark):
    lines = spark.createDataFrame(
        [(START_HEADER,), ("1,1,2,1,a,b,3.5",), ("2,1,2",), ("3,x,2,1,a,b,1",)], "value string")
    accepted, rejected = write_checked(parse_start_lines(lines), scratch_path(spark, "checked"))
    assert spark.read.parquet(accepted).count() == 1
    rej = {r.reason for r in spark.read.parquet(rejected).collect()}
    assert rej == {"field_count", "bad_number"}


def test_line_seq_follows_files_and_blocks(spark):
    """A small early file, a large late one cut into many blocks, and the ends last."""
    base = scratch_path(spark, "line-order")
    for name, first, n in (("a", 0, 3), ("b", 3, 2000)):
        rows = [(str(i).zfill(8),) for i in range(first, first + n)]
        spark.createDataFrame(rows, "value string").coalesce(1).write.text(f"{base}/{name}")
    spark.createDataFrame([("ends",)], "value string").coalesce(1).write.text(f"{base}/ends")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        starts = with_line_seq(read_lines(spark, [f"{base}/b", f"{base}/a"]), 0)
        assert starts.rdd.getNumPartitions() > 2
        lines = starts.unionByName(with_line_seq(read_lines(spark, f"{base}/ends"), 1))
        got = [r.value for r in lines.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [str(i).zfill(8) for i in range(2003)] + ["ends"]
