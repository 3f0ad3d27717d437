"""Event path from received records: one pass, several outputs, restart, compaction."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tripcraft.operators import assemble_trips, quarantine, run_report
from tripcraft.plans import queries as Q
from tripcraft.plans.events import END_BODY, START_BODY, consume_end_events, consume_start_events, trip_events
from tripcraft.session import scratch_path
from tripcraft.sinks.versions import current
from tripcraft.sources import supplied as S
from tripcraft.sources.events import decode_events
from tripcraft.streaming import (
    RECEIVED,
    TripStore,
    process_batch,
    read_event_stream,
    read_stream_quarantine,
    read_stream_report,
    start_event_path,
    trace_received,
)

SF = "/root/testdata/sf0.001"


def same(a, b):
    b = b.select(*a.columns)
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.fixture(scope="module")
def received(spark):
    path = scratch_path(spark, "received")
    S.received_events(spark, SF).repartition(6, F.xxhash64("seq")).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def batch(spark, received):
    return trace_received(spark.read.parquet(received))


@pytest.fixture(scope="module")
def trips(batch):
    return assemble_trips(trip_events(*[t.accepted for t in batch]), "replay")


def test_one_pass_equals_stage_by_stage(spark, received, batch):
    """Same accepted rows, quarantine and counters as stages that filter one after another."""
    rows = spark.read.parquet(received)
    for kind, consume, traced in (("start", consume_start_events, batch[0]), ("end", consume_end_events, batch[1])):
        stages, accepted = consume(rows.where(F.col("kind") == kind).select("data", "seq"))
        assert same(accepted.drop("_record"), traced.accepted)
        assert same(quarantine(*stages), traced.quarantine)
        assert same(run_report(*stages), traced.report)


def test_later_stages_say_nothing_about_refused_records(spark):
    """No base64 means no key and no field either, but only the decoder refuses it."""
    rows = spark.createDataFrame([("start", "%", 1), ("end", "%", 2)], RECEIVED)
    for traced in trace_received(rows):
        assert [(r.reason, r.record) for r in traced.quarantine.collect()] == [("undecodable", "%")]
        assert [(r.stage, r.outcome, r.n) for r in traced.report.collect()] == [(traced.stages[0], "failed", 1)]


def test_every_note_of_a_record(spark):
    body = ('{"trip_id": "a", "vendor_id": "x", "pickup_location_id": 1.5, "dropoff_location_id": [], '
            '"pickup_datetime": "?", "estimated_dropoff_datetime": "!", "estimated_fare_amount": "-"}')
    rows = spark.createDataFrame([("start", body, 1)], RECEIVED).withColumn("data", F.base64(F.encode("data", "UTF-8")))
    got = trace_received(rows)[0].quarantine.collect()
    assert sorted(r.reason for r in got) == [
        "bad_dropoff_location_id", "bad_estimated_fare_amount", "bad_pickup_location_id", "bad_vendor_id",
        "malformed_estimated_dropoff_datetime", "malformed_pickup_datetime"]
    assert {(r.record, r.trip_id) for r in got} == {(body, "a")}


def test_report_and_rejects_scan_each_input_once(spark):
    lines, events = Q.q_run_report(spark, SF), Q.q_line_rejects(spark, SF)
    for df in (lines, events):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 4  # lines and received events of both kinds
    traced = trace_received(S.received_events(spark, SF))[0]
    plan = traced.report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("output", ["staged", "deltas", "quarantine"])
def test_restart_between_two_outputs(spark, received, batch, trips, output):
    """A batch that ends after some of its outputs is repeated as a whole."""
    out, checkpoint = scratch_path(spark, "restart"), scratch_path(spark, "restart-checkpoint")
    seen = []

    def fail_once(written):
        seen.append(written)
        if seen.count(output) == 2 and written == output:
            raise RuntimeError("executor lost")

    def run():
        stream = read_event_stream(spark, received, RECEIVED, max_files_per_trigger=2)
        start_event_path(stream, out, checkpoint, after=fail_once).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert same(TripStore(spark, out).trips(), trips)
    assert same(read_stream_quarantine(spark, out), batch[0].quarantine.unionByName(batch[1].quarantine))
    assert same(read_stream_report(spark, out), batch[0].report.unionByName(batch[1].report))


def test_store_while_it_is_compacted(spark, received, trips, monkeypatch):
    """Readers see the same trips before, while and after compaction; the base isn't shuffled."""
    out = scratch_path(spark, "store")
    store = TripStore(spark, out, buckets=4)
    parts = spark.read.parquet(received).withColumn("b", F.pmod("seq", F.lit(3))).cache()
    for b in (0, 1):
        process_batch(parts.where(F.col("b") == b).drop("b"), b, out)
    first = assemble_trips(trip_events(*[
        t.accepted for t in trace_received(parts.where("b < 2").drop("b"))]), "replay")
    assert same(store.trips(), first)
    during = []
    monkeypatch.setattr("tripcraft.streaming.store.publish", lambda *a: during.append((a, store.trips().collect())))
    store.compact()  # everything but the pointer
    assert during and sorted(map(repr, during[0][1])) == sorted(map(repr, store.trips().collect()))
    monkeypatch.undo()
    assert store.compact() == 0 and current(spark, out)[1]["upto"] == 1
    assert same(store.trips(), first)
    process_batch(parts.where("b = 2").drop("b"), 2, out)
    assert same(store.trips(), trips)
    plan = store.trips()._jdf.queryExecution().executedPlan().toString()
    base = plan[plan.index("FullOuter"):plan.index("Bucketed: true")]
    assert "trip_base" in base and "Exchange" not in base  # the deltas come after the base
    assert store.compact() == 1 and store.compact() == 1
    assert same(store.trips(), trips)
    assert same(store.trips("merge"), assemble_trips(trip_events(*[
        t.accepted for t in trace_received(spark.read.parquet(received))]), "merge"))


def test_store_with_one_trip_holding_a_third(spark):
    rows = [(seq, "start" if seq % 7 == 0 else "end", "hot" if seq % 3 == 0 else f"t{seq % 40}", float(seq))
            for seq in range(900)]
    events = spark.createDataFrame(rows, "seq long, kind string, trip_id string, fare_amount double")
    full = trip_events(events.where("kind = 'start'").drop("fare_amount"), events.where("kind = 'end'"))
    store = TripStore(spark, scratch_path(spark, "hot"), buckets=3)
    for b in range(3):
        store.add(full.where(F.pmod("seq", F.lit(3)) == b), b)
        if b == 1:
            store.compact()
    assert same(store.trips(), assemble_trips(full, "replay"))


def _sent(spark, rows):
    """Received records of (kind, trip, time, seq)."""
    field = {"start": "pickup_datetime", "end": "dropoff_datetime"}
    return spark.createDataFrame([
        (kind, json.dumps({"trip_id": trip, "fare_amount": float(seq), **({field[kind]: time} if time else {})}), seq)
        for kind, trip, time, seq in rows], RECEIVED).withColumn("data", F.base64(F.encode("data", "UTF-8")))


@pytest.mark.parametrize("expire_after", [None, "2 DAYS"])
def test_late_events_go_to_the_quarantine(spark, expire_after):
    """Batches whose newest times are 10, 20 (and again 20) May: an event counts as late only against earlier batches."""
    batches = [
        [("start", "a", "2024-05-10 09:00:00", 1), ("end", "old", "2024-05-01 00:00:00", 2)],  # nothing seen before
        [("start", "b", "2024-05-20 09:00:00", 3), ("end", "a", "2024-05-07 23:59:59", 4), ("end", "a", "2024-05-08 00:00:00", 5)],
        [("start", "c", "2024-05-17 09:00:00", 6), ("start", "d", "2024-05-16 09:00:00", 7), ("end", "a", None, 8),
         ("end", "b", "2024-05-17 23:00:00", 9), ("end", "b", "2024-05-18 00:00:00", 10)],
    ]
    out = scratch_path(spark, "expiry")
    for n, rows in enumerate(batches):
        for _ in range(1 + (n == 1)):  # a repeated batch refuses the same events
            process_batch(_sent(spark, rows), n, out, expire_after=expire_after)
    late = {4, 7, 9} if expire_after else set()
    refused = read_stream_quarantine(spark, out).where("reason like 'late%'").collect()
    assert sorted(json.loads(r.record)["fare_amount"] for r in refused) == sorted(map(float, late))
    assert {(r.stage, r.reason, r.trip_id) for r in refused} == (
        {("expiry_end", "late_end", "a"), ("expiry_start", "late_start", "d"), ("expiry_end", "late_end", "b")} if late else set())
    on_time = _sent(spark, [r for rows in batches for r in rows if r[3] not in late])
    assert same(TripStore(spark, out).trips(), assemble_trips(
        trip_events(*[x.accepted for x in trace_received(on_time)]), "replay"))
    failed = read_stream_report(spark, out).where("outcome = 'failed' and reason like 'late%'").groupBy().sum("n").first()[0]
    assert (failed or 0) == len(late)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_quarantine_evaluates_every_rule_once(batch):
    """No filter on the outcomes is pushed below the stages with their rules inlined."""
    for traced, rule in zip(batch, ("malformed_pickup_datetime", "malformed_dropoff_datetime"), strict=True):
        assert plan_of(traced.quarantine).count(f"THEN {rule}") == 1


def test_body_is_walked_once_for_each_type(spark):
    """Odd values of a body read in one walk: fractions, numbers as text, nested values, nulls and no objects."""
    bodies = ['{"trip_id":7,"vendor_id":"3","pickup_location_id":2.0,"dropoff_location_id":2.5,"pickup_datetime":{"a":[1]}}',
              '{"trip_id":null,"vendor_id":true,"pickup_location_id":1e30,"dropoff_location_id":null,"x":1}',
              "{}", "[]", "null", "3", '{"trip_id":1,"trip_id":2}', '{"trip_id"']
    raw = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "seq long, data string").withColumn(
        "data", F.base64(F.encode("data", "UTF-8")))
    tagged = decode_events(raw, START_BODY, "coerce").tagged
    assert plan_of(tagged).count("try_variant_get(") == 3  # the fields, and the integers as numbers and texts
    assert plan_of(decode_events(raw, END_BODY, "coerce").tagged).count("try_variant_get(") == 1
    got = {r.seq: (r.trip_id, r.vendor_id, r.pickup_location_id, r.dropoff_location_id, r.pickup_datetime, r._reason, r._note)
           for r in tagged.collect()}
    none = (None,) * 5
    assert got == {
        0: ("7", 3, 2, None, '{"a":[1]}', None, ["bad_dropoff_location_id"]),
        1: (None, 1, None, None, None, None, ["bad_pickup_location_id"]),
        2: (*none, None, []), **{i: (*none, "undecodable", []) for i in range(3, 8)}}


def test_received_rows_are_dealt_before_bodies_are_built(spark):
    """One input file, many partitions with rows, and the same records."""
    dealt = Q._received(spark, SF)
    assert dealt.select(F.spark_partition_id()).distinct().count() > 1
    assert same(dealt, S.received_events(spark, SF))


def test_micro_batch_of_one_file_is_decoded_by_several_tasks(spark, received, batch):
    one, out = scratch_path(spark, "one-file"), scratch_path(spark, "one-file-batch")
    spark.read.parquet(received).coalesce(1).write.parquet(one)
    files = []
    process_batch(spark.read.schema(RECEIVED).parquet(one), 0, out, after=lambda output: output == "staged" and files.extend(
        r[0] for r in spark.read.parquet(f"{out}/staged").where("kind = 'start'").select(F.input_file_name()).distinct().collect()))
    assert len({f.rsplit("/", 1)[1] for f in files}) > 1
    assert same(read_stream_quarantine(spark, out), batch[0].quarantine.unionByName(batch[1].quarantine))
    assert same(read_stream_report(spark, out), batch[0].report.unionByName(batch[1].report))
