"""Keyed merge J2-J4: the hand-checked replay case, merge mode, batch = stream."""

import random

from pyspark.sql import functions as F

from tripcraft.operators import assemble_trips, keyed_put, keyed_update
from tripcraft.session import scratch_path
from tripcraft.streaming import read_event_stream, read_trip_table, start_trip_table

SCHEMA = ("seq long, trip_id string, kind string, pickup_location_id int, "
          "fare_amount double, payment_type string")

# FIXTURES.md section 6 merge case (pickup stands in as a location id).
EVENTS = [
    (1, "a", "start", 1, None, None),
    (2, "a", "end", None, 10.0, "x"),
    (3, "a", "end", None, None, "y"),
    (4, "b", "end", None, 5.0, "z"),
    (5, "b", "start", 2, None, None),
    (6, "c", "end", None, 7.0, None),
    (7, "b", "end", None, None, "w"),
]


def _trips(df):
    return {r.trip_id: (r.pickup_location_id, r.fare_amount, r.payment_type) for r in df.collect()}


def test_replay_case(spark):
    ev = spark.createDataFrame(EVENTS, SCHEMA)
    assert _trips(assemble_trips(ev, "replay")) == {
        "a": (1, 10.0, "y"), "b": (2, None, "w"), "c": (None, 7.0, None)}


def test_merge_case(spark):
    ev = spark.createDataFrame(EVENTS, SCHEMA)
    assert _trips(assemble_trips(ev, "merge"))["b"] == (2, 5.0, "w")


def test_put_and_update_alone(spark):
    ev = spark.createDataFrame(EVENTS, SCHEMA)
    puts = keyed_put(ev.filter("kind = 'start'").select("seq", "trip_id", "pickup_location_id"))
    assert {r.trip_id: r.pickup_location_id for r in puts.collect()} == {"a": 1, "b": 2}
    ups = keyed_update(ev.filter("kind = 'end'").select("seq", "trip_id", "fare_amount", "payment_type"))
    assert {r.trip_id: (r.fare_amount, r.payment_type) for r in ups.collect()} == {
        "a": (10.0, "y"), "b": (5.0, "w"), "c": (7.0, None)}


def _sequential_replay(events):
    """Plain Python replay of the keyed store, for comparison."""
    table = {}
    for seq, trip, kind, loc, fare, pay in sorted(events):
        if kind == "start":
            table[trip] = {"pickup_location_id": loc, "fare_amount": None, "payment_type": None}
        else:
            row = table.setdefault(trip, {"pickup_location_id": None, "fare_amount": None,
                                          "payment_type": None})
            if fare is not None:
                row["fare_amount"] = fare
            if pay is not None:
                row["payment_type"] = pay
    return {t: (r["pickup_location_id"], r["fare_amount"], r["payment_type"]) for t, r in table.items()}


def _random_events(n=400, trips=40, seed=7):
    rnd = random.Random(seed)
    out = []
    for seq in range(n):
        trip = f"t{rnd.randrange(trips)}"
        if rnd.random() < 0.3:
            out.append((seq, trip, "start", rnd.randrange(100), None, None))
        else:
            fare = rnd.choice([None, float(rnd.randrange(1, 50))])
            pay = rnd.choice([None, "cash", "card"])
            if fare is None and pay is None:
                pay = "cash"  # V3: an end carries at least one valid field
            out.append((seq, trip, "end", None, fare, pay))
    return out


def test_replay_matches_sequential_replay(spark):
    events = _random_events()
    shuffled = events[:]
    random.Random(1).shuffle(shuffled)
    got = _trips(assemble_trips(spark.createDataFrame(shuffled, SCHEMA), "replay"))
    assert got == _sequential_replay(events)


def test_batch_equals_stream(spark):
    events = _random_events(seed=11)
    df = spark.createDataFrame(events, SCHEMA)
    src = scratch_path(spark, "stream-src")
    # Out of order and split over several files -> several micro-batches.
    df.repartition(5, F.xxhash64("seq")).write.parquet(src)
    stream = read_event_stream(spark, src, df.schema, max_files_per_trigger=2)
    out = scratch_path(spark, "stream-out")
    q = start_trip_table(stream, out, scratch_path(spark, "stream-ckpt"), "replay")
    q.awaitTermination()
    assert q.lastProgress is not None
    streamed = read_trip_table(spark, out).select("trip_id", "pickup_location_id", "fare_amount",
                                                  "payment_type")
    assert _trips(streamed) == _trips(assemble_trips(df, "replay"))
    # The trips table has one partition folder per micro-batch.
    assert spark.read.parquet(out).select("batch_id").distinct().count() >= 2


def test_compact_keeps_newest_row(spark):
    events = _random_events(seed=3)
    df = spark.createDataFrame(events, SCHEMA)
    src = scratch_path(spark, "compact-src")
    df.repartition(3, F.xxhash64("seq")).write.parquet(src)
    out = scratch_path(spark, "compact-out")
    q = start_trip_table(read_event_stream(spark, src, df.schema, max_files_per_trigger=1), out,
                         scratch_path(spark, "compact-ckpt"), "replay")
    q.awaitTermination()
    from tripcraft.streaming import compact

    base = compact(spark, out, scratch_path(spark, "compact-base"))
    cols = ["trip_id", "pickup_location_id", "fare_amount", "payment_type"]
    assert _trips(read_trip_table(spark, base).select(*cols)) == _trips(
        assemble_trips(df, "replay"))


def test_stream_reports_event_counts(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    src = scratch_path(spark, "observe-src")
    df.coalesce(1).write.parquet(src)
    q = start_trip_table(read_event_stream(spark, src, df.schema), scratch_path(spark, "observe-out"),
                         scratch_path(spark, "observe-ckpt"), "replay")
    q.awaitTermination()
    metrics = [p["observedMetrics"]["trip_events"] for p in q.recentProgress
               if p.get("observedMetrics")]
    assert sum(m["events"] for m in metrics) == 7
    assert sum(m["starts"] for m in metrics) == 2


def test_hot_trip_holding_a_third_of_events(spark):
    """One trip id carries a third of all events; partial aggregation keeps it one row per task."""
    rnd = random.Random(5)
    events = []
    for seq in range(900):
        trip = "hot" if seq % 3 == 0 else f"t{rnd.randrange(50)}"
        if rnd.random() < 0.25:
            events.append((seq, trip, "start", rnd.randrange(100), None, None))
        else:
            events.append((seq, trip, "end", None, float(rnd.randrange(1, 40)), rnd.choice(["a", "b"])))
    df = spark.createDataFrame(events, SCHEMA).repartition(8)
    got = _trips(assemble_trips(df, "replay"))
    assert got == _sequential_replay(events)
    assert "hot" in got
