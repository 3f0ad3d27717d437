"""Event path rules: line parsing, decoding, P3 rule table, V1-V3 (FIXTURES.md 4-6)."""

import datetime as dt

from pyspark.sql import functions as F

from tripcraft.operators import mask_invalid, normalize_start_events, quarantine, require_any, require_key
from tripcraft.plans.events import (
    END_BODY,
    START_BODY,
    consume_end_events,
    consume_start_events,
    end_path,
    start_path,
)
from tripcraft.schemas import END_HEADER, START_EVENT, START_HEADER
from tripcraft.sources import decode_events, encode_records, parse_end_lines, parse_start_lines


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_start_lines(spark):
    checked = parse_start_lines(
        lines(
            spark,
            START_HEADER,
            "1,100,200,1,2024-05-25 10:00:00,2024-05-25 10:30:00,15.5",
            "2,100,200,abc,2024-05-25 10:00:00,2024-05-25 10:30:00,15.5",
            "3,100,200,1,2024-05-25 10:00:00,15.5",
            "  " + START_HEADER + " ",
            "4, 7 ,200,1,x,y,nan",
            "5,1.0,200,1,a,b,1",
            "",
        )
    )
    ok = {r.trip_id: r for r in checked.accepted.collect()}
    assert set(ok) == {"1", "4"}
    assert ok["4"].pickup_location_id == 7  # surrounding blanks accepted, as int() does
    reasons = {r.record: r.reason for r in checked.rejects.collect()}
    assert reasons["2,100,200,abc,2024-05-25 10:00:00,2024-05-25 10:30:00,15.5"] == "bad_number"
    assert reasons["3,100,200,1,2024-05-25 10:00:00,15.5"] == "field_count"
    assert reasons["5,1.0,200,1,a,b,1"] == "bad_number"  # int() refuses 1.0
    assert reasons[""] == "field_count"
    assert len(reasons) == 4  # headers are dropped, not refused


def test_end_lines_trip_id_last(spark):
    checked = parse_end_lines(
        lines(spark, END_HEADER, "2024-05-25 10:30:00,1,2,3.5,16,2.5,card,1,abc", "a,b,c,d,e,f,g,h")
    )
    row = checked.accepted.first()
    assert row.trip_id == "abc" and row.fare_amount == "16"
    assert [r.reason for r in checked.rejects.collect()] == ["field_count"]


def _start_events(spark, rows):
    df = spark.createDataFrame(
        rows,
        "trip_id string, pickup_datetime string, estimated_dropoff_datetime string, "
        "estimated_fare_amount string",
    )
    return df.withColumns(
        {"pickup_location_id": F.lit(1), "dropoff_location_id": F.lit(2), "vendor_id": F.lit(1)}
    )


def test_p3_rule_table(spark):
    checked = normalize_start_events(
        _start_events(
            spark,
            [
                ("full", "2024-05-25 23:34:00", "2024-05-25 23:50:00", "10.456"),
                ("unpadded", "2024-5-3 3:4:5", "2024-5-3 3:20:0", "1"),
                ("date", "2024-05-25", "2024-05-25", "2"),
                ("empty", "", "", None),
                ("bad", "bad", "2024-05-25 23:50:00", "3"),
                ("badest", "2024-05-25 23:34:00", "25/05/2024", "4"),
                ("badfare", "2024-05-25 23:34:00", "", "abc"),
            ],
        )
    )
    rows = {r.trip_id: r for r in checked.accepted.collect()}
    full = rows["full"]
    assert full.pickup_datetime == dt.date(2024, 5, 25) and full.pickup_time == "23:34:00"
    assert full.estimated_dropoff_time == "23:50:00" and full.estimated_fare_amount == 10.46
    assert rows["unpadded"].pickup_time == "03:04:05"
    assert rows["date"].pickup_datetime == dt.date(2024, 5, 25) and rows["date"].pickup_time is None
    assert rows["date"].estimated_dropoff_time is None
    assert rows["empty"].pickup_datetime is None and rows["empty"].estimated_fare_amount is None
    bad = rows["bad"]  # kept, date null, no estimated drop-off time (steps skipped)
    assert bad.pickup_datetime is None and bad.estimated_dropoff_time is None
    assert rows["badest"].estimated_dropoff_datetime is None
    assert "badfare" not in rows
    reasons = {r.trip_id: r.reason for r in checked.rejects.collect()}
    assert reasons == {
        "bad": "malformed_pickup_datetime",
        "badest": "malformed_estimated_dropoff_datetime",
        "badfare": "bad_estimated_fare_amount",
    }


def _end_rows(spark, rows):
    return spark.createDataFrame(
        rows,
        "trip_id string, dropoff_datetime string, rate_code string, passenger_count string, "
        "trip_distance string, fare_amount string, tip_amount string, payment_type string, "
        "trip_type string",
    )


def test_v1_v2_v3_coerce_and_strict(spark):
    df = _end_rows(
        spark,
        [
            ("a", "2024-05-25 10:30:00", " ", "2", "3.5", "16", "0", "card", "1"),
            ("", "2024-05-25 10:30:00", "1", "2", "3.5", "16", "1", "card", "1"),
            ("b", "", "", "0", "x", "", "0", " ", ""),
            ("c", None, None, "nan", None, "inf", None, None, "2"),
        ],
    )
    keyed = require_key(df)
    assert [r.reason for r in keyed.rejects.collect()] == ["missing_trip_id"]
    coerce = require_any(mask_invalid(keyed.accepted, "coerce"))
    rows = {r.trip_id: r for r in coerce.accepted.collect()}
    a = rows["a"]
    assert a.rate_code is None and a.tip_amount is None  # blank text and zero are "not sent"
    assert a.fare_amount == 16.0 and a.passenger_count == 2.0
    assert a.dropoff_datetime == dt.datetime(2024, 5, 25, 10, 30)
    assert rows["c"].passenger_count is None and rows["c"].fare_amount is None  # NaN/inf refused
    assert [r.trip_id for r in coerce.rejects.collect()] == ["b"]
    strict = require_any(mask_invalid(keyed.accepted, "strict")).accepted
    srow = {r.trip_id: r for r in strict.collect()}["a"]
    assert srow.fare_amount is None and srow.payment_type == "card"


def test_decode_coerce_strict_and_undecodable(spark):
    raw = spark.createDataFrame(
        [
            ('{"trip_id": "1", "fare_amount": "16.0", "rate_code": 2, "tip_amount": 2.5}',),
            ("not json",),
            ("[1, 2]",),
        ],
        "value string",
    )
    received = encode_records(raw).unionByName(spark.createDataFrame([("@@@",)], "data string"))
    coerce = decode_events(received, END_BODY, "coerce")
    row = coerce.accepted.first()
    assert (row.fare_amount, row.rate_code, row.tip_amount) == (16.0, "2", 2.5)
    assert sorted(r.reason for r in coerce.rejects.collect()) == ["undecodable"] * 3
    strict = decode_events(received, END_BODY, "strict").accepted.first()
    assert (strict.fare_amount, strict.rate_code, strict.tip_amount) == (None, None, 2.5)


def test_full_paths_round_trip(spark):
    sp = start_path(
        lines(spark, START_HEADER, "t1,1,2,1,2024-05-25 10:00:00,2024-05-25 10:30:00,12.345")
    )
    row = sp.accepted.first()
    assert (row.trip_id, row.pickup_time, row.estimated_fare_amount) == ("t1", "10:00:00", 12.35)
    ep = end_path(lines(spark, "2024-05-25 10:30:00,1,2,3.5,16,0,card,1,t1"), "coerce")
    erow = ep.accepted.first()
    assert (erow.trip_id, erow.fare_amount, erow.tip_amount) == ("t1", 16.0, None)
    strict = end_path(lines(spark, "2024-05-25 10:30:00,1,2,3.5,16,0,card,1,t1"), "strict")
    assert strict.accepted.first().fare_amount is None  # the producer sends text only
    assert START_BODY.fieldNames()[0] == "trip_id"


def test_refused_and_noted_records_keep_their_text(spark):
    bodies = [
        '{"trip_id": "a", "vendor_id": 1, "estimated_fare_amount": "abc"}',
        '{"trip_id": "", "vendor_id": 1}',
        '{"trip_id": "c", "vendor_id": "x", "pickup_location_id": 3000000000}',
        '{"trip_id": "d", "pickup_location_id": 1.7, "vendor_id": "12"}',
    ]
    received = encode_records(spark.createDataFrame([(b,) for b in bodies], "value string"))
    stages, accepted = consume_start_events(received)
    got = {(r.stage, r.reason): r.record for r in quarantine(*stages).collect()}
    assert got == {
        ("normalize_start", "bad_estimated_fare_amount"): bodies[0],
        ("require_key_start", "missing_trip_id"): bodies[1],
        ("decode_start", "bad_vendor_id"): bodies[2],
        ("decode_start", "bad_pickup_location_id"): bodies[3],
    }
    rows = {r.trip_id: r for r in accepted.collect()}
    assert (rows["c"].vendor_id, rows["c"].pickup_location_id) == (None, 3_000_000_000)
    assert (rows["d"].vendor_id, rows["d"].pickup_location_id) == (12, None)
    assert accepted.columns == START_EVENT.fieldNames()


def test_unreadable_dropoff_is_noted_and_counts_as_sent(spark):
    bodies = ['{"trip_id": "a", "dropoff_datetime": "2024-05-25T10:00:00"}', '{"trip_id": "b", "rate_code": ""}']
    received = encode_records(spark.createDataFrame([(b,) for b in bodies], "value string"))
    stages, accepted = consume_end_events(received)
    assert [(r.trip_id, r.dropoff_datetime) for r in accepted.collect()] == [("a", None)]
    got = {r.reason: r.record for r in quarantine(*stages).collect()}
    assert got == {"malformed_dropoff_datetime": bodies[0], "no_valid_field": bodies[1]}


def test_run_events_pipeline(spark):
    from tripcraft.plans.events import run_events
    from tripcraft.session import scratch_path

    base = scratch_path(spark, "events-job")
    lines(spark, START_HEADER, "t1,1,2,1,2024-05-25 10:00:00,2024-05-25 10:30:00,12.5",
          "t2,1,2,x,2024-05-25 10:00:00,2024-05-25 10:30:00,1").coalesce(1).write.text(f"{base}/s")
    lines(spark, "2024-05-25 10:31:00,1,2,3.5,16,0,card,1,t1",
          ",,,,,,,,t3").coalesce(1).write.text(f"{base}/e")
    paths = run_events(spark, f"{base}/s", f"{base}/e", f"{base}/out")
    trips = {r.trip_id: r for r in spark.read.parquet(paths["trips"]).collect()}
    assert set(trips) == {"t1"}
    t1 = trips["t1"]
    assert (t1.pickup_time, t1.fare_amount, t1.tip_amount) == ("10:00:00", 16.0, None)
    reasons = {(r.stage, r.reason) for r in spark.read.parquet(paths["rejects"]).collect()}
    assert reasons == {("parse_start", "bad_number"), ("require_any_end", "no_valid_field")}
    report = spark.read.parquet(paths["report"]).filter("outcome = 'failed'").count()
    assert report == 2
