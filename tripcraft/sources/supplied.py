"""Trip data derived from the supplied tables.

No trip files come with the test data, so trips are mapped from ``events``
(and, for the large view, from ``orders`` x ``lineitem``). Every view is a
projection of a scan: its size grows with the table, and the same mapping is
written in SQL for the DuckDB oracle. ``k`` is the integer in ``props``.

Paired view (batch path): even ``event_id`` -> a start, odd -> an end, both of
trip ``event_id div 2``. Interleaved view (keyed merge): trip ``event_id div 4``,
``seq = event_id``; ``signup``/``view`` events are starts, the rest ends.
Raw-line view: the paired rows as producer CSV lines, damaged by
``event_id % 10`` so that refusal rules and notes fire. Some unfinished trips
have a fare and some ends no rate code, so that the trip filters differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.functions.datetime import time_of_day
from tripcraft.schemas import DATETIME_OUT_PATTERN, END_HEADER, START_HEADER

START_KINDS = ("signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k_text() -> Column:
    return F.get_json_object(F.col("props"), "$.k")


def _k() -> Column:
    return _k_text().cast("int")


def _trip(div: int) -> Column:
    return F.expr(f"event_id div {div}").cast("string")


def _start_cols(k: Column | None = None) -> dict[str, Column]:
    ts = F.col("ts")
    return {
        "pickup_location_id": F.col("user_id").cast("bigint"),
        "dropoff_location_id": _k() if k is None else k,
        "vendor_id": (F.lit(1) + F.col("user_id") % 2).cast("bigint"),
        "pickup_datetime": ts,
        "estimated_dropoff_datetime": ts + F.expr("INTERVAL 15 MINUTES"),
        "estimated_fare_amount": F.col("value") / F.lit(3.0),
    }


def _end_cols(k: Column | None = None) -> dict[str, Column]:
    ok = F.col("event_type") != F.lit("error")
    k = _k() if k is None else k
    return {
        "dropoff_datetime": F.when(ok, F.col("ts")),
        "rate_code": F.when(k % 6 != 5, (F.lit(1) + k % 6).cast("string")),
        "passenger_count": (k % 7).cast("double"),
        "trip_distance": F.col("value") / F.lit(10.0),
        "fare_amount": F.when(ok | (k % 2 == 1), F.col("value")),
        "tip_amount": (k % 4).cast("double"),
        "payment_type": F.col("event_type"),
        "trip_type": (F.lit(1) + F.col("user_id") % 2).cast("string"),
    }


def paired_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(F.col("event_id") % 2 == 0)
    cols = _start_cols()
    return ev.select(_trip(2).alias("trip_id"), *[c.alias(n) for n, c in cols.items()])


def paired_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(F.col("event_id") % 2 == 1)
    cols = _end_cols()
    return ev.select(*[c.alias(n) for n, c in cols.items()], _trip(2).alias("trip_id"))


def interleaved_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both event kinds of trip ``event_id div 4`` in one frame.

    Start fields are typed as after P3 (date, time of day, rounded estimate);
    end fields are as sent and still need V2.
    """
    ev = table(spark, sf_dir, "events")
    is_start = F.col("event_type").isin(*START_KINDS)
    s = _start_cols()
    est_drop = s["estimated_dropoff_datetime"]
    starts = {
        "pickup_location_id": s["pickup_location_id"],
        "dropoff_location_id": s["dropoff_location_id"],
        "vendor_id": s["vendor_id"],
        "pickup_datetime": F.to_date(F.col("ts")),
        "pickup_time": time_of_day(F.col("ts")),
        "estimated_dropoff_datetime": est_drop,
        "estimated_dropoff_time": time_of_day(est_drop),
        "estimated_fare_amount": F.round(s["estimated_fare_amount"], 2),
    }
    return ev.select(
        F.col("event_id").alias("seq"),
        F.when(is_start, F.lit("start")).otherwise(F.lit("end")).alias("kind"),
        _trip(4).alias("trip_id"),
        *[F.when(is_start, c).alias(n) for n, c in starts.items()],
        *[F.when(~is_start, c).alias(n) for n, c in _end_cols().items()],
    )


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _dt_text(c: Column) -> Column:
    return F.coalesce(F.date_format(c, DATETIME_OUT_PATTERN), F.lit(""))


def start_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer lines of the starts, with a header line.

    ``event_id % 10``: 0 drops the last field, 2 sends vendor ``abc``, 4 a
    date-only pickup, 6 a malformed pickup, 8 clean but for a malformed
    estimated drop-off where ``k % 5`` is 0.
    """
    ev = table(spark, sf_dir, "events").filter(F.col("event_id") % 2 == 0)
    s = _start_cols()
    d = F.col("event_id") % 10
    pickup = (
        F.when(d == 4, F.date_format(F.col("ts"), "yyyy-MM-dd"))
        .when(d == 6, F.date_format(F.col("ts"), "yyyy/MM/dd HH:mm:ss"))
        .otherwise(_dt_text(F.col("ts")))
    )
    vendor = F.when(d == 2, F.lit("abc")).otherwise(_text(s["vendor_id"]))
    head = [
        _text(_trip(2)),
        _text(s["pickup_location_id"]),
        _text(s["dropoff_location_id"]),
        vendor,
        pickup,
        F.when((d == 8) & (_k() % 5 == 0), F.date_format(s["estimated_dropoff_datetime"], "dd/MM/yyyy"))
        .otherwise(_dt_text(s["estimated_dropoff_datetime"])),
    ]
    full = F.concat_ws(",", *head, _text(s["estimated_fare_amount"]))
    short = F.concat_ws(",", *head)
    lines = ev.select(F.when(d == 0, short).otherwise(full).alias("value"))
    return lines.unionByName(spark.range(1).select(F.lit(START_HEADER).alias("value")))


def end_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer lines of the ends, with a header line.

    ``event_id % 10``: 1 drops the last field, 3 blanks ``trip_id``, 5 blanks
    every other field, 7 sends a zero fare, 9 clean but for an unreadable
    drop-off where ``k % 5`` is 0.
    """
    ev = table(spark, sf_dir, "events").filter(F.col("event_id") % 2 == 1)
    e = _end_cols()
    d = F.col("event_id") % 10
    blank = d == 5
    fields = [
        F.when(blank, F.lit(""))
        .when((d == 9) & (_k() % 5 == 0), F.coalesce(
            F.date_format(e["dropoff_datetime"], "yyyy/MM/dd HH:mm:ss"), F.lit("")))
        .otherwise(_dt_text(e["dropoff_datetime"])),
        *[
            F.when(blank, F.lit("")).otherwise(_text(e[n]))
            for n in ("rate_code", "passenger_count", "trip_distance")
        ],
        F.when(blank, F.lit("")).when(d == 7, F.lit("0")).otherwise(_text(e["fare_amount"])),
        *[
            F.when(blank, F.lit("")).otherwise(_text(e[n]))
            for n in ("tip_amount", "payment_type", "trip_type")
        ],
    ]
    trip = F.when(d == 3, F.lit("")).otherwise(_trip(2))
    full = F.concat_ws(",", *fields, trip)
    short = F.concat_ws(",", *fields)
    lines = ev.select(F.when(d == 1, short).otherwise(full).alias("value"))
    return lines.unionByName(spark.range(1).select(F.lit(END_HEADER).alias("value")))


def damaged_start_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paired starts as texts for a CSV; ``event_id % 10``: 0 an estimate that is no number, 2 a word as
    vendor, 4 a pickup that is no time and a fraction as pickup location, the others clean."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_id") % 2 == 0)
    s, d = _start_cols(), F.col("event_id") % 10
    wrong = {"estimated_fare_amount": (0, "n/a"), "vendor_id": (2, "abc"), "pickup_datetime": (4, "some day"),
             "pickup_location_id": (4, "1.5")}

    def text(name: str) -> Column:
        c = _dt_text(s[name]) if name.endswith("datetime") else _text(
            F.round(s[name], 2) if name == "estimated_fare_amount" else s[name])
        return F.when(d == wrong[name][0], F.lit(wrong[name][1])).otherwise(c) if name in wrong else c

    return ev.select(_trip(2).alias("trip_id"), *[text(n).alias(n) for n in s])


def received_events(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Events of trip ``event_id div 4`` as a consumer receives them: kind, data (base64 JSON) and seq.

    ``event_id % 11`` says what is wrong with a body. Starts: 0 no base64, 1
    cut JSON, 2 an empty trip id, 3 a word as vendor and a fraction as pickup
    location, 4 an estimate that is no number and a malformed pickup, 5 both times
    malformed, 6 a number sent as a number. Ends: 0 and 1 as before, 2 no trip id, 3
    nothing but blanks, 4 a malformed drop-off, 5 a zero fare, 6 numbers sent as
    numbers. The others are clean, 7 with a field that nobody knows.

    ``parts`` deals the rows into so many partitions first, while they are narrow: the
    table may be a file of few row groups, and bodies are built and decoded where its rows lie.
    """
    ev = table(spark, sf_dir, "events").withColumn("k", _k_text()).drop("props")
    if parts:
        ev = ev.repartition(parts, F.xxhash64("event_id", "ts", "user_id"))
    is_start = F.col("event_type").isin(*START_KINDS)
    k = F.col("k").cast("int")
    s, e, d = _start_cols(k), _end_cols(k), F.col("event_id") % 11

    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    def body(**fields: Column) -> Column:
        # A null value leaves the field out of the body.
        return F.concat(F.lit("{"), F.concat_ws(",", *[
            F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()]), F.lit("}"))

    slashes = F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    extra = F.when(d == 7, F.lit("[1,2]"))
    estimate = _text(F.round(s["estimated_fare_amount"], 2))
    start = body(
        trip_id=quoted(F.when(d == 2, F.lit("")).otherwise(_trip(4))),
        pickup_location_id=F.when(d == 3, F.lit("1.5")).otherwise(quoted(_text(s["pickup_location_id"]))),
        dropoff_location_id=quoted(_text(s["dropoff_location_id"])),
        vendor_id=quoted(F.when(d == 3, F.lit("abc")).otherwise(_text(s["vendor_id"]))),
        pickup_datetime=quoted(F.when(d.isin(4, 5), slashes).otherwise(_dt_text(F.col("ts")))),
        estimated_dropoff_datetime=quoted(
            F.when(d == 5, F.lit("soon")).otherwise(_dt_text(s["estimated_dropoff_datetime"]))),
        estimated_fare_amount=F.when(d == 6, estimate).otherwise(
            quoted(F.when(d == 4, F.lit("n/a")).otherwise(estimate))),
        surge=extra)
    blank = d == 3

    def sent(c: Column) -> Column:
        return F.when(d == 6, c).otherwise(quoted(F.when(blank, F.lit(" ")).otherwise(F.coalesce(c, F.lit("")))))

    def text(c: Column) -> Column:
        return quoted(F.when(blank, F.lit("")).otherwise(F.coalesce(c, F.lit(""))))

    number = {n: e[n].cast("string") for n in ("passenger_count", "trip_distance", "fare_amount", "tip_amount")}
    number["fare_amount"] = F.when(d == 5, F.lit("0")).otherwise(number["fare_amount"])
    end = body(
        trip_id=F.when(d != 2, quoted(_trip(4))),
        dropoff_datetime=text(F.when(d == 4, slashes).otherwise(_dt_text(e["dropoff_datetime"]))),
        rate_code=text(e["rate_code"]),
        **{n: sent(c) for n, c in number.items()},
        payment_type=text(e["payment_type"]), trip_type=text(e["trip_type"]), surge=extra)
    value = F.when(is_start, start).otherwise(end)
    value = F.when(d == 1, F.substring(value, 1, 9)).otherwise(value)
    return ev.select(
        F.when(is_start, F.lit("start")).otherwise(F.lit("end")).alias("kind"),
        F.when(d == 0, F.concat(F.lit("%"), F.col("event_id").cast("string")))
        .otherwise(F.base64(F.encode(value, "UTF-8"))).alias("data"),
        F.col("event_id").alias("seq"))


def large_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trip starts (one order -> one start)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("o_totalprice").alias("estimated_fare_amount"),
    )


def large_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trip ends (one order -> many ends, so J1 fans out)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_tax").alias("tip_amount"),
    )
