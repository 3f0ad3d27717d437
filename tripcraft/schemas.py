"""Schemas, field lists and the fixed texts of the trip record layouts."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must equal the producer layouts exactly. ---------
# Header line of the trip-start CSV (7 fields, trip_id first).
START_HEADER = (
    "trip_id,pickup_location_id,dropoff_location_id,vendor_id,"
    "pickup_datetime,estimated_dropoff_datetime,estimated_fare_amount"
)
# Header line of the trip-end CSV (9 fields, trip_id last).
END_HEADER = (
    "dropoff_datetime,rate_code,passenger_count,trip_distance,fare_amount,"
    "tip_amount,payment_type,trip_type,trip_id"
)
# Date-time text pattern of the event path (unpadded parts accepted).
DATETIME_PATTERN = "yyyy-M-d H:m:s"
DATE_PATTERN = "yyyy-M-d"
TIME_OF_DAY_PATTERN = "HH:mm:ss"
# Store output format of a normalised date-time.
DATETIME_OUT_PATTERN = "yyyy-MM-dd HH:mm:ss"
# --------------------------------------------------------------------------

START_COLUMNS = START_HEADER.split(",")
END_COLUMNS = END_HEADER.split(",")

# Start fields after normalisation (the nine fields a start may store).
START_FIELDS = [
    "pickup_location_id",
    "dropoff_location_id",
    "vendor_id",
    "pickup_datetime",
    "pickup_time",
    "estimated_dropoff_datetime",
    "estimated_dropoff_time",
    "estimated_fare_amount",
]
# End fields and their kind: text fields must be non-blank, numbers non-zero.
END_FIELD_KINDS = {
    "dropoff_datetime": "text",
    "rate_code": "text",
    "passenger_count": "number",
    "trip_distance": "number",
    "fare_amount": "number",
    "tip_amount": "number",
    "payment_type": "text",
    "trip_type": "text",
}
END_FIELDS = list(END_FIELD_KINDS)
# Fields that describe a trip fully (optional filter V6).
DESCRIPTIVE_FIELDS = ["rate_code", "passenger_count", "payment_type", "trip_type"]

TRIP_START = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("pickup_location_id", T.LongType()),
        T.StructField("dropoff_location_id", T.LongType()),
        T.StructField("vendor_id", T.LongType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("estimated_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("estimated_fare_amount", T.DoubleType()),
    ]
)

TRIP_END = T.StructType(
    [
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("rate_code", T.StringType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("trip_type", T.StringType()),
        T.StructField("trip_id", T.StringType()),
    ]
)

# A start event after P3-P6: what a start writes for its key.
START_EVENT = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("pickup_location_id", T.LongType()),
        T.StructField("dropoff_location_id", T.LongType()),
        T.StructField("vendor_id", T.LongType()),
        T.StructField("pickup_datetime", T.DateType()),
        T.StructField("pickup_time", T.StringType()),
        T.StructField("estimated_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("estimated_dropoff_time", T.StringType()),
        T.StructField("estimated_fare_amount", T.DoubleType()),
    ]
)

# An end event after V1-V2: invalid fields are null ("not sent").
END_EVENT = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("rate_code", T.StringType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("trip_type", T.StringType()),
    ]
)

# One assembled trip per trip_id (the keyed table).
TRIP = T.StructType(
    list(START_EVENT.fields) + [f for f in END_EVENT.fields if f.name != "trip_id"]
)
