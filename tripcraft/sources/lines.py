"""Raw trip lines of the event producers.

The producers read whole files and split lines on commas (no quoting). A line
equal to the header after trimming is dropped wherever it appears; a line with
the wrong number of fields, or (starts) a number that does not convert, is
refused with a reason. Everything here is a per-line projection and filter:
no shuffle, and the text source splits large files across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.functions.validity import number_or_null, strip_text
from tripcraft.operators.validate import RECORD, Checked, tag
from tripcraft.schemas import END_COLUMNS, END_HEADER, START_COLUMNS, START_HEADER

LINE = "value"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Batch read of line files: one row per line in column ``value``."""
    return spark.read.text(path)


def _fields(n: int) -> tuple[Column, list[Column]]:
    parts = F.split(F.col(LINE), ",", -1)
    # ``get`` is null past the end (element access would fail under ANSI).
    return F.size(parts), [F.get(parts, i) for i in range(n)]


def _without_header(lines: DataFrame, header: str) -> DataFrame:
    return lines.filter(F.coalesce(strip_text(F.col(LINE)) != F.lit(header), F.lit(True)))


def parse_start_lines(lines: DataFrame, stage: str = "parse_start") -> Checked:
    """7 fields; location and vendor ids must be integers and the estimate
    a number, or the line is refused. Date texts are not checked here."""
    n, p = _fields(len(START_COLUMNS))
    ints = [p[i].try_cast("bigint") for i in (1, 2, 3)]
    fare = number_or_null(p[6])
    cast_failed = ints[0].isNull() | ints[1].isNull() | ints[2].isNull() | fare.isNull()
    rows = _without_header(lines, START_HEADER).select(
        p[0].alias("trip_id"),
        ints[0].alias("pickup_location_id"),
        ints[1].alias("dropoff_location_id"),
        ints[2].alias("vendor_id"),
        p[4].alias("pickup_datetime"),
        p[5].alias("estimated_dropoff_datetime"),
        fare.alias("estimated_fare_amount"),
        F.when(n != len(START_COLUMNS), F.lit("field_count"))
        .when(cast_failed, F.lit("bad_number"))
        .alias("_reason"),
        F.col(LINE).alias(RECORD),
        *[c for c in lines.columns if c != LINE],
    )
    return Checked(rows, stage)


def parse_end_lines(lines: DataFrame, stage: str = "parse_end") -> Checked:
    """S3: 9 text fields, ``trip_id`` last; no casts at this stage."""
    n, p = _fields(len(END_COLUMNS))
    rows = _without_header(lines, END_HEADER).select(
        *[p[i].alias(name) for i, name in enumerate(END_COLUMNS)],
        F.when(n != len(END_COLUMNS), F.lit("field_count")).alias("_reason"),
        F.col(LINE).alias(RECORD),
        *[c for c in lines.columns if c != LINE],
    )
    # Put the key first, as in every other frame of the pipeline.
    cols = ["trip_id"] + [c for c in rows.columns if c != "trip_id"]
    return Checked(rows.select(*cols), stage)


def with_line_seq(lines: DataFrame, stream_rank: int) -> DataFrame:
    """Order lines read from files (``read_lines``): ``seq`` is a struct.

    Order: rank of the stream (the producers send all start lines before the
    end lines), path of the file, start of the block in the file, position in
    the block. Blocks of a file may run in any order or task; within one the
    row number of the task grows, and a recomputed task gives the same one.
    """
    return lines.withColumn(
        "seq",
        F.struct(
            F.lit(stream_rank).alias("stream"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


__all__ = ["parse_end_lines", "parse_start_lines", "read_lines", "tag", "with_line_seq"]
