"""Batch CSV scan of trip files (header line, explicit or inferred types)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft.functions.validity import number_or_null
from tripcraft.operators.validate import NOTE, REASON, RECORD, Checked, notes

# A date, alone or with a time after a blank or T; seconds and fractions are optional.
CSV_TIMESTAMP_READ = "yyyy-MM-dd[ HH:mm[:ss[.SSSSSS]]]['T'HH:mm[:ss[.SSSSSS]]]"
CSV_TIMESTAMP_WRITE = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_trips_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Read trip CSV files with a header line.

    With ``schema`` (recommended) types are fixed and no inference pass runs;
    columns go by the names of the header in any order, a missing one raises,
    and further ones are left out. All files of one read share one header
    (checked by the scan). The result has the schema's columns.
    without it types are inferred from the data, which costs an extra scan and
    is data-dependent (a ``trip_id`` column of digits infers as int). Fields
    that do not parse are null (PERMISSIVE); the job does not fail.
    """
    reader = (
        spark.read.option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("timestampNTZFormat", CSV_TIMESTAMP_READ)
        .option("timestampFormat", CSV_TIMESTAMP_READ)
    )
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    names = reader.csv(path).columns  # reads one header line
    missing = [n for n in schema.fieldNames() if n not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path!r}")
    found = T.StructType(
        [schema[n] if n in schema.fieldNames() else T.StructField(n, T.StringType()) for n in names]
    )
    return reader.schema(found).option("enforceSchema", "false").csv(path).select(*schema.fieldNames())


def _typed(c: Column, dtype: T.DataType) -> Column:
    """A text field as the type; null where it does not parse."""
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.try_to_timestamp(c, F.lit(CSV_TIMESTAMP_READ)).cast(dtype)
    if isinstance(dtype, T.FractionalType):
        return number_or_null(c).try_cast(dtype)
    return c.try_cast(dtype)


def check_trips_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, stage: str = "read_csv"
) -> Checked:
    """``read_trips_csv`` with nothing lost in silence.

    Fields are read as text and parsed one by one: the row is kept, every
    field that does not parse is null and noted as ``bad_<field>``, and a line
    with too few or too many fields is noted as ``field_count``. The record of
    a noted row is the line where its fields don't fit the header, and else
    its fields as JSON texts. One scan, no shuffle.
    """
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    names = reader.csv(path).columns  # reads one header line
    missing = [n for n in schema.fieldNames() if n not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path!r}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RECORD]])
    rows = reader.option("columnNameOfCorruptRecord", RECORD).option("enforceSchema", "false").schema(text).csv(path)
    typed = {f.name: _typed(F.col(f.name), f.dataType) for f in schema.fields}
    unread = [F.when(F.col(n).isNotNull() & c.isNull(), F.lit(f"bad_{n}")) for n, c in typed.items()]
    return Checked(rows.select(
        *[c.alias(n) for n, c in typed.items()],
        F.lit(None).cast("string").alias(REASON),
        notes(F.when(F.col(RECORD).isNotNull(), F.lit("field_count")), *unread).alias(NOTE),
        F.coalesce(RECORD, F.to_json(F.struct(*names))).alias(RECORD)), stage)


def write_trips_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write trip rows as CSV with a header (the layout ``read_trips_csv`` reads)."""
    (
        df.write.mode(mode)
        .option("header", "true")
        .option("timestampNTZFormat", CSV_TIMESTAMP_WRITE)
        .option("timestampFormat", CSV_TIMESTAMP_WRITE)
        .csv(path)
    )
