"""Keyed JSON events and their decoding.

An event is ``key`` (partition key), ``value`` (JSON body) and ``seq`` (arrival
order). As received from a stream the body is base64 text (``data``).
Decoding parses the body once into a VARIANT and reads each field from it, so
the JSON type of every field is known: the strict reading can refuse numbers
sent as text without a second parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft.operators.validate import NOTE, REASON, RECORD, Checked, notes

_NUMERIC_JSON = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def to_events(
    rows: DataFrame, key_col: str, fields: list[str], seq_col: str | None = None
) -> DataFrame:
    """One keyed JSON event per row; null fields are written as ``null``."""
    body = F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false"})
    cols = [F.col(key_col).cast("string").alias("key"), body.alias("value")]
    if seq_col:
        cols.append(F.col(seq_col).alias("seq"))
    return rows.select(*cols)


def encode_records(events: DataFrame) -> DataFrame:
    """The received form of an event: its body as base64 text in ``data``."""
    return events.withColumn("data", F.base64(F.encode(F.col("value"), "UTF-8"))).drop("value")


def _json_type(v: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))


def _read(v: Column, schema: T.StructType) -> Column:
    """The fields of a JSON object converted where possible; null for anything else."""
    return F.try_variant_get(v, "$", schema.simpleString())


def _strict_field(v: Column, f: T.StructField) -> Column:
    target = f.dataType.simpleString()
    # The JSON value must already be of the field's kind.
    jt = _json_type(v, f.name)
    if isinstance(f.dataType, T.StringType):
        ok = jt == F.lit("STRING")
    elif isinstance(f.dataType, T.NumericType):
        ok = jt.rlike(_NUMERIC_JSON)
    else:
        ok = F.lit(True)
    return F.when(ok, F.try_variant_get(v, f"$.{f.name}", target))


def decode_events(
    raw: DataFrame,
    schema: T.StructType,
    mode: str = "coerce",
    data_col: str = "data",
    stage: str = "decode",
) -> Checked:
    """base64 -> UTF-8 -> JSON object -> typed fields.

    A record whose body is not base64, not UTF-8 or not a JSON object is
    refused as ``undecodable`` (counted, never fatal); its record is the text,
    or the body as received where that gives none. ``coerce`` converts
    field values to the schema's types where possible (``"16.0"`` -> 16.0);
    every integer field that was sent but is no integer is null and noted as
    ``bad_<field>``. ``strict`` takes a value only when its JSON type already matches.
    """
    if mode not in ("coerce", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    keep = [c for c in raw.columns if c != data_col]
    integers = [f.name for f in schema.fields if isinstance(f.dataType, T.LongType)] if mode == "coerce" else []
    text = raw.select(
        *keep, F.col(data_col), F.try_to_binary(F.col(data_col), F.lit("base64")).cast("string").alias("_text"))
    # Parse once. Expanding a one-element array puts a Generate between the
    # parse and the refusal filters of the later stages; without it Catalyst
    # pushes those filters below this projection and inlines the JSON parse
    # into them, parsing every record two or more times.
    valid = F.is_valid_utf8("_text")
    parsed = text.select(
        *keep,
        F.inline(
            F.array(
                F.struct(
                    F.when(valid, F.col("_text")).otherwise(F.col(data_col)).alias(RECORD),
                    F.when(valid, F.try_parse_json("_text")).alias("_v"),
                )
            )
        ),
    )
    v = F.col("_v")
    if mode == "strict":
        is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
        fields = {f.name: _strict_field(v, f) for f in schema.fields}
    else:
        # One walk over the object for each target type, and null if it is no object.
        parsed = parsed.select(*keep, RECORD, _read(v, schema).alias("_b"), *[
            _read(v, T.StructType([T.StructField(n, t) for n in integers])).alias(name)
            for name, t in (("_d", T.DoubleType()), ("_s", T.StringType())) if integers])
        is_object = F.col("_b").isNotNull()
        fields = {f.name: F.col("_b")[f.name] for f in schema.fields}
        for n in integers:
            # A fraction is no integer: null with a note, never truncated.
            fields[n] = F.when(fields[n].cast("double") == F.col("_d")[n], fields[n])
    bad = [F.when(fields[n].isNull() & F.col("_s")[n].isNotNull(), F.lit(f"bad_{n}")) for n in integers]
    out = parsed.select(
        *[c.alias(n) for n, c in fields.items()],
        *[c for c in keep if c not in schema.fieldNames()],
        F.when(~is_object, F.lit("undecodable")).alias(REASON),
        notes(F.lit(None).cast("string"), *bad).alias(NOTE),
        F.col(RECORD),
    )
    return Checked(out, stage)
