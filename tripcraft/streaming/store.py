"""The live trips table as a versioned base and deltas of state.

The keyed state of ``assemble_trips`` (``max`` of ``struct(seq, ...)`` per trip) is
associative, so it is stored itself: every micro-batch adds the state of its own
events under ``deltas/batch_id=<n>`` with overwrite, and a read takes the maxima of
base and deltas. ``compact`` folds the deltas into a new base and publishes both
the base and the last delta in it with one pointer; readers follow the pointer, so
they see the same trips before, while and after it runs, and read only the deltas
that came later. The base is bucketed by ``trip_id``: merging moves deltas only.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft.operators.assemble import trip_state_aggs, trip_state_columns
from tripcraft.schemas import END_FIELDS, START_FIELDS, TRIP
from tripcraft.sinks.versions import current, publish

STATES = ["_s", *[f"_e_{f}" for f in END_FIELDS]]


def state_schema(seq: T.DataType | None = None) -> T.StructType:
    """Schema of the stored state."""
    kind = {f.name: f.dataType for f in TRIP}
    first = T.StructField("seq", seq or T.LongType())
    return T.StructType([
        T.StructField("trip_id", T.StringType()),
        T.StructField("_s", T.StructType([first, *[T.StructField(f, kind[f]) for f in START_FIELDS]])),
        *[T.StructField(f"_e_{f}", T.StructType([first, T.StructField("v", kind[f])])) for f in END_FIELDS]])


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The ``batch_id=<n>`` folders of ``path``, no rows if there is none yet."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch_id=*")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in (exc.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


class TripStore:
    """Trips under ``path``, whose next base gets ``buckets`` buckets (fit them to the size of a base)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, seq: T.DataType | None = None):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.schema = state_schema(seq)

    # --- writing ---------------------------------------------------------------------

    def add(self, events: DataFrame, batch_id: int) -> None:
        """Add the state of one batch of events; the same batch again replaces itself."""
        state = events.groupBy("trip_id").agg(*trip_state_aggs(START_FIELDS, END_FIELDS))
        state.write.mode("overwrite").parquet(f"{self.path}/deltas/batch_id={batch_id}")

    def compact(self) -> int:
        """Fold all deltas that are there into a new base; the version it was published as.

        Run it from one place at a time. Deltas that arrive meanwhile are left
        for the next time.
        """
        version, now = current(self.spark, self.path)
        new = self._deltas(now)
        last = new.agg(F.max("batch_id")).first()[0]
        if last is None:
            return version
        name = self._table(version + 1)
        # Dealt as the buckets are, so that each is one file.
        merged = self._merge(now, new.where(F.col("batch_id") <= last)).repartition(self.buckets, "trip_id")
        (merged.write.mode("overwrite").bucketBy(self.buckets, "trip_id").sortBy("trip_id")
         .option("path", f"{self.path}/base/version={version + 1}").saveAsTable(name))
        publish(self.spark, self.path, version + 1, {
            "base": f"{self.path}/base/version={version + 1}", "buckets": self.buckets, "upto": last})
        return version + 1

    # --- reading ---------------------------------------------------------------------

    def state(self) -> DataFrame:
        now = current(self.spark, self.path)[1]
        return self._merge(now, self._deltas(now))

    def trips(self, mode: str = "replay") -> DataFrame:
        """One row per trip (``mode`` as in ``assemble_trips``)."""
        return self.state().select(*trip_state_columns(START_FIELDS, END_FIELDS, mode))

    def _table(self, version: int) -> str:
        return f"trip_base_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{version}"

    def _base(self, now: dict) -> DataFrame:
        """The published base as a bucketed table of this session's catalog (external: its files belong to the store)."""
        version = int(now["base"].rsplit("=", 1)[1])
        name = self._table(version)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (trip_id) "
                f"SORTED BY (trip_id) INTO {now['buckets']} BUCKETS LOCATION '{now['base']}'")
        return self.spark.table(name)

    def _deltas(self, now: dict) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        deltas = read_parquet_or_empty(self.spark, f"{self.path}/deltas", schema)
        return deltas.where(F.col("batch_id") > now.get("upto", -1))

    def _merge(self, now: dict, deltas: DataFrame) -> DataFrame:
        if now:
            # A batch has a row per trip: dealt like the base's buckets they meet it where it lies.
            deltas = deltas.repartition(now["buckets"], "trip_id")
        new = deltas.groupBy("trip_id").agg(*[F.max(c).alias(c) for c in STATES])
        if not now:
            return new
        old = self._base(now).select(F.col("trip_id").alias("_id"), *[F.col(c).alias(f"b{c}") for c in STATES])
        both = old.join(new, old["_id"] == new["trip_id"], "full")
        return both.select(F.coalesce("trip_id", "_id").alias("trip_id"),
                           *[F.greatest(c, f"b{c}").alias(c) for c in STATES])
