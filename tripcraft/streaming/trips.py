"""J4 under Structured Streaming: the keyed trip table kept up to date.

The streaming job runs the same aggregate as the batch ``assemble_trips``
(``max`` of ``struct(seq, ...)`` per trip). Because that aggregate is
associative and ordered by ``seq``, any split of the events into micro-batches,
in any file order, and any restart from the checkpoint give the batch result.

Sink: update mode + ``foreachBatch``. Each micro-batch writes the trips it
changed under ``batch_id=<n>`` with overwrite, so a replayed batch rewrites the
same folder (idempotent). Readers take the newest row per trip; ``compact``
rewrites that view as a new base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripcraft.operators.assemble import assemble_trips
from tripcraft.schemas import TRIP

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """File source of trip events (``seq`` must be in the records)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def _batch_writer(out_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
        )

    return write


def start_trip_table(
    events: DataFrame,
    out_path: str,
    checkpoint: str,
    mode: str = "replay",
    available_now: bool = True,
    processing_time: str | None = None,
    state_store: str | None = "rocksdb",
) -> StreamingQuery:
    """Start the streaming J4 job writing changed trips per micro-batch.

    State is one aggregated row per trip (kept as long as the table lives, as
    the keyed store of the reference does); RocksDB keeps it off-heap so it
    can outgrow executor memory.
    """
    spark = events.sparkSession
    if state_store == "rocksdb":
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        # Commit only the change log per micro-batch; snapshots are taken in the background.
        spark.conf.set(
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
        )
    # A4 while streaming: per micro-batch event counters in the query progress.
    kind = F.col("kind")
    counted = events.observe(
        "trip_events",
        F.count(F.lit(1)).alias("events"),
        F.count(F.when(kind == "start", 1)).alias("starts"),
        F.count(F.when(kind == "end", 1)).alias("ends"),
    )
    trips = assemble_trips(counted, mode)
    writer = (
        trips.writeStream.outputMode("update")
        .foreachBatch(_batch_writer(out_path))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_trip_table(spark: SparkSession, path: str) -> DataFrame:
    """The current trips: newest micro-batch row per ``trip_id``."""
    t = spark.read.parquet(path)
    fields = [c for c in TRIP.fieldNames() if c != "trip_id" and c in t.columns]
    latest = t.groupBy("trip_id").agg(
        F.max_by(F.struct(*[F.col(c) for c in fields]), F.col("batch_id")).alias("_r")
    )
    return latest.select("trip_id", *[F.col(f"_r.{c}").alias(c) for c in fields])


def compact(spark: SparkSession, path: str, out: str) -> str:
    """Rewrite the newest row per trip as a new, standalone trips table.

    A periodic job: the result has one row per trip (a single ``batch_id``
    folder), so ``read_trip_table(out)`` no longer has to reduce every
    micro-batch ever written.
    """
    # The batch id lives in the folder name, as in the streaming sink.
    read_trip_table(spark, path).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id=-1")
    return out
