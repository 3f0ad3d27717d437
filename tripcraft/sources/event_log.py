"""Keyed events published to an ordered, append-only log.

An append numbers its events without gaps: they are staged once, each task's rows
are counted, and a prefix sum over the tasks (one small row each) gives every task
the number of its first event. The segment and the next free number are then
published together (``sinks.versions``). Segments lie in files by hash of the key;
``seq`` is in the record, so a reader of the files needs no order of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft.sinks.versions import current, publish

#: Bits of ``monotonically_increasing_id`` that count the rows of a task.
_ROW_BITS = 33


class EventLog:
    """Events (key, value and further columns) under ``path``, numbered ``seq`` = 0, 1, ..."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def append(self, events: DataFrame, order: list[str] | None = None) -> tuple[int, int]:
        """Publish events behind all earlier ones; (first number, number after the last).

        ``order``: columns that say which event comes first within this append;
        without it the order of the rows as they are read. One append
        runs at a time. If one fails, the next finds its segment complete and
        publishes it, or overwrites what there is of it.
        """
        version, now = current(self.spark, self.path)
        segment, first = version + 1, now.get("next", 0)
        target = f"{self.path}/log/segment={segment}"
        if self._complete(target):
            end = self.spark.read.parquet(target).agg(F.max("seq")).first()[0]
            publish(self.spark, self.path, segment, {"next": first if end is None else end + 1})
            return self.append(events, order)
        if order:
            events = events.repartitionByRange(*order).sortWithinPartitions(*order)
        staged = f"{self.path}/staged"
        # Staged before it is numbered: a task that runs again can't number its rows another way.
        events.withColumn("_row", F.monotonically_increasing_id()).write.mode("overwrite").parquet(staged)
        rows = self.spark.read.parquet(staged).withColumn("_task", F.shiftright("_row", _ROW_BITS))
        before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
        # A row per task of the staging write: few enough for one window and a broadcast.
        tasks = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "_first", F.lit(first) + F.coalesce(F.sum("n").over(before), F.lit(0)))
        end = tasks.agg(F.max(F.col("_first") + F.col("n"))).first()[0]
        numbered = rows.join(F.broadcast(tasks.drop("n")), "_task").withColumn(
            "seq", (F.col("_first") + F.col("_row").bitwiseAND((1 << _ROW_BITS) - 1)).cast("long"))
        out = numbered.drop("_task", "_row", "_first").withColumn(
            "bucket", F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int"))
        # Rebalancing splits the files of a bucket that one key has filled.
        out.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
        end = first if end is None else end
        publish(self.spark, self.path, segment, {"next": end})
        return first, end

    def _complete(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self) -> DataFrame:
        """All published events, in no particular order."""
        version, _ = current(self.spark, self.path)
        rows = self.spark.read.option("basePath", f"{self.path}/log").parquet(f"{self.path}/log/segment=*")
        return rows.where(F.col("segment") <= version).drop("segment", "bucket")

    def read_stream(self, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
        """The log as a stream; ``schema`` holds the event columns and ``seq``."""
        reader = self.spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(f"{self.path}/log")
