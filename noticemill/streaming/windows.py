"""Streaming delivery: daily windows over events, and change detection batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import diff
from ..sinks import scratch, store


def daily(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Events and values by day and type; works on streams and on tables."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    days = events.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w"), "event_type")
    sums = days.agg(F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value"))
    return sums.select(F.col("w.start").cast("date").alias("day"), "event_type", "events", F.round("value", 2).alias("value"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the Parquet files that ``path`` names, a file or a folder."""
    schema = spark.read.parquet(path).schema
    # as a pattern, since a file stream takes a plain path for a folder
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def drain(result: DataFrame, folder: str | None = None) -> DataFrame:
    """All that a streaming aggregate has to say about the input there is now, one row a group; no rows without input.

    Each batch replaces the files under ``folder`` (a new one in the shared place if None), which are read back; nothing
    is gathered on the driver, and a batch that is repeated changes nothing.
    """
    spark = result.sparkSession
    where = folder or scratch.folder(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{where}/rows")

    stream = result.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{where}/progress")
    stream.trigger(availableNow=True).start().awaitTermination()
    if folder is None:
        scratch.remove(spark, f"{where}/progress")  # nobody goes on from here
    return scratch.read(spark, f"{where}/rows", result.schema)


def event_days(spark: SparkSession, path: str) -> DataFrame:
    """Daily windows of the events under ``path``, a file or a folder, read as a stream of files."""
    return drain(daily(_files(spark, path)))


def once(events: DataFrame, id_col: str = "event_id", late: str = "1 day") -> DataFrame:
    """A stream's events without repeats: an id counts once among events that come no more than ``late`` apart.

    The state holds the ids of that time only; events that are later than ``late`` behind the newest are dropped.
    """
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark([id_col])


def closed(events: DataFrame, width: str = "1 day") -> DataFrame:
    """Events and values by window and type, for a stream that has a watermark on ``ts``; a window comes once, when it is closed."""
    windows = events.groupBy(F.window("ts", width).alias("w"), "event_type")
    sums = windows.agg(F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value"))
    return sums.select(F.col("w.start").alias("window_start"), "event_type", "events", F.round("value", 2).alias("value"))


@dataclass(frozen=True)
class Appended:
    """All rows of an append-only stream so far, and how many input rows of this run came too late to count."""

    rows: DataFrame
    late: int


def append(result: DataFrame, folder: str) -> Appended:
    """Take in what has come since the last call with ``folder``, which keeps progress, state and rows.

    A batch writes a folder of its own, which a repeat after a stop replaces, so that no row comes twice.  The count of late rows is
    that of the session's recent batches, a hundred unless it says otherwise; one call has a batch or two.
    """
    spark = result.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    stream = result.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{folder}/progress")
    run = stream.trigger(availableNow=True).start()
    run.awaitTermination()
    late = sum(op["numRowsDroppedByWatermark"] for p in run.recentProgress for op in p["stateOperators"])
    schema = T.StructType([*result.schema.fields, T.StructField("batch", T.IntegerType())])
    return Appended(scratch.read(spark, f"{folder}/rows", schema).drop("batch"), late)


def closed_days(spark: SparkSession, path: str, late: str = "1 day") -> DataFrame:
    """Daily windows that no event can still reach: those that end ``late`` or more before the newest event."""
    found = append(closed(once(_files(spark, path), late=late)), scratch.folder(spark)).rows
    return found.select(F.col("window_start").cast("date").alias("day"), "event_type", "events", "value")


def log_changes(baseline: Callable[[], DataFrame], log_path: str, columns: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that compares every batch with ``baseline()`` and adds its line to the change log, once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        entry = diff.change_entry(batch, baseline(), f"batch {batch_id}", columns)
        store.append_change(entry, log_path, f"batch-{batch_id}")

    return write
