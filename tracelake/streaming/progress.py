"""Incremental processing: resumable appends, deduplication, windows and running totals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.session import scratch_of


def read_table(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table of a folder as a stream, with timestamps that take a watermark."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").option("recursiveFileLookup", "false")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(folder)
    return rows.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.simpleString() == "timestamp_ntz"})


def appended(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is new since the last call and append it; the checkpoint makes calls resume where they stopped."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def upserted(stream: DataFrame, keys: list[str], order: str, path: str, checkpoint: str) -> None:
    """Append each batch once per key, the greatest ``order`` first; :func:`latest` reads the last version of each key."""

    def batch(rows: DataFrame, epoch: int) -> None:
        last = rows.groupBy(*keys).agg(F.max(F.struct(order, *(c for c in rows.columns if c not in [order, *keys]))).alias("r")).select(*keys, "r.*")
        last.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")  # a repeated epoch replaces itself

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame:
    """Last version of each key of an at-least-once table."""
    rows = spark.read.parquet(path).drop("epoch")
    return rows.groupBy(*keys).agg(F.max(F.struct(order, *(c for c in rows.columns if c not in [order, *keys]))).alias("r")).select(*keys, "r.*")


def once_within(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """Rows delivered again within the watermark are dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def tumbling(rows: DataFrame, time: str, length: str, by: list[str], value: str, slide: str | None = None) -> DataFrame:
    """Count and sum by time window, tumbling or sliding."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return rows.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "total")


def sessions_of(rows: DataFrame, time: str, gap: str, by: list[str]) -> DataFrame:
    """Activity sessions: a session ends when nothing comes for ``gap``."""
    w = F.session_window(time, gap)
    return rows.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")


def drained(spark: SparkSession, stream: DataFrame, name: str, late: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run a stateless or complete stream over all that is there and return its table in the shared folder."""
    at = scratch_of(spark)
    appended(late(stream) if late else stream, f"{at}/{name}", f"{at}/{name}-checkpoint")
    return spark.read.parquet(f"{at}/{name}")
