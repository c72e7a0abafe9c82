"""Daily totals kept by a stream of event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import scratch_path
from tidemill.sources import schemas


def totals() -> list:
    return [
        F.count("*").alias("n_events"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"),
        F.max("event_id").alias("last_event"),
    ]


def event_stream(spark: SparkSession, folder: str, pattern: str = "events.parquet", files_per_trigger: int | None = None
                 ) -> DataFrame:
    """All event files of a folder, old and new; ``files_per_trigger`` only cuts the work, never the result."""
    files = spark.readStream.schema(schemas.TABLES["events"]).option("pathGlobFilter", pattern)
    return (files.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else files).parquet(folder)


def run_daily_totals(stream: DataFrame, checkpoint: str) -> None:
    """Adds all files not seen before to the totals kept in ``checkpoint`` and stops.

    The state is one row per day and never expires, so files may come in any order, days apart, and in any number of
    micro-batches. Started again with the same checkpoint it goes on where it stopped. There must be a file.
    """
    daily = stream.withColumn("day", F.to_date("ts")).groupBy("day").agg(*totals())
    query = (
        daily.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def current_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The totals of all events the stream has met, read from its state."""
    kept = spark.read.format("statestore").load(checkpoint)
    return kept.select(
        F.col("key.day").alias("day"), F.col("value.count").alias("n_events"),
        F.col("value.sum").alias("total_value"), F.col("value.max").alias("last_event"),
    )


def stream_daily_totals(spark: SparkSession, folder: str) -> DataFrame:
    checkpoint = scratch_path(spark, "daily-state")
    run_daily_totals(event_stream(spark, folder), checkpoint)
    return current_totals(spark, checkpoint)
