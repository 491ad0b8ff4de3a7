"""Structured Streaming forms of hourly and daily totals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from afterglow.operators.tiers import write_days


def page_totals(stream: DataFrame, width: str, late: str = "25 hours") -> DataFrame:
    """(page_title, window_start, views) by tumbling windows of event time; a window closes when the watermark passes it.

    `stream` has page_title, ts and views. Keys are pre-aggregated in each micro-batch before they meet the state.
    """
    totals = stream.withWatermark("ts", late).groupBy(F.window("ts", width), "page_title").agg(F.sum("views").alias("views"))
    return totals.select("page_title", F.col("window.start").alias("window_start"), "views")


def decay_by_event(stream: DataFrame, width: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Mentions of each event by batches of its age; `stream` has event and ts."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width), "event").agg(F.count(F.lit(1)).alias("mentions")).select("event", F.col("window.start").alias("window_start"), "mentions")


def read_table(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """A folder of Parquet files as a stream, in bounded micro-batches."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ingest_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there and stop; the checkpoint makes each batch count once when the sink is idempotent."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replace_days(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that replaces the days of a batch, so a batch that is run again changes nothing."""
    return lambda batch, _: write_days(batch, path)
