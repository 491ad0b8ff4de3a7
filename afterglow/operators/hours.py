"""Hours around spikes: windows, the range join, and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig


def spike_windows(spikes: DataFrame, config: SpikeConfig) -> DataFrame:
    """(spike_id, page_title, w_start, w_end): hours before and after 00:00 of the start, cut at the end of the data."""
    start = F.col("spike_start").cast("timestamp_ntz")
    end = F.least(start + F.expr(f"INTERVAL '{config.spine_after}' HOUR"), F.lit(config.data_end_hour).cast("timestamp_ntz"))
    return spikes.select("spike_id", "page_title", (start - F.expr(f"INTERVAL '{config.spine_before}' HOUR")).alias("w_start"), end.alias("w_end"))


def hours_in_windows(hourly: DataFrame, windows: DataFrame) -> DataFrame:
    """(spike_id, hour_start, views) of the hours inside a window of their page; an hour may lie in several.

    Title equality carries the join, the range is its residual; Spark broadcasts the windows where they are small.
    """
    inside = (hourly["page_title"] == windows["page_title"]) & F.col("hour_start").between(F.col("w_start"), F.col("w_end"))
    return hourly.join(windows, inside).select("spike_id", "hour_start", "views")


def spike_hours(hourly: DataFrame, spikes: DataFrame, config: SpikeConfig) -> DataFrame:
    """Every hour of every spike's window, 0 where the page had no row."""
    windows = spike_windows(spikes, config)
    # a window that ends before it starts has no hours
    spine = windows.filter("w_start <= w_end").select("spike_id", "page_title", F.explode(F.expr("sequence(w_start, w_end, INTERVAL 1 HOUR)")).alias("hour_start"))
    joined = spine.join(hours_in_windows(hourly, windows), ["spike_id", "hour_start"], "left")
    return joined.select("spike_id", "page_title", "hour_start", F.coalesce("views", F.lit(0)).alias("views"), F.col("views").isNull().alias("zero_filled"))


def incomplete_spines(hours: DataFrame, spikes: DataFrame, config: SpikeConfig) -> DataFrame:
    """Spikes whose hour spine has not exactly one row for each hour of the window."""
    expected = spike_windows(spikes, config).select("spike_id", F.greatest(F.timestamp_diff("HOUR", F.col("w_start"), F.col("w_end")) + 1, F.lit(0)).alias("expected"))
    actual = hours.groupBy("spike_id").agg(F.count(F.lit(1)).alias("actual"), F.count_distinct("hour_start").alias("different"))
    wrong = expected.join(actual, "spike_id", "left").fillna(0, ["actual", "different"])
    return wrong.filter("actual <> expected OR different <> expected").select("spike_id", "expected", "actual")
