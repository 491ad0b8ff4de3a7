"""Staging, candidates, and the zero-filled date spine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig
from afterglow.functions import in_window, is_excluded


def stage_daily(page_daily: DataFrame, config: SpikeConfig) -> DataFrame:
    """(page_title, dt, daily_views) of articles inside the window."""
    return page_daily.filter(in_window(F.col("dt"), config) & ~is_excluded(F.col("page_title"))).select("page_title", "dt", F.col("views").alias("daily_views"))


def stage_hourly(page_hour: DataFrame, config: SpikeConfig) -> DataFrame:
    """(page_title, hour_start, dt, views) of articles inside the window."""
    staged = page_hour if "dt" in page_hour.columns else page_hour.withColumn("dt", F.to_date("hour_start"))
    return staged.filter(in_window(F.col("dt"), config) & ~is_excluded(F.col("page_title"))).select("page_title", "hour_start", "dt", "views")


def candidate_pages(daily: DataFrame, config: SpikeConfig) -> DataFrame:
    """Pages with at least one day of `candidate_views`; no other page can ever spike."""
    big = daily.filter(F.col("daily_views") >= config.candidate_views)
    return big.groupBy("page_title").agg(F.max("daily_views").alias("max_daily_views"), F.count(F.lit(1)).alias("days_over_1000"), F.min("dt").alias("first_day_over_1000"))


def complete_days(hours: DataFrame, expected: int = 24) -> DataFrame:
    """(dt, hours_done) of days all of whose source hours are there; a row is what says a day is complete."""
    done = hours.select(F.to_date("hour_start").alias("dt"), "hour_start").groupBy("dt").agg(F.count_distinct("hour_start").cast("int").alias("hours_done"))
    return done.filter(F.col("hours_done") >= expected)


def date_spine(pages: DataFrame, config: SpikeConfig) -> DataFrame:
    """Every page on every day of the window, one row each.

    The days are made inside each page's row, so no cross join is planned and nothing is broadcast.
    """
    days = F.sequence(F.lit(config.window_start), F.lit(config.window_end), F.expr("INTERVAL 1 DAY"))
    return pages.select("page_title", F.explode(days).alias("dt"))


def zero_filled_daily(daily: DataFrame, candidates: DataFrame, complete: DataFrame, config: SpikeConfig) -> DataFrame:
    """Daily views of candidates over the spine: 0 on quiet days, null where the day's source is incomplete.

    Observations are reduced to candidates by a semi-join before they meet the spine on (page_title, dt).
    """
    observed = daily.join(candidates.select("page_title"), "page_title", "left_semi").select("page_title", "dt", "daily_views")
    done = complete.select("dt", F.lit(True).alias("_done")).dropDuplicates(["dt"])
    joined = date_spine(candidates, config).join(observed, ["page_title", "dt"], "left").join(done, "dt", "left")
    views = F.when(F.col("_done").isNotNull(), F.coalesce("daily_views", F.lit(0)))
    return joined.select("page_title", "dt", views.alias("daily_views"), F.col("daily_views").isNull().alias("zero_filled"), F.col("_done").isNotNull().alias("source_complete"))


def missing_days(daily: DataFrame, candidates: DataFrame, config: SpikeConfig) -> DataFrame:
    """Spine days without an observation: an anti-join."""
    return date_spine(candidates, config).join(daily.select("page_title", "dt"), ["page_title", "dt"], "left_anti")
