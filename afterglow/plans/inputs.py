"""The generated tables read as page views: suppliers' quantities by day, and users' events by hour."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig
from afterglow.operators import decay, hours, spikes, spine
from afterglow.session import materialise, table

#: Thresholds that the small tables can meet.
SUPPLIERS = SpikeConfig(window_start=date(1995, 1, 2), window_end=date(2001, 11, 4), margin=20, floor_views=50, candidate_views=50)
EVENTS = SpikeConfig(
    window_start=date(2024, 1, 1), window_end=date(2024, 1, 30), data_end_hour=datetime(2024, 1, 30, 23), hourly_floor=1, daily_floor=2, baseline_days=7,
    evaluation_offset_days=9, ratio=3, margin=3, floor_views=5, candidate_views=5, merge_days=7, spine_after=146, horizon=96, tail_from=48, silent_views=2,
    burst_ratio=2, leaderboard_min_peak_day_excess=4,
)
#: A day whose source counts as incomplete in each input.
INCOMPLETE = {"suppliers": date(1997, 6, 13), "events": date(2024, 1, 15)}


def event_title(user):
    """Names that exercise exclusion and calendar rules."""
    text = user.cast("string")
    return (
        F.when(user % 25 == 0, F.concat(F.lit("Special:User_"), text))
        .when(user % 10 == 1, F.concat(F.lit("Deaths_in_"), text))
        .when(user % 10 == 2, F.concat(F.lit("List_January_2024_"), text))
        .otherwise(F.concat(F.lit("User "), text))
    )


def supplier_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_title, dt, views) of suppliers."""
    items = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("Supplier_"), F.col("l_suppkey").cast("string")).alias("page_title"), F.to_date("l_shipdate").alias("dt"), "l_quantity")
    return items.groupBy("page_title", "dt").agg(F.sum("l_quantity").cast("long").alias("views"))


def event_hours(spark: SparkSession, sf_dir: str, config: SpikeConfig | None = None) -> DataFrame:
    """(page_title, hour_start, views) of users; with a config only of its window, a filter that reaches the scan."""
    events = table(spark, sf_dir, "events")
    if config:
        events = events.filter((F.col("ts") >= F.lit(config.window_start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(config.window_end + timedelta(days=1)).cast("timestamp_ntz")))
    hourly = events.select(event_title(F.col("user_id")).alias("page_title"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"))
    return hourly.groupBy("page_title", "hour_start").agg(F.count(F.lit(1)).alias("views"))


def event_days(spark: SparkSession, sf_dir: str, config: SpikeConfig | None = None) -> DataFrame:
    return event_hours(spark, sf_dir, config).groupBy("page_title", F.to_date("hour_start").alias("dt")).agg(F.sum("views").alias("views"))


def all_days(spark: SparkSession, config: SpikeConfig, without: date) -> DataFrame:
    """The calendar of complete days: every day of the window but one."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(config.window_start), F.lit(config.window_end), F.expr("INTERVAL 1 DAY"))).alias("dt"))
    return days.filter(F.col("dt") != F.lit(without)).withColumn("hours_done", F.lit(24))


@dataclass
class Chain:
    """The model chain over one input; every step is made when it is first asked for.

    Steps are lazy, but for the spikes where hours follow: they are few, and hours, measures and facts all read them, so
    they are written once instead of being worked out again for each.
    """

    spark: SparkSession
    sf_dir: str
    source: str
    config: SpikeConfig

    @cached_property
    def daily(self) -> DataFrame:
        days = event_days(self.spark, self.sf_dir, self.config) if self.source == "events" else supplier_days(self.spark, self.sf_dir)
        return spine.stage_daily(days, self.config)

    @cached_property
    def candidates(self) -> DataFrame:
        return spine.candidate_pages(self.daily, self.config)

    @cached_property
    def zero_filled(self) -> DataFrame:
        return spine.zero_filled_daily(self.daily, self.candidates, all_days(self.spark, self.config, INCOMPLETE[self.source]), self.config)

    @cached_property
    def based(self) -> DataFrame:
        return spikes.baselines(self.zero_filled, self.config)

    @cached_property
    def qualifying(self) -> DataFrame:
        return spikes.qualifying_days(self.based, self.config)

    @cached_property
    def spikes(self) -> DataFrame:
        merged = spikes.merge_spikes(self.qualifying, self.config)
        return materialise(merged) if self.source == "events" else merged

    @cached_property
    def hourly(self) -> DataFrame | None:
        return spine.stage_hourly(event_hours(self.spark, self.sf_dir, self.config), self.config) if self.source == "events" else None

    @cached_property
    def hours(self) -> DataFrame | None:
        return hours.spike_hours(self.hourly, self.spikes, self.config) if self.source == "events" else None

    @cached_property
    def facts(self) -> DataFrame | None:
        return decay.half_lives(self.hours, self.spikes, self.zero_filled, self.config) if self.source == "events" else None


def chain(spark: SparkSession, sf_dir: str, source: str = "events", config: SpikeConfig | None = None) -> Chain:
    """Staging, candidates, spine, baselines, spikes; for events also hours and the half-life fact."""
    return Chain(spark, sf_dir, source, config or {"events": EVENTS, "suppliers": SUPPLIERS}[source])


def register(found: Chain, prefix: str = "") -> list[str]:
    """Make the steps of a chain available to SQL as temporary views; gives their names."""
    names = {"stg_page_daily": found.daily, "int_candidate_pages": found.candidates, "int_page_daily": found.zero_filled, "int_baselines": found.based, "int_spikes": found.spikes, "stg_page_hour": found.hourly, "int_spike_hours": found.hours, "fct_half_life": found.facts}
    for name, df in names.items():
        if df is not None:
            df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name, df in names.items() if df is not None]
