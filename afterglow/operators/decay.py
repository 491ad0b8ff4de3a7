"""The half-life fact: every measure of a spike from one sorted pass over its hours.

All window functions share one exchange and one sort on (spike_id, hour_start), and the aggregation reuses the exchange.
Excess is held as an exact integer, 48 times the hourly excess over the daily baseline, so thresholds at a half or
a tenth are decided without rounding, whatever the order of sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig
from afterglow.functions import calendar_page, day_of, excess48, hours_between


def _spike():
    return Window.partitionBy("spike_id")


def _timeline():
    return _spike().orderBy("hour_start")


def peaks(hours: DataFrame, spikes: DataFrame, config: SpikeConfig) -> DataFrame:
    """Hours with x48, their spike's peak views (in the window from its start) and the earliest hour that has them."""
    own = spikes.select("spike_id", "spike_start", "baseline")
    start = F.col("spike_start").cast("timestamp_ntz")
    in_peak = (F.col("hour_start") >= start) & (F.col("hour_start") < start + F.expr(f"INTERVAL '{config.peak_window}' HOUR"))
    base = hours.select("spike_id", "hour_start", "views").join(own, "spike_id").withColumn("net48", excess48(F.col("views"), F.col("baseline")))
    base = base.withColumn("x48", F.greatest("net48", F.lit(0))).withColumn("at_peak", in_peak)
    base = base.withColumn("peak_views", F.max(F.when(F.col("at_peak"), F.col("views"))).over(_spike()))
    return base.withColumn("peak_hour", F.min(F.when(F.col("at_peak") & (F.col("views") == F.col("peak_views")), F.col("hour_start"))).over(_spike())).withColumn("p48", excess48(F.col("peak_views"), F.col("baseline")))


def onsets(peaked: DataFrame, config: SpikeConfig) -> DataFrame:
    """Adds onset_hour, the earliest hour up to the peak with a tenth of its excess, and hours from peak and onset."""
    back = F.expr(f"INTERVAL '{config.onset_lookback}' HOUR")
    near = F.col("hour_start").between(F.col("peak_hour") - back, F.col("peak_hour")) & (10 * F.col("x48") >= F.col("p48"))
    out = peaked.withColumn("onset_hour", F.min(F.when(near, F.col("hour_start"))).over(_spike()))
    return out.withColumn("rp", hours_between(F.col("hour_start"), F.col("peak_hour"))).withColumn("idx", hours_between(F.col("hour_start"), F.col("onset_hour")))


def measures(started: DataFrame, config: SpikeConfig) -> DataFrame:
    """Adds the running and total excess from the onset, the excess of each day from it, and the debounced fall."""
    counted = F.when(F.col("idx").between(0, config.horizon - 1), F.col("x48")).otherwise(F.lit(0))
    low = 2 * F.col("x48") <= F.col("p48")
    out = started.withColumn("in48", counted).withColumn("low", low)
    out = out.withColumn("cum48", F.sum("in48").over(_timeline().rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = out.withColumn("stays_low", F.col("low") & F.lead("low", 1).over(_timeline()) & F.lead("low", 2).over(_timeline()))
    out = out.withColumn("total48", F.sum("in48").over(_spike()))
    block = F.floor(F.col("idx") / float(config.block_hours))
    return out.withColumn("block", block).withColumn("block48", F.sum("in48").over(Window.partitionBy("spike_id", "block")))


def per_spike(measured: DataFrame, config: SpikeConfig) -> DataFrame:
    """One row a spike with every measure, in one aggregation."""
    c, early = config, config.early_blocks * config.block_hours
    pick = lambda condition, value: F.when(condition, value)
    rp, idx, x48, views = F.col("rp"), F.col("idx"), F.col("x48"), F.col("views")
    return measured.groupBy("spike_id").agg(
        *(F.max(name).alias(name) for name in ("peak_hour", "peak_views", "p48", "onset_hour", "total48")),
        F.min(pick(idx.between(0, c.horizon - 1) & (2 * F.col("cum48") >= F.col("total48")), idx + 1)).alias("half_life"),
        F.sum(pick(idx.between(c.tail_from, c.horizon - 1), x48).otherwise(0)).alias("tail48"),
        F.min(pick(rp.between(1, c.horizon) & F.col("stays_low"), rp)).alias("peak_hour_half_life_hours"),
        F.coalesce(F.max(pick(rp.between(-c.neighbour_hours, c.neighbour_hours) & (rp != 0), views)), F.lit(0)).alias("max_neighbour_views"),
        F.coalesce(F.max(pick(rp.between(-c.silent_hours, -1), views)), F.lit(0)).alias("before_views"),
        F.coalesce(F.max(pick(rp == 2, views)), F.lit(0)).alias("after_views"),
        F.sum(pick(rp.isin(0, 1), x48).otherwise(0)).alias("first48"),
        F.sum(pick(idx.between(0, c.block_hours - 1), x48).otherwise(0)).alias("day48"),
        F.max(pick(idx.between(0, early - 1), F.col("block48"))).alias("early48"),
        F.max(pick(idx.between(early, c.horizon - 1), F.col("block48"))).alias("later48"),
    )


def half_lives(hours: DataFrame, spikes: DataFrame, daily: DataFrame, config: SpikeConfig) -> DataFrame:
    """The fact: one row a spike with peak, onset, half-life, tail, flags and eligibility.

    `daily` is the zero-filled spine, whose row of the peak's day decides how big the spike was.
    """
    c = config
    found = per_spike(measures(onsets(peaks(hours, spikes, c), c), c), c)
    facts = spikes.join(found, "spike_id")
    peak_days = daily.select(F.col("page_title").alias("_page"), F.col("dt").alias("_day"), F.col("daily_views").alias("peak_day_views"))
    facts = facts.join(peak_days, (F.col("page_title") == F.col("_page")) & (day_of(F.col("peak_hour")) == F.col("_day")), "left")
    facts = facts.withColumn("window_end", F.col("onset_hour") + F.expr(f"INTERVAL '{c.horizon - 1}' HOUR") > F.lit(c.data_end_hour).cast("timestamp_ntz"))
    facts = facts.withColumn("peak_day_excess", F.col("peak_day_views") - F.col("baseline"))
    short = (F.col("before_views") < c.silent_views) & (2 * F.col("first48") >= F.col("day48")) & (10 * F.col("after_views") <= F.col("peak_views"))
    facts = facts.withColumn("short_burst", short).withColumn("burst", (F.col("peak_views") >= c.burst_ratio * F.col("max_neighbour_views")) | F.col("short_burst"))
    facts = facts.withColumn("rekindled", F.coalesce(F.col("later48") > F.col("early48"), F.lit(False))).withColumn("calendar_page", calendar_page(F.col("page_title")))
    clean = ~F.col("burst") & ~F.col("rekindled") & ~F.col("calendar_page")
    measured = lambda value: F.when(~F.col("window_end"), value)
    return facts.select(
        "spike_id", "page_title", "spike_start", "start_daily_views", "baseline", "baseline_hourly", "qualifying_days", "peak_hour", "peak_views",
        (F.col("p48") / 48).alias("peak_excess"), "onset_hour", "window_end",
        measured(F.col("half_life")).alias("attention_half_life_hours"),
        measured(F.col("tail48") / F.nullif(F.col("total48"), F.lit(0))).alias("long_tail_share"),
        (F.col("total48") / 48).alias("total_excess_720h"), "peak_hour_half_life_hours", "peak_day_views", "peak_day_excess", "max_neighbour_views",
        "burst", "short_burst", "rekindled", (F.col("early48") / 48).alias("peak_block_excess"), (F.col("later48") / 48).alias("max_later_block_excess"), "calendar_page",
        F.coalesce((F.col("peak_day_excess") >= c.leaderboard_min_peak_day_excess) & clean, F.lit(False)).alias("leaderboard_eligible"),
    )
