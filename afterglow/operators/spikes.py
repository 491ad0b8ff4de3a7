"""Baselines, qualifying days, and their merge into spikes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig
from afterglow.functions import qualifies, spike_key


def baselines(spine: DataFrame, config: SpikeConfig) -> DataFrame:
    """(page_title, dt, daily_views, baseline_days, baseline) of the days that could qualify.

    The baseline is the exact median of the rows from `offset + days - 1` to `offset` before; the spine has one row a
    day, and null days are left out. A page's days are gathered to one array, no longer than the calendar, and medians
    are taken only for the few days that could qualify: a sliding window would sort the frame of every day.
    """
    width, last = config.baseline_days, config.baseline_offset
    pages = spine.groupBy("page_title").agg(F.array_sort(F.collect_list(F.struct("dt", F.col("daily_views").cast("long").alias("v")))).alias("days"))
    days = F.col("days")

    def judged(i):
        """The day at place i with the known values of its window, sorted."""
        first = F.greatest(i - (last + width - 1), F.lit(0))
        length = F.greatest(i - last + 1 - first, F.lit(0))
        window = F.array_sort(F.filter(F.transform(F.slice(days, first + 1, length), lambda d: d["v"]), lambda v: v.isNotNull()))
        return F.struct(F.get(days, i)["dt"].alias("dt"), F.get(days, i)["v"].alias("daily_views"), window.alias("w"))

    could = lambda i: (F.get(days, i)["v"] >= config.candidate_views) & (F.get(days, i)["dt"] >= F.lit(config.first_evaluable))
    places = F.filter(F.sequence(F.lit(0), F.size(days) - 1), could)
    rows = pages.select("page_title", F.explode(F.transform(places, judged)).alias("d")).select("page_title", "d.*")
    n = F.size("w")
    middle = lambda place: F.get("w", F.floor(place).cast("int"))
    baseline = (middle((n - 1) / 2) + middle(n / 2)) / 2
    return rows.select("page_title", "dt", "daily_views", n.cast("long").alias("baseline_days"), F.when(n > 0, baseline).alias("baseline"))


def qualifying_days(based: DataFrame, config: SpikeConfig) -> DataFrame:
    return based.filter(qualifies(F.col("daily_views"), F.col("baseline"), config))


def merge_spikes(qualifying: DataFrame, config: SpikeConfig) -> DataFrame:
    """One row a spike: a page's qualifying days folded from its first, a new spike opening `merge_days` after the last start.

    The fold carries the spikes of a page with their own counts, so start values, counts and last days need no join back.
    """
    days = F.array_sort(F.collect_list(F.struct(F.col("dt").alias("dt"), F.col("daily_views").cast("long").alias("views"), F.col("baseline").alias("baseline"))))
    spike = "struct<start:date,views:bigint,baseline:double,days:bigint,last:date>"
    nothing = F.array().cast(f"array<{spike}>")

    def step(spikes, day):
        tail = F.try_element_at(spikes, F.lit(-1))
        opened = F.struct(day["dt"].alias("start"), day["views"].alias("views"), day["baseline"].alias("baseline"), F.lit(1).cast("long").alias("days"), day["dt"].alias("last"))
        longer = F.struct(tail["start"].alias("start"), tail["views"].alias("views"), tail["baseline"].alias("baseline"), (tail["days"] + 1).alias("days"), day["dt"].alias("last"))
        opens = (F.size(spikes) == 0) | (F.date_diff(day["dt"], tail["start"]) >= config.merge_days)
        before = F.when(opens, spikes).otherwise(F.slice(spikes, 1, F.greatest(F.size(spikes) - 1, F.lit(0))))
        return F.concat(before, F.array(F.when(opens, opened).otherwise(longer)).cast(f"array<{spike}>"))

    merged = qualifying.groupBy("page_title").agg(F.aggregate(days, nothing, step).alias("spikes")).select("page_title", F.explode("spikes").alias("s"))
    return merged.select(
        spike_key(F.col("page_title"), F.col("s.start")).alias("spike_id"), "page_title", F.col("s.start").alias("spike_start"), F.col("s.views").alias("start_daily_views"),
        F.col("s.baseline").alias("baseline"), (F.col("s.baseline") / 24).alias("baseline_hourly"), F.col("s.days").alias("qualifying_days"), F.col("s.last").alias("last_qualifying_day"),
    )


def first_qualifying_day(qualifying: DataFrame) -> DataFrame:
    """A page's first qualifying day, with its views and baseline."""
    first = F.min(F.struct("dt", "daily_views", "baseline")).alias("f")
    return qualifying.groupBy("page_title").agg(first).select("page_title", "f.dt", "f.daily_views", "f.baseline")
