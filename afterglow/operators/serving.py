"""What is served: curves, leaderboards, quartiles, headline numbers, prefix search and single spikes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig
from afterglow.functions import bucket_of, excess48, hours_between, nearest_rank, ordered_series, search_key

ITEM_FIELDS = ["spike_id", "page_title", "spike_start", "onset_hour", "peak_hour", "peak_views", "peak_day_views", "baseline_hourly", "attention_half_life_hours", "long_tail_share", "peak_hour_half_life_hours", "total_excess_720h", "window_end"]


def curves(facts: DataFrame, hours: DataFrame, config: SpikeConfig) -> DataFrame:
    """Items of eligible spikes with `curve`, their hourly views from the onset on; shorter where the data ends."""
    eligible = facts.filter("leaderboard_eligible").select(*ITEM_FIELDS)
    span = eligible.select(F.col("spike_id").alias("_id"), "onset_hour")
    end = F.col("onset_hour") + F.expr(f"INTERVAL '{config.horizon}' HOUR")
    inside = hours.join(span, (hours["spike_id"] == span["_id"]) & (F.col("hour_start") >= F.col("onset_hour")) & (F.col("hour_start") < end))
    series = inside.groupBy("_id").agg(ordered_series(F.col("hour_start"), F.col("views")).alias("curve"))
    return eligible.join(series, eligible["spike_id"] == series["_id"]).drop("_id")


def curve_text(curve: Column) -> Column:
    return F.array_join(F.transform(curve, lambda v: v.cast("string")), ",")


def index_items(items: DataFrame) -> DataFrame:
    """Items with the partition and sort key of the search index."""
    return items.withColumn("bucket", bucket_of(F.col("page_title"))).withColumn("search_key", F.concat(search_key(F.col("page_title")), F.lit("#"), F.col("spike_start").cast("string")))


def search(index: DataFrame, text: str, config: SpikeConfig) -> DataFrame:
    """Items whose title begins with the text, in order of their key, a page of results. One bucket is read."""
    key = "_".join(text.strip().split(" ")).lower()
    if not 0 < len(text.strip()) <= 100:
        raise ValueError("a search text has 1 to 100 characters")
    hits = index.filter((F.col("bucket") == key[:1]) & F.col("search_key").startswith(key)).orderBy("search_key", "spike_id").limit(config.search_limit)
    return hits.select("spike_id", "page_title", "spike_start", "attention_half_life_hours", "peak_day_views")


def spike_detail(items: DataFrame, spike_id: str | None = None) -> DataFrame:
    """Items with views and excess per hour, rounded half to even and never negative."""
    chosen = items if spike_id is None else items.filter(F.col("spike_id") == spike_id)
    excess = F.transform("curve", lambda v: F.greatest(F.bround(v - F.col("baseline_hourly"), 0), F.lit(0.0)).cast("long"))
    return chosen.withColumn("views", F.col("curve")).withColumn("excess", excess).drop("curve")


def leaderboard(facts: DataFrame, config: SpikeConfig, slowest: bool = False) -> DataFrame:
    """Fastest or slowest eligible spikes that have a half-life; ties by size of the peak day, then by id."""
    half = F.col("attention_half_life_hours")
    ranked = facts.filter(F.col("leaderboard_eligible") & half.isNotNull()).orderBy(half.desc() if slowest else half.asc(), F.col("peak_day_excess").desc(), "spike_id").limit(config.leaderboard_size)
    return ranked.select("spike_id", "page_title", "spike_start", "attention_half_life_hours", F.round("long_tail_share", 3).alias("long_tail_share"), "peak_day_views")


def numbered(board: DataFrame) -> DataFrame:
    """A leaderboard with the rank of its rows, in the order they come in."""
    return board.coalesce(1).withColumn("rank", F.monotonically_increasing_id())


def first_bucket(text: str) -> str:
    """The bucket of a title or of an id, which begins with its title."""
    return text.strip().replace(" ", "_").lower()[:1]


def quartiles(facts: DataFrame, column: str, where: Column) -> DataFrame:
    """(n, q1, median, q3) by nearest rank of the non-null values where a condition holds."""
    values = facts.select(F.when(where, F.col(column)).alias("value"))
    return values.agg(F.count("value").alias("n"), *(nearest_rank("value", share).cast("double").alias(name) for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))))


def big_spikes(config: SpikeConfig) -> Column:
    return F.coalesce((F.col("peak_day_excess") >= config.leaderboard_min_peak_day_excess) & ~F.col("burst") & ~F.col("calendar_page"), F.lit(False))


def headline(facts: DataFrame, config: SpikeConfig, **ranked: tuple[str, Column]) -> DataFrame:
    """One row of totals, flags and spans; `name=(column, where)` adds a struct of nearest-rank quartiles."""
    big = big_spikes(config)
    values = facts.withColumns({f"_{name}": F.when(where, F.col(column)) for name, (column, where) in ranked.items()}) if ranked else facts
    shares = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    return values.agg(
        F.count(F.lit(1)).alias("spikes_detected"), F.count_distinct("page_title").alias("pages_with_spikes"), F.count_if("leaderboard_eligible").alias("qualifying_spikes"),
        F.count_if(F.col("leaderboard_eligible") & F.col("window_end")).alias("qualifying_censored"), *(F.count_if(flag).alias(flag) for flag in ("burst", "rekindled", "calendar_page", "window_end")),
        F.count_if(big).alias("big_spikes"), F.count_if(big & F.col("rekindled")).alias("rekindled_among_big"),
        F.try_divide(F.count_if("window_end"), F.count(F.lit(1))).alias("window_end_share"), F.min("spike_start").alias("first_spike"), F.max("spike_start").alias("last_spike"),
        *(F.struct(F.count(f"_{name}").alias("n"), *(nearest_rank(f"_{name}", share).cast("double").alias(part) for part, share in shares)).alias(name) for name in ranked),
    )


def day_shares(hours: DataFrame, facts: DataFrame, config: SpikeConfig) -> DataFrame:
    """Cumulative share of a spike's excess by days from its onset, rounded to six digits."""
    span = facts.select(F.col("spike_id").alias("_id"), "onset_hour", "baseline")
    joined = hours.join(span, hours["spike_id"] == span["_id"]).withColumn("idx", hours_between(F.col("hour_start"), F.col("onset_hour"))).filter(F.col("idx").between(0, config.horizon - 1))
    day = F.floor(F.col("idx") / float(config.block_hours)).cast("long").alias("day")
    daily = joined.groupBy("spike_id", day).agg(F.sum(F.greatest(excess48(F.col("views"), F.col("baseline")), F.lit(0))).alias("x48"))
    spike = Window.partitionBy("spike_id")
    share = F.sum("x48").over(spike.orderBy("day")) / F.nullif(F.sum("x48").over(spike), F.lit(0))
    return daily.select("spike_id", "day", F.round(share, 6).alias("share"))
