"""Stored tiers: fan-out of an hour, compaction of partials into days, floors, and their writers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig

PROJECT = "en.wikipedia"


def page_hours(titles: DataFrame, config: SpikeConfig) -> DataFrame:
    """The sparse hourly tier of (page_title, hour_start, views): only hours at or over the floor."""
    return titles.filter(F.col("views") >= config.hourly_floor).select(F.lit(PROJECT).alias("project"), "page_title", "hour_start", "views")


def day_partials(titles: DataFrame) -> DataFrame:
    """What each hour contributes to its day, every title; not a total yet."""
    return titles.select(F.lit(PROJECT).alias("project"), "page_title", F.to_date("hour_start").alias("dt"), "views", F.lit(1).alias("hours_present"))


def compact(partials: DataFrame) -> DataFrame:
    """Partials of any number of hours summed to days; sums of days and partials may be compacted again."""
    return partials.groupBy("project", "page_title", "dt").agg(F.sum("views").alias("views"), F.sum("hours_present").cast("int").alias("hours_present"))


def compact_incrementally(parts: Iterable[DataFrame]) -> DataFrame:
    """The same from parts that come one after the other, each summed already or not: one union and one aggregation, as sums
    of sums are sums, so the growing total is not shuffled once a part."""
    return compact(reduce(DataFrame.unionByName, parts))


def apply_floor(days: DataFrame, floor: int) -> DataFrame:
    """Days at or over a floor; a floor of 0 or less keeps all."""
    return days.filter(F.col("views") >= floor) if floor > 0 else days


def floor_report(days: DataFrame, floor: int) -> DataFrame:
    """(rows, rows_kept, views, views_kept) at a floor."""
    kept = F.lit(True) if floor <= 0 else F.col("views") >= floor
    return days.agg(F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("rows_kept"), F.coalesce(F.sum("views"), F.lit(0)).alias("views"), F.coalesce(F.sum(F.when(kept, F.col("views"))), F.lit(0)).alias("views_kept"))


def refloor(days: DataFrame, applied: int, floor: int) -> DataFrame:
    """Raise the floor of stored days; it cannot be lowered, as what was under it is gone."""
    if floor < applied:
        raise ValueError(f"the floor was {applied} and can only be raised, not set to {floor}")
    return apply_floor(days, floor)


def write_days(days: DataFrame, path: str, sort: Iterable[str] = ("page_title",), partition: str = "dt", mode: str = "overwrite") -> None:
    """Sorted, compressed Parquet by day; only the days at hand are replaced, so a repeated run changes nothing else.

    Rows are dealt by day and by ranges of the sort key, so a large day is written by several tasks, each a sorted file.
    """
    keys = [partition, *sort]
    spread = days.repartitionByRange(*keys).sortWithinPartitions(*keys)
    spread.write.mode(mode).partitionBy(partition).option("compression", "zstd").option("partitionOverwriteMode", "dynamic").parquet(path)
