"""Scalar columns and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from afterglow.config import CALENDAR_PREFIX, EXCLUDED_NAMESPACES, EXCLUDED_TITLES, MONTHS, SpikeConfig


def is_excluded(title: Column) -> Column:
    """Titles that are no articles: two exact ones, and name spaces at the start only."""
    spaces = [title.startswith(f"{n}:") for n in EXCLUDED_NAMESPACES]
    return title.isin(*EXCLUDED_TITLES) | reduce(lambda a, b: a | b, spaces)


def is_excluded_bytes(title: Column) -> Column:
    """The same on raw bytes, before anything is decoded."""
    exact = [title == F.lit(t.encode()) for t in EXCLUDED_TITLES]
    spaces = [F.startswith(title, F.lit(f"{n}:".encode())) for n in EXCLUDED_NAMESPACES]
    return reduce(lambda a, b: a | b, exact + spaces)


def calendar_page(title: Column) -> Column:
    """List pages of a month: by prefix, or a month and a year anywhere."""
    return title.startswith(CALENDAR_PREFIX) | title.rlike(f"(?:{'|'.join(MONTHS)})_[0-9]{{4}}")


def in_window(day: Column, config: SpikeConfig) -> Column:
    return day.between(F.lit(config.window_start), F.lit(config.window_end))


def qualifies(views: Column, baseline: Column, config: SpikeConfig) -> Column:
    """Ratio, margin and floor against the day's own baseline; false without one."""
    enough = (views >= config.ratio * baseline) & (views >= baseline + config.margin) & (views >= config.floor_views)
    return F.coalesce(enough, F.lit(False))


def excess48(views: Column, baseline: Column) -> Column:
    """48 times the hourly excess over a daily baseline: an exact integer, as baselines are multiples of a half."""
    return 48 * views.cast("long") - (2 * baseline).cast("long")


def spike_key(title: Column, start: Column) -> Column:
    return F.concat_ws("|", title, start.cast("string"))


def hours_between(later: Column, earlier: Column) -> Column:
    """Whole hours from `earlier` to `later`; both are whole hours."""
    return F.timestamp_diff("HOUR", earlier, later)


def day_of(hour_start: Column) -> Column:
    return F.to_date(hour_start)


def hour_label(hour_start: Column) -> Column:
    """Label of the source file of an hour: files are named by the end of their hour."""
    return F.date_format(hour_start + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH")


def source_url(base: str, hour_start: Column) -> Column:
    """Place of an hour's file under a mirror."""
    end = hour_start + F.expr("INTERVAL 1 HOUR")
    return F.concat(F.lit(base.rstrip("/") + "/"), F.date_format(end, "yyyy/yyyy-MM/'pageviews-'yyyyMMdd'-'HH'0000.gz'"))


def search_key(title: Column) -> Column:
    """Titles and what is searched for, made comparable."""
    return F.lower(F.replace(F.trim(title), F.lit(" "), F.lit("_")))


def bucket_of(title: Column) -> Column:
    """Partition of the search index: the first character of the key."""
    return F.substring(search_key(title), 1, 1)


def percent_encoded(title: Column) -> Column:
    """Percent-encoding with %20 for spaces."""
    return F.replace(F.url_encode(title), F.lit("+"), F.lit("%20"))


def human_bytes(size: Column) -> Column:
    """Bytes in the largest unit that leaves at least one, with one decimal."""
    out = F.concat(size.cast("string"), F.lit(" B"))
    for power, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), 1):
        out = F.when(size >= 1024**power, F.concat(F.format_number(size / float(1024**power), 1), F.lit(f" {unit}"))).otherwise(out)
    return out


def strata(value: Column, edges: list[int]) -> Column:
    """Number of the half-open range [edges[i], edges[i+1]) that a value lies in; null outside."""
    out = F.lit(None).cast("int")
    for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        out = F.when((value >= low) & (value < high), i).otherwise(out)
    return out
