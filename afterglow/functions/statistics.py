"""The three medians in use, nearest ranks, checksums and series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_median(value: Column) -> Column:
    """Interpolating median."""
    return F.percentile(value, 0.5)


def nearest_rank(column: str, share: float) -> Column:
    """The value at rank ceil(n · share) of a column's sorted values, nulls left out; merged from counts of values."""
    return F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY `{column}`)")


def upper_median(column: str) -> Column:
    """The value at place n // 2 of the sorted values, counted from zero: the middle rank from above."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}` DESC)")


def checksum(*columns: str) -> Column:
    """Checksum of a multiset of rows, whatever their order: the sum of their hashes, so that equal pairs do not cancel."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


def ordered_series(order: Column, value: Column) -> Column:
    """Values in the order of a key, as an array."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("k"), value.alias("v")))), lambda x: x["v"])
