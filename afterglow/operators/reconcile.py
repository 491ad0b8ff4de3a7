"""Reconciliation: checksums, full-outer comparison, multiset differences, and data checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from afterglow.config import EXCLUDED_NAMESPACES, EXCLUDED_TITLES
from afterglow.functions import checksum


def day_summary(rows: DataFrame, key: str, value: str, *columns: str) -> DataFrame:
    """(key, rows, total, checksum) for each day, the checksum over all columns whatever the order of rows."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total"), checksum(*(columns or rows.columns)).alias("checksum"))


def differences(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that one side lacks or whose other columns differ, with both sides' values; nulls equal nulls."""
    others = [c for c in old.columns if c not in keys]
    left = old.select(*keys, *(F.col(c).alias(f"old_{c}") for c in others), F.lit(True).alias("_old"))
    right = new.select(*keys, *(F.col(c).alias(f"new_{c}") for c in others), F.lit(True).alias("_new"))
    same = reduce(lambda a, b: a & b, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in others], F.col("_old").isNotNull() & F.col("_new").isNotNull())
    status = F.when(F.col("_new").isNull(), "missing").when(F.col("_old").isNull(), "unexpected").otherwise("different")
    return left.join(right, keys, "full_outer").filter(~same).withColumn("status", status).drop("_old", "_new")


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side beyond the other's copies, with `side`."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def stale(stored: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Stored keys that are no longer current."""
    return stored.select(key).join(current.select(key), key, "left_anti")


# --- checks: each gives the rows that violate it


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNull())


def non_negative(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column) < 0)


def in_range(rows: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Nulls pass."""
    bad: Column = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return rows.filter(bad)


def unique(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def excluded_titles_left(*tables: DataFrame) -> DataFrame:
    """Titles of any table that should have been excluded, found by LIKE, a spelling of its own."""
    bad = reduce(lambda a, b: a | b, [F.col("page_title").like(f"{n}:%") for n in EXCLUDED_NAMESPACES], F.col("page_title").isin(*EXCLUDED_TITLES))
    return reduce(DataFrame.unionAll, [t.filter(bad).select("page_title") for t in tables])


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """(name, violations, ok) of named checks, in one plan."""
    parts = [rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("name"), "violations", (F.col("violations") == 0).alias("ok")) for name, rows in checks.items()]
    return reduce(DataFrame.unionAll, parts)
