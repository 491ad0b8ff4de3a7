"""Publishing days into the lake, and proof that nothing else changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.functions import hour_label
from afterglow.operators.manifest import expected_hours
from afterglow.operators.reconcile import day_summary, differences
from afterglow.operators.tiers import write_days


def publish_days(spark: SparkSession, days: DataFrame, path: str, states: DataFrame | None = None) -> None:
    """Replace the days at hand in the lake. With the days' states, only compacted ones may be published."""
    if states is not None:
        wrong = days.select("dt").distinct().join(states.filter("status = 'compacted'"), "dt", "left_anti").limit(1).collect()
        if wrong:
            raise ValueError(f"day {wrong[0]['dt']} is not compacted")
    write_days(days, path)


def republish(spark: SparkSession, days: DataFrame, path: str, value: str = "views") -> DataFrame:
    """Publish, then give the days that changed against a summary taken before; other days must not be among them.

    Only the months of the days at hand are summed, so the work does not grow with the lake.
    """
    months = [r["m"] for r in days.select(F.trunc("dt", "month").alias("m")).distinct().collect()]  # one row a month at hand
    near = reduce(lambda a, b: a | b, [F.col("dt").between(F.lit(m), F.last_day(F.lit(m))) for m in months], F.lit(False))
    summed = lambda: day_summary(spark.read.parquet(path).filter(near).select(days.columns), "dt", value, *sorted(days.columns))
    before = summed()
    before = spark.createDataFrame(before.collect(), before.schema)  # one row a day of those months, taken before the write
    publish_days(spark, days, path)
    spark.catalog.refreshByPath(path)
    changed = differences(before, summed(), ["dt"])
    others = changed.join(days.select("dt").distinct(), "dt", "left_anti").limit(1).collect()
    if others:
        raise ValueError(f"day {others[0]['dt']} changed and was not published")
    return changed


def retirable(staging: DataFrame, states: DataFrame) -> DataFrame:
    """(dt, key) of staging objects that may go: those of published days."""
    return staging.join(states.filter(F.col("published")), "dt", "left_semi").select("dt", "key")


def publication(states: DataFrame, hours: DataFrame, daily: DataFrame, hourly: DataFrame) -> DataFrame:
    """(dt, state, problems) of days after their replacement in the lake, held against what the manifest recorded.

    states: (dt, status, rows, views); hours: (hour, rows). A day's rows and views are one point, the hourly rows of each of
    its 24 source hours another; a count that was not recorded equals none. Days that are not compacted are refused, those
    with a problem stay replacing, the others are published.
    """
    stored = daily.groupBy("dt").agg(F.count(F.lit(1)).alias("_rows"), F.sum("views").alias("_views"))
    want = lambda name: F.coalesce(name, F.lit(-1))
    off = (F.coalesce("_rows", F.lit(0)) != want("rows")) | (F.coalesce("_views", F.lit(0)) != want("views"))
    days = states.join(stored, "dt", "left").select("dt", "status", off.cast("int").alias("_day"))
    found = hourly.groupBy(hour_label(F.col("hour_start")).alias("hour")).agg(F.count(F.lit(1)).alias("_rows"))
    each = expected_hours(states.select("dt")).join(hours.select("hour", "rows"), "hour", "left").join(found, "hour", "left")
    wrong = each.groupBy("dt").agg(F.count_if(F.coalesce("_rows", F.lit(0)) != want("rows")).alias("_hours"))
    problems = F.col("_day") + F.col("_hours")
    state = F.when(~F.col("status").eqNullSafe("compacted"), "refused").when(problems > 0, "replacing").otherwise("published")
    return days.join(wrong, "dt").select("dt", state.alias("state"), problems.alias("problems"))


def retire(spark: SparkSession, staging: DataFrame, states: DataFrame) -> int:
    """Delete the staging objects (dt, key) of published days, and say how many there were; days not published are refused.

    Objects that are gone already count for nothing, so a run that broke off may be repeated. Keys are 25 a day.
    """
    held = staging.select("dt").distinct().join(states.filter(F.col("published")), "dt", "left_anti").limit(1).collect()
    if held:
        raise ValueError(f"day {held[0]['dt']} is not published; its staging is the only other copy")
    conf, gone = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for row in retirable(staging, states).toLocalIterator():
        path = spark._jvm.org.apache.hadoop.fs.Path(row["key"])
        gone += path.getFileSystem(conf).delete(path, False)
    return gone


def missing_months(source: DataFrame, stored: DataFrame, day: str = "dt", stored_day: str | None = None) -> DataFrame:
    """(month_start, month_end) of the months of the source that the lake has no day of."""
    months = lambda df, of: df.select(F.trunc(of, "month").alias("month_start")).distinct()
    return months(source, day).join(months(stored, stored_day or day), "month_start", "left_anti").withColumn("month_end", F.last_day("month_start"))
