"""The manifest as rows: what each day needs next, whether an hour may still be written, and state changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from afterglow.functions import hour_label

#: Attempts after which an hour is given up, and source hours of a day.
MAX_ATTEMPTS = 3
HOURS_OF_DAY = 24
REASON_CHARS = 900


def expected_hours(days: DataFrame) -> DataFrame:
    """(dt, hour) of the 24 source files of each day; the last is labelled midnight of the day after."""
    start = F.col("dt").cast("timestamp_ntz")
    hours = days.select("dt", F.explode(F.transform(F.sequence(F.lit(0), F.lit(HOURS_OF_DAY - 1)), lambda i: F.timestamp_add("HOUR", i, start))).alias("hour_start"))
    return hours.select("dt", hour_label(F.col("hour_start")).alias("hour"))


def day_plans(days: DataFrame, hours: DataFrame, states: DataFrame, now: int) -> DataFrame:
    """(dt, action, todo, done, held, exhausted, retrying, lease_until) of each day.

    hours: (hour, status, attempt, lease_expires); states: (dt, status) of days. A finished or started day is told by
    its own row; else open hours are ingested first, then leases waited for, then failures reported, then the day compacted.
    """
    joined = expected_hours(days).join(hours, "hour", "left")
    status, attempts = F.coalesce("status", F.lit("pending")), F.coalesce("attempt", F.lit(0))
    done, held = status == "done", (status == "in-flight") & (F.coalesce("lease_expires", F.lit(0)) >= now)
    failed = status == "failed"
    spent = failed & (attempts >= MAX_ATTEMPTS)
    todo = ~done & ~held & ~spent
    counts = joined.groupBy("dt").agg(
        *(F.count_if(c).alias(n) for c, n in ((todo, "todo"), (done, "done"), (held, "held"), (spent, "exhausted"), (todo & failed, "retrying"))),
        F.coalesce(F.max(F.when(held, F.col("lease_expires"))), F.lit(0)).cast("long").alias("lease_until"),
    )
    row = states.select("dt", F.col("status").alias("_state"))
    by_row = F.when(F.col("_state") == "compacted", "skip").when(F.col("_state") == "compacting", "resume-compaction").when(F.col("_state").isin("invalidated", "failed"), "blocked")
    by_hours = F.when(F.col("todo") > 0, "ingest").when(F.col("held") > 0, "wait").when(F.col("exhausted") > 0, "incomplete").otherwise("compact")
    return counts.join(row, "dt", "left").select("dt", F.coalesce(by_row, by_hours).alias("action"), "todo", "done", "held", "exhausted", "retrying", "lease_until")


def unfinished(plans: DataFrame) -> DataFrame:
    """(dt, reason) of the days that are not compacted, why in words."""
    reason = (
        F.when(F.col("action") == "incomplete", F.concat(F.lit("hours failed for good: "), F.col("exhausted")))
        .when(F.col("action") == "blocked", "the day's row blocks it")
        .otherwise(F.concat_ws("", F.col("action"), F.lit(": "), F.col("todo"), F.lit(" hours to do, "), F.col("held"), F.lit(" leased")))
    )
    return plans.filter(F.col("action") != "skip").select("dt", reason.alias("reason"))


def guard(requests: DataFrame, states: DataFrame) -> DataFrame:
    """(dt, hour, force, decision) for hours about to be written into days.

    A day being compacted refuses; a compacted one too, unless forced, which invalidates it; a day already invalidated first
    finishes its quarantine; any other is open.
    """
    joined = requests.join(states.select("dt", F.col("status").alias("_state")), "dt", "left")
    state, force = F.coalesce("_state", F.lit("")), F.coalesce("force", F.lit(False))
    decision = F.when(state == "compacting", "refuse").when(state == "compacted", F.when(force, "invalidate").otherwise("refuse")).when(state == "invalidated", "finish-quarantine").otherwise("open")
    return joined.select("dt", "hour", "force", decision.alias("decision"))


def claims(hours: DataFrame, now: int, lease_seconds: int = 60) -> DataFrame:
    """Hours with `claimed`, and the row a claim leaves: in flight, one more attempt, a new lease; done only when forced."""
    status = F.coalesce("status", F.lit("pending"))
    free = status.isin("pending", "failed") | ((status == "in-flight") & (F.coalesce("lease_expires", F.lit(0)) < now)) | ((status == "done") & F.coalesce("force", F.lit(False)))
    mine = hours.withColumn("claimed", free)
    return mine.withColumns({"status": F.when(F.col("claimed"), "in-flight").otherwise(F.col("status")), "attempt": F.coalesce("attempt", F.lit(0)) + F.col("claimed").cast("int"), "lease_expires": F.when(F.col("claimed"), F.lit(now + lease_seconds)).otherwise(F.col("lease_expires"))})


def failed(hours: DataFrame, reason: str) -> DataFrame:
    return hours.withColumn("status", F.lit("failed")).withColumn("error", F.lit(reason[:REASON_CHARS]))


def invalidate(states: DataFrame) -> DataFrame:
    """Compacted days as invalidated, their totals kept as previous ones, -1 where none was recorded."""
    totals = [c for c in ("rows", "views", "rows_unfloored", "views_unfloored") if c in states.columns]
    changed = states.filter(F.col("status") == "compacted").withColumns({f"{c}_previous": F.coalesce(c, F.lit(-1)) for c in totals})
    return changed.withColumn("status", F.lit("invalidated"))


def completeness(objects: DataFrame, days: DataFrame) -> DataFrame:
    """(dt, missing, unexpected, has_day_object) of the partial objects of days; objects: (dt, hour), hour null for a day's own object."""
    expected = expected_hours(days).withColumn("_expected", F.lit(True))
    found = objects.select("dt", "hour").filter("hour IS NOT NULL").distinct().withColumn("_found", F.lit(True))
    joined = expected.join(found, ["dt", "hour"], "full_outer")
    own = objects.filter("hour IS NULL").select("dt").distinct().withColumn("_own", F.lit(True))
    counts = joined.groupBy("dt").agg(F.count_if(F.col("_found").isNull()).alias("missing"), F.count_if(F.col("_expected").isNull()).alias("unexpected"))
    return counts.join(own, "dt", "left").select("dt", "missing", "unexpected", F.coalesce("_own", F.lit(False)).alias("has_day_object"))


def published_problems(page_hour: DataFrame, manifest_hours: DataFrame) -> DataFrame:
    """(hour, stored_rows, recorded_rows) where the hourly tier and the manifest disagree."""
    stored = page_hour.groupBy(hour_label(F.col("hour_start")).alias("hour")).agg(F.count(F.lit(1)).alias("stored_rows"))
    joined = stored.join(manifest_hours.select("hour", F.col("rows").alias("recorded_rows")), "hour", "full_outer")
    return joined.fillna(0, ["stored_rows", "recorded_rows"]).filter("stored_rows <> recorded_rows")


def day_rollup(hours: DataFrame, days: DataFrame) -> DataFrame:
    """(dt, hours_views, day_views) of days whose hours' kept views do not add up to the day's unfloored views.

    hours: (dt, views_kept); days: (dt, views_unfloored).
    """
    summed = hours.groupBy("dt").agg(F.sum("views_kept").alias("hours_views"))
    joined = summed.join(days.select("dt", F.col("views_unfloored").alias("day_views")), "dt", "full_outer")
    return joined.filter(~F.col("hours_views").eqNullSafe(F.col("day_views"))).select("dt", "hours_views", "day_views")
