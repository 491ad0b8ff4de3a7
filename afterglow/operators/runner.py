"""Bringing many days to their end together: a round plans all open days in one query, then acts by a table of steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.operators import manifest

#: Rounds that a day may take, and seconds before its first and later retries.
MAX_PASSES = 8
BACKOFF = (30, 120)

#: What a planned action does to a day: the step of the runner that it calls, or the outcome that it is.
STEPS = {"wait": "await_leases", "ingest": "ingest_hours", "compact": "compact_days", "resume-compaction": "compact_days"}
ENDS = {"blocked": "blocked", "incomplete": "incomplete"}


@dataclass
class DayReport:
    day: object
    outcome: str = "stalled"
    passes: int = 0
    retries: int = 0
    log: list[str] = field(default_factory=list)


@dataclass
class Runner:
    """`states()` and `hours()` give the manifest's rows anew; `ingest(plan)`, `compact(day)` change it."""

    spark: SparkSession
    states: Callable[[], DataFrame]
    hours: Callable[[], DataFrame]
    ingest: Callable[[object], None]
    compact: Callable[[object], bool]
    clock: Callable[[], int]
    sleep: Callable[[float], None]

    def plans(self, days: Iterable) -> DataFrame:
        """The plans of days from the manifest as it is now."""
        return manifest.day_plans(self.spark.createDataFrame([(d,) for d in days], "dt date"), self.hours(), self.states(), self.clock())

    def run_days(self, days: Iterable) -> dict[object, DayReport]:
        """Act on days, round by round, until each is compacted or cannot go on."""
        reports = {day: DayReport(day) for day in days}
        going = dict(reports)
        for _ in range(MAX_PASSES):
            if not going:
                break
            by_step: dict[str, list] = {}
            for plan in self.plans(going).orderBy("dt").collect():  # one row an open day
                report = going[plan.dt]
                report.passes += 1
                report.log.append(plan.action)
                if plan.action in STEPS:
                    by_step.setdefault(STEPS[plan.action], []).append(plan)
                else:
                    done = "skipped" if report.passes == 1 else "compacted"
                    report.outcome = ENDS.get(plan.action, done)
            for step, plans in by_step.items():
                getattr(self, step)(plans, reports)
            going = {d: r for d, r in going.items() if r.outcome == "stalled"}
        return reports

    def run_day(self, day) -> DayReport:
        """`run_days` for one day."""
        return self.run_days([day])[day]

    def await_leases(self, plans: list, reports: dict) -> None:
        """Days that only wait for others' leases sleep until the last of these has run out; the plan after that takes the hours over."""
        self.sleep(max(1, max(p.lease_until for p in plans) + 1 - self.clock()))

    def ingest_hours(self, plans: list, reports: dict) -> None:
        """Open hours are read; one back-off, the longest that any day has to keep, goes before those that failed before."""
        again = [reports[p.dt] for p in plans if p.retrying]
        if again:
            self.sleep(max(BACKOFF[min(r.retries, len(BACKOFF) - 1)] for r in again))
            for report in again:
                report.retries += 1
        for plan in plans:
            self.ingest(plan)

    def compact_days(self, plans: list, reports: dict) -> None:
        for plan in plans:
            if not self.compact(plan.dt):
                reports[plan.dt].outcome = "compaction-failed"

    def final_pass(self, days: Iterable) -> dict:
        """Compact every day that can be; for each other day why it is not, and which of its hours stand in the way."""
        days = list(days)
        ready = {a for a, step in STEPS.items() if step == "compact_days"}
        for plan in self.plans(days).collect():  # one row a day
            if plan.action in ready:
                self.compact(plan.dt)
        plans = self.plans(days)
        reasons = {r["dt"]: r["reason"] for r in manifest.unfinished(plans).collect()}
        if reasons:
            for row in self.open_hours(reasons).collect():  # at most 24 an unfinished day
                reasons[row["dt"]] += f"; {row['hour']}: {row['why']}"
        return reasons

    def open_hours(self, days: Iterable) -> DataFrame:
        """(dt, hour, why) of the hours of days that are not done: never begun, or their state, attempt and error."""
        hours = self.hours()
        error = F.col("error") if "error" in hours.columns else F.lit(None).cast("string")
        known = hours.select("hour", "status", F.concat_ws(" ", F.col("status"), F.lit("at attempt"), F.col("attempt"), error).alias("why"))
        expected = manifest.expected_hours(self.spark.createDataFrame([(d,) for d in days], "dt date"))
        return expected.join(known, "hour", "left").filter(~F.col("status").eqNullSafe("done")).select("dt", "hour", F.coalesce("why", F.lit("never begun")).alias("why")).orderBy("dt", "hour")
