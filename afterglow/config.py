"""Every constant of the attention-decay models, as one frozen value."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta


@dataclass(frozen=True)
class SpikeConfig:
    """Thresholds and windows; the defaults are the production values for page views."""

    window_start: date = date(2024, 9, 13)
    window_end: date = date(2026, 9, 12)
    data_end_hour: datetime = datetime(2026, 9, 12, 23)
    #: floors of the stored tiers
    hourly_floor: int = 10
    daily_floor: int = 10
    #: baseline: median of `baseline_days` rows that end `baseline_offset` rows before the day
    baseline_days: int = 28
    baseline_offset: int = 2
    evaluation_offset_days: int = 30
    #: a day qualifies by ratio, margin and floor together
    candidate_views: int = 1_000
    ratio: int = 5
    margin: int = 500
    floor_views: int = 1_000
    #: qualifying days nearer than this to a spike's start extend it
    merge_days: int = 30
    #: hours of the spine around 00:00 of the start, and of the search for the peak
    spine_before: int = 48
    spine_after: int = 770
    peak_window: int = 48
    onset_lookback: int = 48
    #: hours measured from the onset, where its tail begins, and its days
    horizon: int = 720
    tail_from: int = 168
    block_hours: int = 24
    early_blocks: int = 3
    #: burst rules
    burst_ratio: int = 10
    neighbour_hours: int = 2
    silent_views: int = 10
    silent_hours: int = 3
    leaderboard_min_peak_day_excess: int = 20_000
    leaderboard_size: int = 20
    search_limit: int = 20

    def with_window(self, start: date, end: date, data_end_hour: datetime | None = None) -> SpikeConfig:
        """The same thresholds over another span of days."""
        return replace(self, window_start=start, window_end=end, data_end_hour=data_end_hour or datetime(end.year, end.month, end.day, 23))

    @property
    def first_evaluable(self) -> date:
        return self.window_start + timedelta(days=self.evaluation_offset_days)


#: Projects of the hourly feed that are counted as one.
PROJECTS = ("en", "en.m")
#: Titles and name spaces that are no articles.
EXCLUDED_TITLES = ("Main_Page", "-")
EXCLUDED_NAMESPACES = ("Special", "Talk", "File", "Category", "Template", "Help", "Portal", "Wikipedia", "User")
#: Titles of list pages that fill up over their month.
CALENDAR_PREFIX = "Deaths_in_"
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
#: The floors that storage is weighed at.
CANDIDATE_FLOORS = (0, 1, 5, 10, 25, 50, 100)
