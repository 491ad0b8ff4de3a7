"""Models on small series with answers worked out by hand."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig
from afterglow.operators import decay, hours, serving, spikes, spine

JANUARY = SpikeConfig().with_window(date(2025, 1, 1), date(2025, 1, 31))


def days(first, last):
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def test_spine_fills_zero_and_keeps_unknown(spark):
    daily = spark.createDataFrame([("P", date(2025, 1, 10), 400), ("P", date(2025, 1, 20), 400), ("P", date(2025, 1, 31), 1500)], "page_title string, dt date, daily_views long")
    complete = spark.createDataFrame([(d, 24) for d in days(date(2025, 1, 1), date(2025, 1, 31)) if d.day != 15], "dt date, hours_done int")
    rows = {r.dt: r for r in spine.zero_filled_daily(daily, spine.candidate_pages(daily, JANUARY), complete, JANUARY).collect()}
    assert len(rows) == 31
    assert rows[date(2025, 1, 15)].daily_views is None and rows[date(2025, 1, 15)].zero_filled and not rows[date(2025, 1, 15)].source_complete
    assert rows[date(2025, 1, 10)].daily_views == 400 and not rows[date(2025, 1, 10)].zero_filled
    assert sum(r.daily_views or 0 for r in rows.values()) == 2300 and sum(r.zero_filled for r in rows.values()) == 28


def test_baseline_counts_quiet_days_and_leaves_out_unknown_ones(spark):
    value = {10: 400, 20: 400, 31: 1500}
    rows = [(p, d, None if p == "Q" and d.day == 15 else value.get(d.day, 0)) for p in "PQ" for d in days(date(2025, 1, 1), date(2025, 1, 31))]
    based = spikes.baselines(spark.createDataFrame(rows, "page_title string, dt date, daily_views long"), JANUARY)
    assert sorted(map(tuple, based.collect())) == [("P", date(2025, 1, 31), 1500, 28, 0.0), ("Q", date(2025, 1, 31), 1500, 27, 0.0)]


def test_qualifying_days_merge_from_the_start(spark):
    rows = [("P", date(2025, 1, 31), 1500, 0.0), ("N", date(2025, 1, 31), 1500, 400.0), ("T", date(2025, 1, 31), 900, 10.0), ("U", date(2025, 1, 31), 9000, None)]
    rows += [("R", d, 5000, 100.0) for d in (date(2025, 2, 1), date(2025, 2, 20), date(2025, 3, 3), date(2025, 3, 10))]
    based = spark.createDataFrame(rows, "page_title string, dt date, daily_views long, baseline double")
    merged = spikes.merge_spikes(spikes.qualifying_days(based, SpikeConfig()), SpikeConfig()).collect()
    assert sorted((r.spike_id, r.qualifying_days, r.last_qualifying_day) for r in merged) == [
        ("P|2025-01-31", 1, date(2025, 1, 31)), ("R|2025-02-01", 2, date(2025, 2, 20)), ("R|2025-03-03", 2, date(2025, 3, 10)),
    ]
    assert next(r for r in merged if r.page_title == "R").baseline_hourly == pytest.approx(100 / 24)


SPIKES = "spike_id string, page_title string, spike_start date, start_daily_views long, baseline double, baseline_hourly double, qualifying_days long, last_qualifying_day date"


def fact(spark, series, peak_day_views, end):
    """Facts of spikes {title: (start, {hour: views})} with a baseline of nothing."""
    rows = [(f"{t}|{d}", t, d, 1, 0.0, 0.0, 1, d) for t, (d, _) in series.items()]
    timeline = [(f"{t}|{d}", t, h, v, v == 0) for t, (d, s) in series.items() for h, v in s.items()]
    daily = [(t, d, peak_day_views[t]) for t, (d, _) in series.items()]
    config = SpikeConfig(data_end_hour=end)
    found = decay.half_lives(
        spark.createDataFrame(timeline, "spike_id string, page_title string, hour_start timestamp_ntz, views long, zero_filled boolean"),
        spark.createDataFrame(rows, SPIKES), spark.createDataFrame(daily, "page_title string, dt date, daily_views long"), config,
    )
    return {r.page_title: r for r in found.collect()}


def at(day, hour, *values):
    start = datetime(day.year, day.month, day.day, hour)
    return {start + timedelta(hours=i): v for i, v in enumerate(values)}


def test_attention_half_life(spark):
    a, b, l, c = date(2025, 3, 1), date(2025, 3, 5), date(2025, 3, 10), date(2025, 4, 20)
    series = {
        "A": (a, at(a, 0, 5, 40, 100, 60, 40, 20) | at(date(2025, 3, 9), 9, 60)),
        "B": (b, at(b, 8, 30, 100, 5000, 200, 40)),
        "L": (l, at(l, 22, 1000, 300) | at(date(2025, 3, 11), 0, *[100] * 24)),
        "Deaths_in_April_2025": (c, at(c, 0, 500)),
    }
    got = fact(spark, series, {"A": 30000, "B": 5370, "L": 1300, "Deaths_in_April_2025": 1500}, datetime(2025, 4, 30))
    pick = lambda r: (r.attention_half_life_hours, r.long_tail_share, r.peak_hour_half_life_hours, r.burst, r.calendar_page, r.window_end, r.leaderboard_eligible)
    assert pick(got["A"]) == (3, 0.1875, None, False, False, False, True)
    assert pick(got["B"]) == (1, 0.0, None, True, False, False, False)
    assert pick(got["L"]) == (8, 0.0, 1, False, False, False, False)
    assert pick(got["Deaths_in_April_2025"]) == (None, None, None, True, True, True, False)
    assert got["A"].onset_hour == datetime(2025, 3, 1, 1) and got["A"].total_excess_720h == 320 and len(got["A"]) == 26


def test_short_bursts_and_rekindled_spikes(spark):
    s, n, r, k = date(2025, 3, 1), date(2025, 3, 2), date(2025, 3, 5), date(2025, 3, 10)
    series = {
        "S": (s, at(s, 8, 1000, 500, 50) | at(s, 11, *[20] * 20)),
        "N": (n, at(n, 8, 1000, 600, 400)),
        "R": (r, at(r, 7, 50, 50, 50, 100, 60, 50) | at(date(2025, 3, 24), 10, 500)),
        "K": (k, at(k, 22, 1000, 300) | at(date(2025, 3, 11), 0, *[100] * 24)),
    }
    got = fact(spark, series, {"S": 1950, "N": 50000, "R": 1100, "K": 30000}, datetime(2025, 6, 30))
    pick = lambda x: (x.burst, x.short_burst, x.rekindled, x.leaderboard_eligible)
    assert {t: pick(x) for t, x in got.items()} == {"S": (True, True, False, False), "N": (False, False, False, True), "R": (False, False, True, False), "K": (False, False, False, True)}


def test_hours_spine_is_cut_at_the_end_of_the_data(spark):
    config = SpikeConfig(data_end_hour=datetime(2025, 3, 2, 5))
    one = spark.createDataFrame([("X|2025-03-01", "X", date(2025, 3, 1))], "spike_id string, page_title string, spike_start date")
    hourly = spark.createDataFrame([("X", datetime(2025, 3, 1, 4), 12), ("X", datetime(2025, 2, 20), 99), ("Y", datetime(2025, 3, 1), 5)], "page_title string, hour_start timestamp_ntz, views long")
    got = hours.spike_hours(hourly, one, config)
    rows = got.orderBy("hour_start").collect()
    assert len(rows) == 48 + 24 + 6 and rows[0].hour_start == datetime(2025, 2, 27) and rows[-1].hour_start == datetime(2025, 3, 2, 5)
    assert [(r.hour_start.hour, r.views) for r in rows if not r.zero_filled] == [(4, 12)]
    assert hours.incomplete_spines(got, one, config).count() == 0
    assert hours.incomplete_spines(got.filter(F.col("views") == 0), one, config).count() == 1


def test_full_window_has_819_hours(spark):
    one = spark.createDataFrame([("X|2025-03-01", "X", date(2025, 3, 1))], "spike_id string, page_title string, spike_start date")
    w = hours.spike_windows(one, SpikeConfig()).first()
    assert (w.w_end - w.w_start).total_seconds() / 3600 + 1 == 819


def test_excess_rounds_half_to_even_and_is_never_negative(spark):
    items = spark.createDataFrame([("X", [1000, 600, 300, 10, 3], 10.0), ("Z", [13, 14], 0.5)], "spike_id string, curve array<long>, baseline_hourly double")
    got = {r.spike_id: r.excess for r in serving.spike_detail(items).collect()}
    assert got == {"X": [990, 590, 290, 0, 0], "Z": [12, 14]}


def test_search_by_prefix(spark):
    titles = ["Pope Leo XIV", "Pope_Francis", "Papal/States", "Antipope"]
    items = spark.createDataFrame([(f"{t}|2025-05-08", t, date(2025, 5, 8), 9, 100) for t in titles], "spike_id string, page_title string, spike_start date, attention_half_life_hours long, peak_day_views long")
    index = serving.index_items(items)
    find = lambda q: [r.page_title for r in serving.search(index, q, SpikeConfig()).collect()]
    assert find("pope ") == ["Pope_Francis", "Pope Leo XIV"] or find("pope ") == ["Pope Leo XIV", "Pope_Francis"]
    assert find("Pope Leo") == ["Pope Leo XIV"] and find("papal/") == ["Papal/States"] and find("zzz") == []
    for bad in ("", "   ", "x" * 101):
        with pytest.raises(ValueError):
            serving.search(index, bad, SpikeConfig())
