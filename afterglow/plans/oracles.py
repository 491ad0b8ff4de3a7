"""DuckDB SQL for the registered queries, written independently of the DataFrame plans."""

from __future__ import annotations

from afterglow.config import CANDIDATE_FLOORS, EXCLUDED_NAMESPACES, MONTHS, SpikeConfig
from afterglow.plans.inputs import EVENTS, INCOMPLETE, SUPPLIERS

EXCLUDED = " OR ".join(["page_title IN ('Main_Page', '-')", *(f"starts_with(page_title, '{n}:')" for n in EXCLUDED_NAMESPACES)])
CALENDAR = f"(starts_with(page_title, 'Deaths_in_') OR regexp_matches(page_title, '({'|'.join(MONTHS)})_[0-9][0-9][0-9][0-9]'))"
TITLE = "CASE WHEN user_id % 25 = 0 THEN 'Special:User_' WHEN user_id % 10 = 1 THEN 'Deaths_in_' WHEN user_id % 10 = 2 THEN 'List_January_2024_' ELSE 'User ' END || user_id"


def raw(source: str) -> list[str]:
    if source == "suppliers":
        return ["raw_daily AS (SELECT 'Supplier_' || l_suppkey AS page_title, l_shipdate::DATE AS dt, sum(l_quantity)::BIGINT AS views FROM lineitem GROUP BY ALL)"]
    return [
        f"raw_hourly AS (SELECT {TITLE} AS page_title, date_trunc('hour', ts)::TIMESTAMP AS hour_start, count(*) AS views FROM events GROUP BY ALL)",
        "raw_daily AS (SELECT page_title, hour_start::DATE AS dt, sum(views)::BIGINT AS views FROM raw_hourly GROUP BY ALL)",
    ]


def chain(source: str, c: SpikeConfig) -> list[str]:
    """CTEs from the raw input to spikes, and for events to the fact."""
    start, end = f"DATE '{c.window_start}'", f"DATE '{c.window_end}'"
    width = c.baseline_offset + c.baseline_days - 1
    ctes = [
        *raw(source),
        f"daily AS (SELECT page_title, dt, views AS daily_views FROM raw_daily WHERE dt BETWEEN {start} AND {end} AND NOT ({EXCLUDED}))",
        f"candidates AS (SELECT page_title, max(daily_views) AS max_daily_views, count(*) AS days_over_1000, min(dt) AS first_day_over_1000 FROM daily WHERE daily_views >= {c.candidate_views} GROUP BY 1)",
        f"calendar AS (SELECT d::DATE AS dt, 24 AS hours_done FROM generate_series({start}::TIMESTAMP, {end}::TIMESTAMP, INTERVAL 1 DAY) g(d) WHERE d::DATE <> DATE '{INCOMPLETE[source]}')",
        f"spine AS (SELECT page_title, d::DATE AS dt FROM candidates, generate_series({start}::TIMESTAMP, {end}::TIMESTAMP, INTERVAL 1 DAY) g(d))",
        "filled AS (SELECT s.page_title, s.dt, CASE WHEN k.dt IS NOT NULL THEN coalesce(d.daily_views, 0) END AS daily_views, d.daily_views IS NULL AS zero_filled, k.dt IS NOT NULL AS source_complete FROM spine s LEFT JOIN daily d USING (page_title, dt) LEFT JOIN calendar k ON k.dt = s.dt)",
        f"windowed AS (SELECT page_title, dt, daily_views, count(daily_views) OVER w AS baseline_days, quantile_cont(daily_views, 0.5) OVER w AS baseline FROM filled WINDOW w AS (PARTITION BY page_title ORDER BY dt ROWS BETWEEN {width} PRECEDING AND {c.baseline_offset} PRECEDING))",
        f"based AS (SELECT page_title, dt, daily_views, baseline_days, baseline::DOUBLE AS baseline FROM windowed WHERE daily_views >= {c.candidate_views} AND dt >= DATE '{c.first_evaluable}')",
        f"qualifying AS (SELECT page_title, dt, daily_views, baseline FROM based WHERE daily_views >= greatest({c.ratio} * baseline, baseline + {c.margin}, {c.floor_views}))",
        f"starts AS (SELECT page_title, min(dt) AS spike_start FROM qualifying GROUP BY 1 UNION ALL SELECT s.page_title, (SELECT min(q.dt) FROM qualifying q WHERE q.page_title = s.page_title AND q.dt >= s.spike_start + {c.merge_days}) FROM starts s WHERE EXISTS (SELECT 1 FROM qualifying q WHERE q.page_title = s.page_title AND q.dt >= s.spike_start + {c.merge_days}))",
        f"spikes AS (SELECT s.page_title || '|' || s.spike_start AS spike_id, s.page_title, s.spike_start, f.daily_views AS start_daily_views, f.baseline, f.baseline / 24 AS baseline_hourly, count(*) AS qualifying_days, max(q.dt) AS last_qualifying_day FROM starts s JOIN qualifying f ON f.page_title = s.page_title AND f.dt = s.spike_start JOIN qualifying q ON q.page_title = s.page_title AND q.dt >= s.spike_start AND q.dt < s.spike_start + {c.merge_days} GROUP BY ALL)",
    ]
    if source != "events":
        return ctes
    data_end = f"TIMESTAMP '{c.data_end_hour}'"
    early = c.early_blocks * c.block_hours
    return [
        *ctes,
        f"hourly AS (SELECT page_title, hour_start, hour_start::DATE AS dt, views FROM raw_hourly WHERE hour_start::DATE BETWEEN {start} AND {end} AND NOT ({EXCLUDED}))",
        f"windows AS (SELECT spike_id, page_title, spike_start::TIMESTAMP - INTERVAL {c.spine_before} HOUR AS w_start, least(spike_start::TIMESTAMP + INTERVAL {c.spine_after} HOUR, {data_end}) AS w_end FROM spikes)",
        "in_windows AS (SELECT w.spike_id, h.hour_start, h.views FROM hourly h JOIN windows w ON w.page_title = h.page_title AND h.hour_start >= w.w_start AND h.hour_start <= w.w_end)",
        "hours AS (SELECT w.spike_id, w.page_title, h AS hour_start, coalesce(o.views, 0)::BIGINT AS views, o.views IS NULL AS zero_filled FROM (SELECT *, unnest(generate_series(w_start, w_end, INTERVAL 1 HOUR)) AS h FROM windows) w LEFT JOIN in_windows o ON o.spike_id = w.spike_id AND o.hour_start = w.h)",
        f"net AS (SELECT h.spike_id, h.hour_start, h.views, s.baseline, (48 * h.views - 2 * s.baseline)::BIGINT AS n48, greatest(48 * h.views - 2 * s.baseline, 0)::BIGINT AS x48, h.hour_start >= s.spike_start AND h.hour_start < s.spike_start + INTERVAL {c.peak_window} HOUR AS near FROM hours h JOIN spikes s USING (spike_id))",
        "tops AS (SELECT spike_id, arg_max(hour_start, (views, -epoch(hour_start))) AS peak_hour, max(views) AS peak_views, arg_max(n48, (views, -epoch(hour_start))) AS p48 FROM net WHERE near GROUP BY 1)",
        f"onset AS (SELECT n.spike_id, min(n.hour_start) AS onset_hour FROM net n JOIN tops t USING (spike_id) WHERE n.hour_start BETWEEN t.peak_hour - INTERVAL {c.onset_lookback} HOUR AND t.peak_hour AND 10 * n.x48 >= t.p48 GROUP BY 1)",
        "timed AS (SELECT n.*, t.peak_hour, t.peak_views, t.p48, o.onset_hour, ((epoch(n.hour_start) - epoch(t.peak_hour)) / 3600)::BIGINT AS rp, ((epoch(n.hour_start) - epoch(o.onset_hour)) / 3600)::BIGINT AS idx, 2 * n.x48 <= t.p48 AS low FROM net n JOIN tops t USING (spike_id) LEFT JOIN onset o USING (spike_id))",
        f"running AS (SELECT spike_id, hour_start, sum(x48) OVER (PARTITION BY spike_id ORDER BY hour_start) AS cum48, idx, sum(x48) OVER (PARTITION BY spike_id) AS total48 FROM timed WHERE idx >= 0 AND idx < {c.horizon})",
        f"half AS (SELECT spike_id, min(idx) + 1 AS half_life, max(total48)::BIGINT AS total48 FROM running WHERE 2 * cum48 >= total48 GROUP BY 1)",
        f"blocks AS (SELECT spike_id, idx // {c.block_hours} AS block, sum(x48)::BIGINT AS b48 FROM timed WHERE idx >= 0 AND idx < {c.horizon} GROUP BY ALL)",
        f"best AS (SELECT spike_id, max(b48) FILTER (WHERE block < {c.early_blocks}) AS early48, max(b48) FILTER (WHERE block >= {c.early_blocks}) AS later48 FROM blocks GROUP BY 1)",
        "falls AS (SELECT spike_id, rp, low AND lead(low, 1) OVER w AND lead(low, 2) OVER w AS stays FROM timed WINDOW w AS (PARTITION BY spike_id ORDER BY hour_start))",
        f"fallen AS (SELECT spike_id, min(rp) AS peak_hour_half_life_hours FROM falls WHERE stays AND rp BETWEEN 1 AND {c.horizon} GROUP BY 1)",
        f"sides AS (SELECT spike_id, coalesce(max(views) FILTER (WHERE abs(rp) BETWEEN 1 AND {c.neighbour_hours}), 0)::BIGINT AS max_neighbour_views, coalesce(max(views) FILTER (WHERE rp BETWEEN -{c.silent_hours} AND -1), 0) AS before_views, coalesce(max(views) FILTER (WHERE rp = 2), 0) AS after_views, coalesce(sum(x48) FILTER (WHERE rp IN (0, 1)), 0) AS first48, coalesce(sum(x48) FILTER (WHERE idx BETWEEN 0 AND {c.block_hours - 1}), 0) AS day48, coalesce(sum(x48) FILTER (WHERE idx BETWEEN {c.tail_from} AND {c.horizon - 1}), 0) AS tail48 FROM timed GROUP BY 1)",
        f"joined AS (SELECT s.*, t.peak_hour, t.peak_views, t.p48, o.onset_hour, h.half_life, coalesce(h.total48, 0) AS total48, b.early48, b.later48, f.peak_hour_half_life_hours, x.max_neighbour_views, x.tail48, d.daily_views AS peak_day_views, d.daily_views - s.baseline AS peak_day_excess, o.onset_hour + INTERVAL {c.horizon - 1} HOUR > {data_end} AS window_end, x.before_views < {c.silent_views} AND 2 * x.first48 >= x.day48 AND 10 * x.after_views <= t.peak_views AS short_burst FROM spikes s JOIN tops t USING (spike_id) LEFT JOIN onset o USING (spike_id) LEFT JOIN half h USING (spike_id) LEFT JOIN best b USING (spike_id) LEFT JOIN fallen f USING (spike_id) JOIN sides x USING (spike_id) LEFT JOIN filled d ON d.page_title = s.page_title AND d.dt = t.peak_hour::DATE)",
        f"flags AS (SELECT *, short_burst OR peak_views >= {c.burst_ratio} * max_neighbour_views AS burst, coalesce(later48 > early48, FALSE) AS rekindled, {CALENDAR} AS calendar_page FROM joined)",
        f"facts AS (SELECT spike_id, page_title, spike_start, start_daily_views, baseline, baseline_hourly, qualifying_days, peak_hour, peak_views, p48 / 48 AS peak_excess, onset_hour, window_end, CASE WHEN NOT window_end THEN half_life END AS attention_half_life_hours, CASE WHEN NOT window_end THEN tail48 / nullif(total48, 0) END AS long_tail_share, total48 / 48 AS total_excess_720h, peak_hour_half_life_hours, peak_day_views, peak_day_excess, max_neighbour_views, burst, short_burst, rekindled, early48 / 48 AS peak_block_excess, later48 / 48 AS max_later_block_excess, calendar_page, coalesce(peak_day_excess >= {c.leaderboard_min_peak_day_excess} AND NOT burst AND NOT rekindled AND NOT calendar_page, FALSE) AS leaderboard_eligible FROM flags)",
    ]


def over(source: str, select: str, *more: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([*chain(source, {"events": EVENTS, "suppliers": SUPPLIERS}[source]), *more]) + "\n" + select


def events(select: str, *more: str) -> str:
    return over("events", select, *more)


def suppliers(select: str, *more: str) -> str:
    return over("suppliers", select, *more)


ITEMS = "items AS (SELECT f.*, list(h.views ORDER BY h.hour_start) AS curve FROM facts f JOIN hours h ON h.spike_id = f.spike_id AND h.hour_start >= f.onset_hour AND h.hour_start < f.onset_hour + INTERVAL {h} HOUR WHERE f.leaderboard_eligible GROUP BY ALL)".replace("{h}", str(EVENTS.horizon))
BOARD = "SELECT spike_id, page_title, spike_start, attention_half_life_hours, round(long_tail_share, 3) AS long_tail_share, peak_day_views FROM facts WHERE leaderboard_eligible AND attention_half_life_hours IS NOT NULL ORDER BY attention_half_life_hours {order}, peak_day_excess DESC, spike_id LIMIT {n}"
BIG = f"coalesce(peak_day_excess >= {EVENTS.leaderboard_min_peak_day_excess} AND NOT burst AND NOT calendar_page, FALSE)"
EDGES = [1, 2, 3, 5, 10, 100]
STRATUM = "CASE " + " ".join(f"WHEN views >= {a} AND views < {b} THEN {i}" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:], strict=False))) + " END"
MANIFEST_HOURS = "SELECT strftime(o_orderdate::DATE + INTERVAL 1 HOUR * ((o_orderkey % 24) + 1), '%Y-%m-%dT%H') AS hour, o_orderdate::DATE AS dt, o_orderkey % 24 AS h, min(o_orderkey) AS k FROM orders GROUP BY ALL"
HOUR_STATUS = "CASE k % 5 WHEN 0 THEN 'done' WHEN 1 THEN 'done' WHEN 2 THEN 'failed' WHEN 3 THEN 'in-flight' ELSE 'done' END"
DAY_STATUS = "CASE day(dt) % 7 WHEN 0 THEN 'compacted' WHEN 1 THEN 'compacting' WHEN 2 THEN 'invalidated' WHEN 3 THEN 'failed' END"

_c = EVENTS
_last = SUPPLIERS.baseline_offset + SUPPLIERS.baseline_days - 1
_SENS = [f for f in CANDIDATE_FLOORS if f]
_sens_windows = ", ".join(f"quantile_cont(CASE WHEN v >= {f} THEN v ELSE 0 END, 0.5) OVER w AS base_{f}, count(*) FILTER (WHERE v < {f}) OVER w AS lost_{f}" for f in CANDIDATE_FLOORS)
_ok = lambda base: f"v >= greatest({SUPPLIERS.ratio} * {base}, {base} + {SUPPLIERS.margin}, {SUPPLIERS.floor_views})"
_sens_rows = " UNION ALL ".join(
    f"SELECT {f}::INTEGER AS floor, count(s.dt) AS spikes, coalesce(sum(s.lost_{f}), 0)::BIGINT AS days_lost, count(*) FILTER (WHERE s.base > 0 AND abs(s.base_{f} - s.base) * 10 > s.base) AS baselines_moved, count(*) FILTER (WHERE s.dt IS NOT NULL AND NOT ({_ok(f's.base_{f}').replace('v >=', 's.v >=', 1)})) AS spikes_lost, count(*) FILTER (WHERE s.dt IS NULL AND p.any_{f}) AS false_spikes FROM pages p LEFT JOIN first_spike s USING (page_title)"
    for f in CANDIDATE_FLOORS
)

SQL: dict[str, str] = {
    "stg_daily_filter_exclusions": events("SELECT * FROM daily"),
    "hour_floor": events("SELECT page_title, hour_start, views FROM hourly WHERE views >= 2"),
    "daily_floor": events(f"SELECT page_title, dt, views FROM raw_daily WHERE views >= {_c.daily_floor}"),
    "floor_report": events("SELECT count(*) AS rows, count(*) FILTER (WHERE views >= 2) AS rows_kept, sum(views)::BIGINT AS views, sum(views) FILTER (WHERE views >= 2)::BIGINT AS views_kept FROM raw_daily"),
    "two_tier_fanout": events("SELECT 'hour' AS tier, page_title, hour_start AS at, views FROM raw_hourly WHERE views >= 2 UNION ALL SELECT 'day', page_title, dt::TIMESTAMP, sum(views)::BIGINT FROM raw_daily GROUP BY ALL"),
    "domain_union_sum": "SELECT user_id, count(*) AS views FROM events WHERE event_type IN (SELECT DISTINCT event_type FROM events ORDER BY 1 LIMIT 2) GROUP BY 1",
    "candidate_pages": suppliers("SELECT * FROM candidates"),
    "date_spine": events("SELECT * FROM spine"),
    "page_daily_zero_filled": events("SELECT * FROM filled"),
    "semi_join_candidates": suppliers("SELECT page_title, dt, daily_views FROM daily WHERE page_title IN (SELECT page_title FROM candidates)"),
    "anti_join_missing_days": events("SELECT page_title, dt FROM spine EXCEPT SELECT page_title, dt FROM daily"),
    "trailing_median_baseline": suppliers("SELECT * FROM based"),
    "spike_days": suppliers("SELECT * FROM qualifying"),
    "spikes_merged": suppliers("SELECT * FROM spikes"),
    "spike_first_day": suppliers("SELECT DISTINCT ON (page_title) page_title, dt, daily_views, baseline FROM qualifying ORDER BY page_title, dt"),
    "spike_windows_range_join": events("SELECT * FROM in_windows"),
    "spike_hours_gapfill": events("SELECT * FROM hours"),
    "peak_hour": events("SELECT spike_id, peak_hour, peak_views FROM tops"),
    "onset": events("SELECT * FROM onset"),
    "running_excess": events("SELECT spike_id, hour_start, (cum48 / 48)::DOUBLE AS cum, (total48 / 48)::DOUBLE AS total FROM running"),
    "block_excess": events("SELECT spike_id, block, b48 / 48 AS block_excess FROM blocks"),
    "debounce_lead": events("SELECT spike_id, rp FROM falls WHERE stays"),
    "half_life_fact": events("SELECT * FROM facts"),
    "burst_flags": events("SELECT spike_id, burst, short_burst, max_neighbour_views FROM facts"),
    "rekindled_flags": events("SELECT spike_id, rekindled, peak_block_excess, max_later_block_excess FROM facts"),
    "calendar_flag": events("SELECT calendar_page, count(*) AS n FROM facts GROUP BY 1"),
    "censoring": events("SELECT spike_id, window_end, attention_half_life_hours, long_tail_share, total_excess_720h FROM facts"),
    "leaderboard_fastest": events(BOARD.format(order="ASC", n=_c.leaderboard_size)),
    "leaderboard_slowest": events(BOARD.format(order="DESC", n=_c.leaderboard_size)),
    "quartiles_nearest_rank": events("SELECT count(peak_views) AS n, quantile_disc(peak_views, 0.25)::DOUBLE AS q1, quantile_disc(peak_views, 0.5)::DOUBLE AS median, quantile_disc(peak_views, 0.75)::DOUBLE AS q3 FROM facts WHERE NOT calendar_page"),
    "stats_headline": events(f"SELECT count(*) AS spikes_detected, count(DISTINCT page_title) AS pages_with_spikes, count_if(leaderboard_eligible)::BIGINT AS qualifying_spikes, count_if(leaderboard_eligible AND window_end)::BIGINT AS qualifying_censored, count_if(burst)::BIGINT AS burst, count_if(rekindled)::BIGINT AS rekindled, count_if(calendar_page)::BIGINT AS calendar_page, count_if(window_end)::BIGINT AS window_end, count_if({BIG})::BIGINT AS big_spikes, count_if({BIG} AND rekindled)::BIGINT AS rekindled_among_big, count_if(window_end) / count(*) AS window_end_share, min(spike_start) AS first_spike, max(spike_start) AS last_spike FROM facts"),
    "curve_array_string": events("SELECT spike_id, array_to_string(curve, ',') AS curve FROM items", ITEMS),
    "prefix_search": events("SELECT spike_id, page_title, spike_start, attention_half_life_hours, peak_day_views FROM items WHERE starts_with(lower(replace(page_title, ' ', '_')), 'user_1') ORDER BY lower(replace(page_title, ' ', '_')) || '#' || spike_start, spike_id LIMIT 20", ITEMS),
    "spike_lookup_excess": events("SELECT spike_id, curve AS views, list_transform(curve, lambda v: greatest(round_even(v - baseline_hourly, 0), 0)::BIGINT) AS excess FROM items", ITEMS),
    "reconcile_full_outer": "WITH a AS (SELECT o_orderdate::DATE AS dt, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT o_orderdate::DATE + CASE WHEN o_orderkey % 50 = 0 THEN 5000 WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS dt, count(*) AS n FROM orders GROUP BY 1) SELECT dt, a.n AS old_n, b.n AS new_n, CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'unexpected' ELSE 'different' END AS status FROM a FULL JOIN b USING (dt) WHERE a.n IS DISTINCT FROM b.n",
    "multiset_diff": "WITH a AS (SELECT o_custkey AS k FROM orders), b AS (SELECT o_custkey + CASE WHEN o_orderkey % 10 = 3 THEN 1 ELSE 0 END AS k FROM orders) (SELECT k, 'left' AS side FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b)) UNION ALL (SELECT k, 'right' FROM (SELECT k FROM b EXCEPT ALL SELECT k FROM a))",
    "grain_violations": "SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "range_violations": "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0.09",
    "spine_completeness": events("SELECT w.spike_id, (epoch(w.w_end) - epoch(w.w_start))::BIGINT // 3600 + 1 AS expected, count(h.hour_start) AS actual FROM windows w LEFT JOIN (SELECT * FROM hours WHERE hour(hour_start) <> 13 OR day(hour_start) % 3 <> 0) h USING (spike_id) GROUP BY ALL HAVING count(h.hour_start) <> (epoch(w.w_end) - epoch(w.w_start))::BIGINT // 3600 + 1"),
    "excluded_titles_left": events(f"SELECT page_title FROM raw_daily WHERE {EXCLUDED}"),
    "check_report": events("SELECT * FROM (VALUES ('daily_unique', 0::BIGINT, TRUE), ('spikes_unique', 0, TRUE), ('views_not_negative', 0, TRUE)) v(name, violations, ok) UNION ALL SELECT 'titles_excluded', count(*), count(*) = 0 FROM raw_daily WHERE " + EXCLUDED),
    "conditional_counts": "SELECT l_returnflag, count(*) FILTER (WHERE l_discount > 0.05) AS discounted, count(*) FILTER (WHERE l_quantity >= 25) AS large, count(*) AS n FROM lineitem GROUP BY 1",
    "count_distinct_pages": "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
    "floor_sweep": events(" UNION ALL ".join(f"SELECT {f}::INTEGER AS floor, count(*) FILTER (WHERE views >= {f}) AS rows_kept, coalesce(sum(views) FILTER (WHERE views >= {f}), 0)::BIGINT AS views_kept FROM raw_daily" for f in CANDIDATE_FLOORS)),
    "floor_sensitivity": suppliers(
        _sens_rows,
        f"sens AS (SELECT *, count(*) OVER w AS n, quantile_cont(v, 0.5) OVER w AS base, {_sens_windows} FROM (SELECT page_title, dt, coalesce(daily_views, 0) AS v FROM filled) WINDOW w AS (PARTITION BY page_title ORDER BY dt ROWS BETWEEN {_last} PRECEDING AND {SUPPLIERS.baseline_offset} PRECEDING))",
        f"sens_full AS (SELECT * FROM sens WHERE n = {SUPPLIERS.baseline_days})",
        f"first_spike AS (SELECT DISTINCT ON (page_title) * FROM sens_full WHERE {_ok('base')} ORDER BY page_title, dt)",
        "pages AS (SELECT page_title, " + ", ".join(f"bool_or({_ok(f'base_{f}')}) AS any_{f}" for f in CANDIDATE_FLOORS) + " FROM sens_full GROUP BY 1)",
    ),
    "stratified_buckets": events(f"SELECT stratum, count(*) AS n, sum(views)::BIGINT AS total FROM (SELECT *, ({STRATUM})::INTEGER AS stratum FROM raw_daily) WHERE stratum IS NOT NULL GROUP BY 1"),
    "top_k_frequency": "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 10",
    "arity_distribution": "SELECT len(string_split(url, '/'))::BIGINT AS fields, count(*) AS n FROM pages GROUP BY 1",
    "day_plan_states": f"""WITH h AS ({MANIFEST_HOURS}), m AS (SELECT hour, {HOUR_STATUS} AS status, (k % 4)::INTEGER AS attempt, k % 200 AS lease FROM h), d AS (SELECT DISTINCT dt FROM h),
        e AS (SELECT dt, strftime(dt + INTERVAL 1 HOUR * (i + 1), '%Y-%m-%dT%H') AS hour FROM d, range(24) r(i)),
        j AS (SELECT e.dt, m.status = 'done' AS done, m.status = 'in-flight' AND m.lease >= 100 AS held, m.status = 'failed' AND m.attempt >= 3 AS spent, m.status = 'failed' AS failed, m.lease FROM e LEFT JOIN m USING (hour)),
        c AS (SELECT dt, count(*) FILTER (WHERE NOT coalesce(done OR held OR spent, FALSE)) AS todo, count(*) FILTER (WHERE done) AS done, count(*) FILTER (WHERE held) AS held, count(*) FILTER (WHERE spent) AS exhausted, count(*) FILTER (WHERE failed AND NOT spent) AS retrying, coalesce(max(lease) FILTER (WHERE held), 0)::BIGINT AS lease_until FROM j GROUP BY 1)
        SELECT dt, CASE WHEN s = 'compacted' THEN 'skip' WHEN s = 'compacting' THEN 'resume-compaction' WHEN s IN ('invalidated', 'failed') THEN 'blocked' WHEN todo > 0 THEN 'ingest' WHEN held > 0 THEN 'wait' WHEN exhausted > 0 THEN 'incomplete' ELSE 'compact' END AS action, todo, done, held, exhausted, retrying, lease_until FROM (SELECT *, {DAY_STATUS} AS s FROM c)""",
    "guard_decisions": f"WITH h AS ({MANIFEST_HOURS}) SELECT dt, hour, k % 2 = 0 AS force, CASE {DAY_STATUS} WHEN 'compacting' THEN 'refuse' WHEN 'compacted' THEN CASE WHEN k % 2 = 0 THEN 'invalidate' ELSE 'refuse' END WHEN 'invalidated' THEN 'finish-quarantine' ELSE 'open' END AS decision FROM h",
    "partition_completeness": f"WITH h AS ({MANIFEST_HOURS}) SELECT dt, 24 - count(DISTINCT hour) AS missing, 0::BIGINT AS unexpected, FALSE AS has_day_object FROM h GROUP BY 1",
    "union_all_excluded": events(f"SELECT page_title, count(*) AS n FROM (SELECT page_title FROM raw_daily UNION ALL SELECT page_title FROM raw_hourly) WHERE {EXCLUDED} GROUP BY 1"),
    "incremental_equals_full": events("SELECT page_title, dt, sum(views)::BIGINT AS views, count(*)::INTEGER AS hours_present FROM (SELECT page_title, hour_start::DATE AS dt, views FROM raw_hourly) GROUP BY ALL"),
    "day_share_cumulative": events("SELECT spike_id, block AS day, round(sum(b48) OVER (PARTITION BY spike_id ORDER BY block) / nullif(sum(b48) OVER (PARTITION BY spike_id), 0), 6) AS share FROM blocks"),
    "layout_descents": "SELECT l_suppkey, count(*) AS rows, count(*) FILTER (WHERE before > l_quantity) AS descents FROM (SELECT *, lag(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 10 + l_linenumber, l_quantity) AS before FROM lineitem) GROUP BY 1",
    "missing_months": "SELECT month_start, last_day(month_start) AS month_end FROM (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month_start FROM orders) WHERE month_start NOT IN (SELECT date_trunc('month', o_orderdate)::DATE FROM orders WHERE month(o_orderdate) % 4 <> 0)",
    "published_hours": events("SELECT hour, stored_rows, stored_rows + 1 AS recorded_rows FROM (SELECT strftime(hour_start + INTERVAL 1 HOUR, '%Y-%m-%dT%H') AS hour, count(*) AS stored_rows FROM raw_hourly GROUP BY 1) WHERE right(hour, 1) = '7'"),
    "upper_median_and_median": "SELECT l_returnflag, median(l_quantity)::DOUBLE AS median, list_sort(list(l_quantity))[count(*) // 2 + 1]::DOUBLE AS upper_median FROM lineitem GROUP BY 1",
    "search_index_buckets": events("SELECT left(lower(replace(page_title, ' ', '_')), 1) AS bucket, count(*) AS n, min(lower(replace(page_title, ' ', '_')) || '#' || spike_start) AS first_key FROM items GROUP BY 1", ITEMS),
    "stale_keys": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey + CASE WHEN o_custkey % 9 = 4 THEN 1 ELSE 0 END FROM orders)",
    "rest_mismatches": events("SELECT d.page_title, d.dt, d.views + (d.views % 3 = 0)::BIGINT AS expected, CASE WHEN day(d.dt) <> 20 THEN d.views END AS stored FROM raw_daily d WHERE day(d.dt) = 20 OR d.views % 3 = 0"),
    "day_rollup": events("SELECT hour_start::DATE AS dt, sum(views)::BIGINT AS hours_views, sum(views)::BIGINT + 1 AS day_views FROM raw_hourly WHERE day(hour_start) % 3 = 0 GROUP BY 1"),
    "missing_hours": events(f"SELECT h AS hour_start FROM generate_series(TIMESTAMP '{_c.window_start}', TIMESTAMP '{_c.data_end_hour}', INTERVAL 1 HOUR) g(h) WHERE h NOT IN (SELECT hour_start FROM raw_hourly WHERE hour(hour_start) % 6 <> 5)"),
    "hour_convention": events("SELECT s::INTEGER AS shift, count(*) FILTER (WHERE a.views = b.views) AS matches, count(*) AS compared FROM (VALUES (-1), (0), (1)) v(s), raw_hourly b JOIN raw_hourly a ON a.page_title = b.page_title AND a.hour_start = b.hour_start + INTERVAL 1 HOUR * (s + 1) GROUP BY 1"),
    "item_write_units": events("SELECT spike_id, b AS bytes, (b + 1023) // 1024 AS units FROM (SELECT spike_id, (strlen(spike_id) + strlen(page_title) + strlen(array_to_string(curve, ',')))::BIGINT AS b FROM items)", ITEMS),
    "curve_codec_roundtrip": events("SELECT spike_id, array_to_string(curve, ',') AS curve FROM items", ITEMS),
    "parse_hostile_lines": """WITH l AS (SELECT *, event_id % 90 + 1 AS v, event_id % 19 <> 0 AS whole, user_id % 4 <> 2 AS ours, event_id % 17 <> 0 AS number, event_id % 11 = 0 AS talk, event_id % 13 = 0 AS bad FROM events WHERE event_id % 23 <> 0),
        g AS (SELECT *, whole AND ours AND number AS good FROM l), b AS (SELECT user_id % 5 AS t, sum(v) AS v FROM g WHERE good AND NOT talk AND bad GROUP BY 1)
        SELECT count(*) AS lines, count(*) FILTER (WHERE whole AND NOT ours) AS rows_other_project, count(*) FILTER (WHERE NOT whole) AS rows_skipped_invalid, count(*) FILTER (WHERE whole AND ours AND NOT number) AS rows_skipped_bad_int,
        count(*) FILTER (WHERE good AND talk) AS rows_dropped_exclusions, coalesce(sum(v) FILTER (WHERE good AND talk), 0)::BIGINT AS views_dropped_exclusions, coalesce(sum(v) FILTER (WHERE good), 0)::BIGINT AS views_before_exclusions,
        coalesce(sum(v) FILTER (WHERE good AND NOT talk AND user_id % 4 <> 1), 0)::BIGINT AS views_en, coalesce(sum(v) FILTER (WHERE good AND NOT talk AND user_id % 4 = 1), 0)::BIGINT AS views_en_m, count(*) FILTER (WHERE good AND NOT talk) AS rows_parsed,
        (SELECT count(*) FROM b) AS rows_skipped_bad_utf8, (SELECT coalesce(sum(v), 0)::BIGINT FROM b) AS views_skipped_bad_utf8, coalesce(sum(v) FILTER (WHERE good AND NOT talk AND NOT bad), 0)::BIGINT AS views_kept FROM g""",
    "parse_hour_titles": "SELECT date_trunc('hour', ts)::TIMESTAMP AS hour_start, 'Ü_' || user_id AS page_title, sum(event_id % 90 + 1)::BIGINT AS views FROM events WHERE event_id % 3 <> 2 GROUP BY ALL",
    "parse_mentions": """WITH m AS (SELECT event_id % 37 = 0 AS short, event_id % 31 = 0 AS wrong, user_id, event_type, event_id % 500 AS lag FROM events), k AS (SELECT lag FROM m WHERE NOT short AND NOT wrong)
        SELECT count(*) AS rows, count(*) FILTER (WHERE short) AS malformed, count(*) FILTER (WHERE wrong AND NOT short) AS bad_dates, count(DISTINCT CASE WHEN short THEN 'short' ELSE user_id::VARCHAR END) AS events, count(DISTINCT event_type) FILTER (WHERE NOT short) AS sources,
        (SELECT min(lag) FROM k) AS min_lag, (SELECT list_sort(list(lag))[count(*) // 2 + 1] FROM k) AS median_lag, (SELECT max(lag) FROM k) AS max_lag FROM m""",
    "letters_feed": """WITH h AS (SELECT user_id, ts::DATE AS dt, hour(ts) AS h, count(*) AS n FROM events GROUP BY ALL), d AS (SELECT user_id, dt, map_from_entries(list((h, n))) AS m, sum(n)::BIGINT AS s FROM h GROUP BY ALL)
        SELECT 'U_' || user_id || '_' || dt AS title, s + (user_id % 7 = 0)::BIGINT AS daily, list_transform(range(24), lambda i: coalesce(m[i], 0)::BIGINT) AS hours, user_id % 7 <> 0 AS consistent FROM d""",
    "models_in_sql": events("SELECT calendar_page, count(*) AS spikes, sum(n)::BIGINT AS hours, max(peak_views) AS most FROM facts JOIN (SELECT spike_id, count(*) AS n FROM hours GROUP BY 1) USING (spike_id) GROUP BY 1"),
    "publish_states": events(
        "SELECT dt, CASE WHEN day(dt) % 7 = 3 THEN 'refused' WHEN problems > 0 THEN 'replacing' ELSE 'published' END AS state, problems FROM p",
        "by_hour AS (SELECT hour_start, count(*) AS n FROM raw_hourly GROUP BY 1)",
        "p AS (SELECT hour_start::DATE AS dt, (day(dt) % 5 = 0)::BIGINT + 24 - count(*) + count(*) FILTER (WHERE day(hour_start) % 4 = 2 AND hour(hour_start) % 10 = 6) AS problems FROM by_hour GROUP BY 1)",
    ),
    "title_daily_total": events("SELECT dt, views FROM raw_daily WHERE page_title = 'User 3'"),
    "mean_and_most": "SELECT l_suppkey, count(l_quantity) AS n, avg(l_quantity) AS mean, max(l_quantity) AS most FROM lineitem GROUP BY 1",
    "sizes_by_prefix": "SELECT array_to_string(string_split(url, '/')[1:3], '/') AS prefix, count(*) AS objects, sum(strlen(html))::BIGINT AS bytes FROM pages GROUP BY 1",
}
