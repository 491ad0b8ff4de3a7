"""Registered queries of the attention-decay engine and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig
from afterglow.functions import decode_curve, encode_curve, exact_median, is_excluded, upper_median
from afterglow.operators import analysis, decay, hours, manifest, publish, reconcile, serving, spikes, spine, tiers
from afterglow.plans import api, inputs, oracles
from afterglow.plans.inputs import EVENTS, SUPPLIERS, chain
from afterglow.session import ship_package, table
from afterglow.sources import feeds, hour_files

FLAGSHIP = "half_life_fact"
Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTERED[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return dict(REGISTERED)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in oracles.SQL.items() if name in REGISTERED}


# --- staging, tiers, spine


@query
def stg_daily_filter_exclusions(spark, sf_dir):
    return spine.stage_daily(inputs.event_days(spark, sf_dir), EVENTS)


@query
def hour_floor(spark, sf_dir):
    staged = spine.stage_hourly(inputs.event_hours(spark, sf_dir), EVENTS)
    return tiers.page_hours(staged, SpikeConfig(hourly_floor=2)).select("page_title", "hour_start", "views")


@query
def daily_floor(spark, sf_dir):
    return tiers.apply_floor(inputs.event_days(spark, sf_dir), EVENTS.daily_floor)


@query
def floor_report(spark, sf_dir):
    return tiers.floor_report(inputs.event_days(spark, sf_dir), 2)


@query
def two_tier_fanout(spark, sf_dir):
    titles = inputs.event_hours(spark, sf_dir)
    hourly = tiers.page_hours(titles, SpikeConfig(hourly_floor=2)).select(F.lit("hour").alias("tier"), "page_title", F.col("hour_start").alias("at"), "views")
    daily = tiers.compact(tiers.day_partials(titles)).select(F.lit("day").alias("tier"), "page_title", F.col("dt").cast("timestamp_ntz").alias("at"), "views")
    return hourly.unionAll(daily)


@query
def domain_union_sum(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    two = events.select("event_type").distinct().orderBy("event_type").limit(2)
    return events.join(two, "event_type", "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("views"))


@query
def candidate_pages(spark, sf_dir):
    return chain(spark, sf_dir, "suppliers").candidates


@query
def date_spine(spark, sf_dir):
    return spine.date_spine(chain(spark, sf_dir).candidates, EVENTS)


@query
def page_daily_zero_filled(spark, sf_dir):
    return chain(spark, sf_dir).zero_filled


@query
def semi_join_candidates(spark, sf_dir):
    found = chain(spark, sf_dir, "suppliers")
    return found.daily.join(found.candidates.select("page_title"), "page_title", "left_semi")


@query
def anti_join_missing_days(spark, sf_dir):
    found = chain(spark, sf_dir)
    return spine.missing_days(found.daily, found.candidates, EVENTS)


# --- baselines and spikes


@query
def trailing_median_baseline(spark, sf_dir):
    return chain(spark, sf_dir, "suppliers").based


@query
def spike_days(spark, sf_dir):
    return chain(spark, sf_dir, "suppliers").qualifying.select("page_title", "dt", "daily_views", "baseline")


@query
def spikes_merged(spark, sf_dir):
    return chain(spark, sf_dir, "suppliers").spikes


@query
def spike_first_day(spark, sf_dir):
    return spikes.first_qualifying_day(chain(spark, sf_dir, "suppliers").qualifying)


# --- hours and the fact


@query
def spike_windows_range_join(spark, sf_dir):
    found = chain(spark, sf_dir)
    return hours.hours_in_windows(found.hourly, hours.spike_windows(found.spikes, EVENTS))


@query
def spike_hours_gapfill(spark, sf_dir):
    return chain(spark, sf_dir).hours


def _started(spark, sf_dir):
    found = chain(spark, sf_dir)
    return decay.onsets(decay.peaks(found.hours, found.spikes, EVENTS), EVENTS)


@query
def peak_hour(spark, sf_dir):
    found = chain(spark, sf_dir)
    return decay.peaks(found.hours, found.spikes, EVENTS).groupBy("spike_id").agg(F.max("peak_hour").alias("peak_hour"), F.max("peak_views").alias("peak_views"))


@query
def onset(spark, sf_dir):
    return _started(spark, sf_dir).groupBy("spike_id").agg(F.max("onset_hour").alias("onset_hour"))


@query
def running_excess(spark, sf_dir):
    inside = decay.measures(_started(spark, sf_dir), EVENTS).filter(F.col("idx").between(0, EVENTS.horizon - 1))
    return inside.select("spike_id", "hour_start", (F.col("cum48") / 48).alias("cum"), (F.col("total48") / 48).alias("total"))


@query
def block_excess(spark, sf_dir):
    inside = decay.measures(_started(spark, sf_dir), EVENTS).filter(F.col("idx").between(0, EVENTS.horizon - 1))
    return inside.groupBy("spike_id", "block").agg((F.max("block48") / 48).alias("block_excess"))


@query
def debounce_lead(spark, sf_dir):
    return decay.measures(_started(spark, sf_dir), EVENTS).filter("stays_low").select("spike_id", "rp")


@query
def half_life_fact(spark, sf_dir):
    return chain(spark, sf_dir).facts


@query
def burst_flags(spark, sf_dir):
    return chain(spark, sf_dir).facts.select("spike_id", "burst", "short_burst", "max_neighbour_views")


@query
def rekindled_flags(spark, sf_dir):
    return chain(spark, sf_dir).facts.select("spike_id", "rekindled", "peak_block_excess", "max_later_block_excess")


@query
def calendar_flag(spark, sf_dir):
    return chain(spark, sf_dir).facts.groupBy("calendar_page").agg(F.count(F.lit(1)).alias("n"))


@query
def censoring(spark, sf_dir):
    return chain(spark, sf_dir).facts.select("spike_id", "window_end", "attention_half_life_hours", "long_tail_share", "total_excess_720h")


# --- serving


@query
def leaderboard_fastest(spark, sf_dir):
    return serving.leaderboard(chain(spark, sf_dir).facts, EVENTS)


@query
def leaderboard_slowest(spark, sf_dir):
    return serving.leaderboard(chain(spark, sf_dir).facts, EVENTS, slowest=True)


@query
def quartiles_nearest_rank(spark, sf_dir):
    return serving.quartiles(chain(spark, sf_dir).facts, "peak_views", ~F.col("calendar_page"))


@query
def stats_headline(spark, sf_dir):
    return serving.headline(chain(spark, sf_dir).facts, EVENTS)


def _items(spark, sf_dir):
    found = chain(spark, sf_dir)
    return serving.curves(found.facts, found.hours, EVENTS)


@query
def curve_array_string(spark, sf_dir):
    return _items(spark, sf_dir).select("spike_id", serving.curve_text(F.col("curve")).alias("curve"))


@query
def curve_codec_roundtrip(spark, sf_dir):
    ship_package(spark)
    packed = _items(spark, sf_dir).select("spike_id", encode_curve("curve").alias("packed"))
    return packed.select("spike_id", serving.curve_text(decode_curve("packed")).alias("curve"))


@query
def prefix_search(spark, sf_dir):
    return serving.search(serving.index_items(_items(spark, sf_dir)), "User 1", EVENTS)


@query
def search_index_buckets(spark, sf_dir):
    return serving.index_items(_items(spark, sf_dir)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("search_key").alias("first_key"))


@query
def spike_lookup_excess(spark, sf_dir):
    return serving.spike_detail(_items(spark, sf_dir)).select("spike_id", "views", "excess")


@query
def day_share_cumulative(spark, sf_dir):
    found = chain(spark, sf_dir)
    return serving.day_shares(found.hours, found.facts, EVENTS)


# --- reconciliation and checks


@query
def checksum_per_day(spark, sf_dir):
    return reconcile.day_summary(inputs.event_days(spark, sf_dir), "dt", "views")


@query
def reconcile_full_outer(spark, sf_dir):
    """Orders a day, against the same orders of which some have the wrong day."""
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("dt"), F.when(F.col("o_orderkey") % 50 == 0, 5000).when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0).alias("late"))
    count = lambda day: orders.groupBy(day.alias("dt")).agg(F.count(F.lit(1)).alias("n"))
    return reconcile.differences(count(F.col("dt")), count(F.date_add("dt", F.col("late"))), ["dt"])


@query
def multiset_diff(spark, sf_dir):
    """Customers of all orders, against the same of which some are the next customer."""
    orders = table(spark, sf_dir, "orders")
    moved = F.col("o_custkey") + F.when(F.col("o_orderkey") % 10 == 3, 1).otherwise(0)
    return reconcile.multiset_difference(orders.select(F.col("o_custkey").alias("k")), orders.select(moved.alias("k")))


@query
def grain_violations(spark, sf_dir):
    return reconcile.unique(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query
def range_violations(spark, sf_dir):
    return reconcile.in_range(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount"), "l_discount", high=0.09)


@query
def spine_completeness(spark, sf_dir):
    """The check on spines from which every third day's 13:00 was taken out."""
    found = chain(spark, sf_dir)
    holed = found.hours.filter((F.hour("hour_start") != 13) | (F.dayofmonth("hour_start") % 3 != 0))
    return hours.incomplete_spines(holed, found.spikes, EVENTS)


@query
def excluded_titles_left(spark, sf_dir):
    return reconcile.excluded_titles_left(inputs.event_days(spark, sf_dir))


@query
def check_report(spark, sf_dir):
    found = chain(spark, sf_dir)
    return reconcile.report(
        {
            "daily_unique": reconcile.unique(found.daily, "page_title", "dt"), "spikes_unique": reconcile.unique(found.spikes, "spike_id"),
            "views_not_negative": reconcile.non_negative(found.hours, "views"), "titles_excluded": reconcile.excluded_titles_left(inputs.event_days(spark, sf_dir)),
        }
    )


@query
def stale_keys(spark, sf_dir):
    """Customers that no order names, where some orders name the next one instead."""
    named = F.col("o_custkey") + F.when(F.col("o_custkey") % 9 == 4, 1).otherwise(0)
    return reconcile.stale(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").select(named.alias("c_custkey")), "c_custkey")


@query
def rest_mismatches(spark, sf_dir):
    days = inputs.event_days(spark, sf_dir)
    outside = days.withColumn("views", F.col("views") + F.when(F.col("views") % 3 == 0, 1).otherwise(0))
    return analysis.rest_mismatches(days.filter(F.dayofmonth("dt") != 20), outside, ["page_title", "dt"])


# --- aggregates and analyses


@query
def conditional_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.count_if(F.col("l_quantity") >= 25).alias("large"), F.count(F.lit(1)).alias("n"))


@query
def count_distinct_pages(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query
def floor_sweep(spark, sf_dir):
    return analysis.floor_sweep(inputs.event_days(spark, sf_dir))


@query
def floor_sensitivity(spark, sf_dir):
    return analysis.floor_sensitivity(chain(spark, sf_dir, "suppliers").zero_filled, SUPPLIERS)


@query
def stratified_buckets(spark, sf_dir):
    return analysis.stratum_counts(inputs.event_days(spark, sf_dir), "views", oracles.EDGES)


@query
def stratified_sample(spark, sf_dir):
    return analysis.stratified_sample(inputs.event_days(spark, sf_dir), "page_title", "views", oracles.EDGES, 10)


@query
def top_k_frequency(spark, sf_dir):
    return analysis.top_k(table(spark, sf_dir, "lineitem"), "l_suppkey", 10)


@query
def upper_median_and_median(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(exact_median(F.col("l_quantity")).alias("median"), upper_median("l_quantity").alias("upper_median"))


@query
def arity_distribution(spark, sf_dir):
    lines = table(spark, sf_dir, "pages").select(F.replace("url", F.lit("/"), F.lit(" ")).cast("binary").alias("line"))
    return hour_files.profile_lines(lines)


@query
def layout_descents(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return analysis.descents(items, "at", "l_quantity", "l_suppkey")


@query
def title_daily_total(spark, sf_dir):
    return analysis.daily_total(inputs.event_hours(spark, sf_dir), "User 3")


@query
def mean_and_most(spark, sf_dir):
    return analysis.mean_and_most(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity")


@query
def sizes_by_prefix(spark, sf_dir):
    """Bytes of pages by site, the address as the key."""
    return analysis.sizes_by_prefix(table(spark, sf_dir, "pages").select(F.col("url").alias("key"), F.octet_length("html").alias("size")), 3)


@query
def union_all_excluded(spark, sf_dir):
    both = inputs.event_days(spark, sf_dir).select("page_title").unionAll(inputs.event_hours(spark, sf_dir).select("page_title"))
    return both.filter(is_excluded(F.col("page_title"))).groupBy("page_title").agg(F.count(F.lit(1)).alias("n"))


@query
def incremental_equals_full(spark, sf_dir):
    """Partials of the first, middle and last hours of days, folded one after the other."""
    titles = inputs.event_hours(spark, sf_dir)
    parts = [tiers.day_partials(titles.filter(F.hour("hour_start").between(a, b))) for a, b in ((0, 7), (8, 15), (16, 23))]
    return tiers.compact_incrementally(parts).select("page_title", "dt", "views", "hours_present")


# --- manifest


def _manifest(spark, sf_dir):
    """Hours and day states made from orders: an order is the record of one hour of its day."""
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("dt"), "o_orderkey", (F.col("o_orderkey") % 24).cast("int").alias("h"))
    keyed = orders.groupBy("dt", "h").agg(F.min("o_orderkey").alias("k"))
    start = F.timestamp_add("HOUR", F.col("h") + 1, F.col("dt").cast("timestamp_ntz"))
    status = F.when(F.col("k") % 5 == 2, "failed").when(F.col("k") % 5 == 3, "in-flight").otherwise("done")
    hourly = keyed.select("dt", F.date_format(start, "yyyy-MM-dd'T'HH").alias("hour"), "k", status.alias("status"), (F.col("k") % 4).cast("int").alias("attempt"), (F.col("k") % 200).alias("lease_expires"))
    rest = F.dayofmonth("dt") % 7
    state = F.when(rest == 0, "compacted").when(rest == 1, "compacting").when(rest == 2, "invalidated").when(rest == 3, "failed")
    days = hourly.select("dt").distinct()
    return hourly, days, days.select("dt", state.alias("status"))


@query
def day_plan_states(spark, sf_dir):
    hourly, days, states = _manifest(spark, sf_dir)
    return manifest.day_plans(days, hourly.select("hour", "status", "attempt", "lease_expires"), states, now=100)


@query
def guard_decisions(spark, sf_dir):
    hourly, _, states = _manifest(spark, sf_dir)
    return manifest.guard(hourly.select("dt", "hour", (F.col("k") % 2 == 0).alias("force")), states)


@query
def partition_completeness(spark, sf_dir):
    hourly, days, _ = _manifest(spark, sf_dir)
    return manifest.completeness(hourly.select("dt", "hour"), days)


@query
def published_hours(spark, sf_dir):
    hourly = inputs.event_hours(spark, sf_dir)
    recorded = hourly.groupBy(manifest.hour_label(F.col("hour_start")).alias("hour")).agg((F.count(F.lit(1)) + F.max(F.when(manifest.hour_label(F.col("hour_start")).endswith("7"), 1).otherwise(0))).alias("rows"))
    return manifest.published_problems(hourly, recorded)


@query
def publish_states(spark, sf_dir):
    """Days after publishing: some not compacted, some with a wrong total or a wrong hour in the manifest."""
    daily, hourly = inputs.event_days(spark, sf_dir), inputs.event_hours(spark, sf_dir)
    day = F.dayofmonth("dt")
    totals = daily.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"), F.sum("views").alias("v"))
    states = totals.select("dt", F.when(day % 7 == 3, "failed").otherwise("compacted").alias("status"), "rows", (F.col("v") + F.when(day % 5 == 0, 1).otherwise(0)).alias("views"))
    counted = hourly.groupBy("hour_start").agg(F.count(F.lit(1)).alias("n"))
    off = F.when((F.dayofmonth("hour_start") % 4 == 2) & (F.hour("hour_start") % 10 == 6), 1).otherwise(0)
    recorded = counted.select(manifest.hour_label(F.col("hour_start")).alias("hour"), (F.col("n") + off).alias("rows"))
    return publish.publication(states, recorded, daily, hourly)


@query
def missing_months(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("dt"))
    return publish.missing_months(orders, orders.filter(F.month("dt") % 4 != 0))


@query
def day_rollup(spark, sf_dir):
    """Hours and days made from the same events, every third day's total one too high."""
    hourly = inputs.event_hours(spark, sf_dir)
    hours_kept = hourly.select(F.to_date("hour_start").alias("dt"), F.col("views").alias("views_kept"))
    totals = hourly.groupBy(F.to_date("hour_start").alias("dt")).agg(F.sum("views").alias("v"))
    days = totals.select("dt", (F.col("v") + F.when(F.dayofmonth("dt") % 3 == 0, 1).otherwise(0)).alias("views_unfloored"))
    return manifest.day_rollup(hours_kept, days)


@query
def missing_hours(spark, sf_dir):
    hourly = inputs.event_hours(spark, sf_dir).filter(F.hour("hour_start") % 6 != 5)
    end = F.lit(EVENTS.data_end_hour).cast("timestamp_ntz")
    return analysis.missing_hours(hourly, F.lit(EVENTS.window_start).cast("timestamp_ntz"), end)


@query
def hour_convention(spark, sf_dir):
    hourly = inputs.event_hours(spark, sf_dir)
    labelled = hourly.withColumn("hour_start", F.col("hour_start") + F.expr("INTERVAL 1 HOUR"))
    return analysis.hour_convention(hourly, labelled)


@query
def item_write_units(spark, sf_dir):
    """Bytes and write units of curves as text."""
    curves = _items(spark, sf_dir).select("spike_id", serving.curve_text(F.col("curve")).alias("curve"), "page_title")
    size = analysis.item_bytes(F.col("spike_id"), F.col("page_title"), F.col("curve"))
    return curves.select("spike_id", size.cast("long").alias("bytes"), analysis.write_units(size).alias("units"))


@query
def serving_documents(spark, sf_dir):
    return api.documents(chain(spark, sf_dir).facts, EVENTS)


@query
def parquet_footers(spark, sf_dir):
    ship_package(spark)
    return analysis.column_sizes(analysis.footers(spark, f"{sf_dir}/orders.parquet"))


@query
def models_in_sql(spark, sf_dir):
    """The chain as temporary views, asked in SQL."""
    inputs.register(chain(spark, sf_dir))
    return spark.sql("SELECT f.calendar_page, count(*) AS spikes, sum(h.n) AS hours, max(f.peak_views) AS most FROM fct_half_life f JOIN (SELECT spike_id, count(*) AS n FROM int_spike_hours GROUP BY spike_id) h USING (spike_id) GROUP BY f.calendar_page")


# --- parsers, on lines made from events


@query
def parse_hostile_lines(spark, sf_dir):
    """Counters of an hour file in which some lines are short, blank, of another project, without a number, or no UTF-8."""
    e = F.col("event_id")
    domain = F.when(F.col("user_id") % 4 == 1, "en.m").when(F.col("user_id") % 4 == 2, "de").otherwise("en")
    title = (
        F.when(e % 11 == 0, F.concat(F.lit("Talk:T"), F.col("user_id").cast("string")).cast("binary"))
        .when(e % 13 == 0, F.concat(F.unhex(F.lit("FFFE")), (F.col("user_id") % 5).cast("string").cast("binary")))
        .otherwise(F.concat(F.lit("Pagé_"), F.col("user_id").cast("string")).cast("binary"))
    )
    count = F.when(e % 17 == 0, "x1").otherwise((e % 90 + 1).cast("string"))
    space = F.lit(b" ")
    line = F.concat(domain.cast("binary"), space, title, space, count.cast("binary"), F.lit(b" 0"))
    line = F.when(e % 23 == 0, F.lit(b"")).when(e % 19 == 0, F.lit(b"en Short 5")).otherwise(line)
    return hour_files.parse(table(spark, sf_dir, "events").select(line.alias("line")))[1]


@query
def parse_hour_titles(spark, sf_dir):
    """The titles of such a file for each source hour, both projects as one."""
    e = F.col("event_id")
    domain = F.when(e % 3 == 1, "en.m").when(e % 3 == 2, "de").otherwise("en")
    line = F.concat_ws(" ", domain, F.concat(F.lit("Ü_"), F.col("user_id").cast("string")), (e % 90 + 1).cast("string"), F.lit("0"))
    lines = table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"), line.cast("binary").alias("line"))
    return hour_files.parse(lines, "hour_start")[0]


@query
def parse_mentions(spark, sf_dir):
    """Lags of a mentions feed in which some dates are no dates and some lines are short."""
    e = F.col("event_id")
    stamp = lambda at: F.date_format(at, "yyyyMMddHHmmss")
    event = F.when(e % 31 == 0, "20249901000000").otherwise(stamp(F.col("ts")))
    mention = stamp(F.timestamp_add("MINUTE", e % 500, F.col("ts")))
    line = F.concat_ws("\t", F.col("user_id").cast("string"), event, mention, F.lit("1"), F.col("event_type"), F.lit("http://x"), *[F.lit("0")] * 10)
    lines = table(spark, sf_dir, "events").select(F.when(e % 37 == 0, F.lit("short\tline")).otherwise(line).alias("line"))
    return feeds.lag_summary(feeds.parse_mentions(lines))


@query
def letters_feed(spark, sf_dir):
    """Hours of days told as letters, every seventh user's daily total wrong."""
    hourly = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("dt"), F.hour("ts").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("h", "n"))), lambda x: F.concat(F.chr(x["h"] + 65), x["n"].cast("string"))), "")
    daily = hourly.groupBy("user_id", "dt").agg(codes.alias("codes"), (F.sum("n") + F.when(F.col("user_id") % 7 == 0, 1).otherwise(0)).alias("daily"))
    line = F.concat_ws(" ", F.lit("en.project"), F.concat_ws("_", F.lit("U"), F.col("user_id").cast("string"), F.col("dt").cast("string")), F.lit("1"), F.lit("desktop"), F.col("daily").cast("string"), F.col("codes"))
    return feeds.parse_letters(daily.select(line.alias("line"))).select("title", "daily", "hours", "consistent")
