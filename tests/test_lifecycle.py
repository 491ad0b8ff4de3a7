"""Parsing, tiers, manifest, publishing, feeds, guards and streams."""

import gzip
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig
from afterglow.functions import decode_curve, encode_curve, human_bytes, is_excluded, nearest_rank, percent_encoded, source_url, upper_median
from afterglow.operators import analysis, manifest, publish, reconcile, runner, scan_guard, tiers
from afterglow.session import ship_package
from afterglow.sources import feeds, hour_files, lake
from afterglow.streaming import decay_by_event, ingest_available, page_totals, read_table, replace_days

HOSTILE = [b"en Two 1", b"en Dog x1 0", b"en Caf\xc3\xa9 7 0", b"en.m Caf\xc3\xa9 3 0", b"en \xff\xfe 42 0", b"en.m \xff\xfe 8 0", b"en Bad 1\xff2 0", b"", b"de Katze 9 0",
           b"en Talk:Cat 3 0", b"en My_Talk:Cat 4 0", b'en "Q 6 0', b"en A B 1 0", b"en Main_Page 50 0", b"en - 5 0", b"en Huge 99999999999999999999 0", b"en Big 3000000000 0"]


def test_hour_file_is_read_byte_by_byte(spark, tmp_path):
    with gzip.open(tmp_path / "pageviews-20240913-010000.gz", "wb") as f:
        f.write(b"\n".join(HOSTILE) + b"\n")
    lines = hour_files.read_hour_files(spark, str(tmp_path)).withColumn("hour_start", hour_files.source_hour(F.col("source")))
    titles, counters = hour_files.parse(lines, "hour_start")
    assert {r.page_title: r.views for r in titles.collect()} == {"Café": 10, "My_Talk:Cat": 4, '"Q': 6, "Big": 3_000_000_000}
    assert {r.hour_start for r in titles.collect()} == {datetime(2024, 9, 13, 0)}
    c = counters.first()
    assert (c.rows_skipped_invalid, c.rows_skipped_bad_int, c.rows_skipped_bad_utf8, c.views_skipped_bad_utf8) == (2, 3, 1, 50)
    assert (c.rows_other_project, c.rows_dropped_exclusions, c.views_dropped_exclusions, c.views_en_m) == (1, 3, 58, 11)
    assert c.views_kept == 3_000_000_020 and c.views_before_exclusions == c.views_kept + 58 + 50 and c.rows_parsed == 7


def test_lenient_reading_counts_what_is_wrong(spark):
    lines = spark.createDataFrame([(bytearray(x),) for x in (b"en A 1000 1", b"en B 800", b"en.m A 2650 9", b"en C", b"x", b"", b"en D zz 1", b"de E 5 1")], "line binary")
    assert tuple(hour_files.lenient(lines).first()) == (7, 2, 1, 1800, 2650)
    assert {r.fields: r.n for r in hour_files.profile_lines(lines).collect()} == {4: 4, 3: 1, 2: 1, 1: 1, 0: 1}


def test_exclusion_is_by_prefix_only(spark):
    rows = spark.createDataFrame([("Main_Page",), ("-",), ("User:A",), ("A_User:B",), ("Users",), (None,)], "t string")
    assert [r.t for r in rows.filter(is_excluded(F.col("t"))).collect()] == ["Main_Page", "-", "User:A"]


def partials(spark):
    rows = []
    for h in range(24):
        if h == 13:
            continue
        rows += [("Every", datetime(2025, 8, 28, h), 10 + h), (f"Only_{h}", datetime(2025, 8, 28, h), 3), ("Ünïcode", datetime(2025, 8, 28, h), 1)]
        if h % 2:
            rows.append(("Odd", datetime(2025, 8, 28, h), 5))
        if h == 20:
            rows.append(("Huge", datetime(2025, 8, 28, h), 3_000_000_000))
    return spark.createDataFrame(rows, "page_title string, hour_start timestamp_ntz, views long")


def test_compaction_is_the_same_at_once_and_hour_by_hour(spark):
    titles = partials(spark)
    whole = tiers.compact(tiers.day_partials(titles))
    parts = [tiers.day_partials(titles.filter(F.hour("hour_start") == h)) for h in (*range(6), 13)] + [tiers.day_partials(titles.filter(F.hour("hour_start").between(6, 12) | (F.hour("hour_start") > 13)))]
    assert reconcile.multiset_difference(whole, tiers.compact_incrementally(parts)).count() == 0
    got = {r.page_title: (r.views, r.hours_present) for r in whole.collect()}
    assert got["Every"] == (sum(range(10, 34)) - 23, 23) and got["Odd"] == (55, 11) and got["Huge"] == (3_000_000_000, 1)
    assert tiers.apply_floor(whole, 10).count() == 4 and tiers.apply_floor(whole, 0).count() == whole.count()
    assert tiers.floor_report(whole, 10).first().rows_kept == 4
    with pytest.raises(ValueError):
        tiers.refloor(whole, 10, 5)
    assert tiers.refloor(whole, 10, 60).count() == 2
    hourly = tiers.page_hours(titles, SpikeConfig())
    assert hourly.filter("page_title = 'Every'").count() == 23 and hourly.filter("views < 10").count() == 0


def test_publishing_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "lake")
    row = lambda t, d, v: ("p", t, date(2025, 1, d), v, 24)
    schema = "project string, page_title string, dt date, views long, hours_present int"
    publish.publish_days(spark, spark.createDataFrame([row("A", 1, 5), row("B", 1, 6), row("A", 2, 7)], schema), path)
    changed = publish.republish(spark, spark.createDataFrame([row("A", 2, 8), row("C", 2, 1)], schema), path).collect()
    assert [(r.dt.day, r.status, r.old_rows, r.new_rows, r.new_total) for r in changed] == [(2, "different", 1, 2, 9)]
    stored = spark.read.parquet(path)
    assert {(r.page_title, r.dt.day, r.views) for r in stored.collect()} == {("A", 1, 5), ("B", 1, 6), ("A", 2, 8), ("C", 2, 1)}
    states = spark.createDataFrame([(date(2025, 1, 3), "compacting")], "dt date, status string")
    with pytest.raises(ValueError, match="not compacted"):
        publish.publish_days(spark, spark.createDataFrame([row("A", 3, 1)], schema), path, states)


DAY = date(2025, 3, 1)
HOURS = "hour string, status string, attempt int, lease_expires long"


def hour_rows(spark, **special):
    """All hours of the day done, but for those given."""
    rows = []
    for r in manifest.expected_hours(spark.createDataFrame([(DAY,)], "dt date")).collect():
        rows.append((r.hour, *special.get(r.hour.replace("-", "_"), ("done", 1, None))))
    return spark.createDataFrame([r for r in rows if r[1]], HOURS)


@pytest.mark.parametrize(
    ("hours", "state", "action"),
    [
        ({}, None, "compact"), ({"2025_03_01T05": ("failed", 1, None)}, None, "ingest"), ({"2025_03_01T05": (None, 0, None)}, None, "ingest"),
        ({"2025_03_01T05": ("in-flight", 1, 500)}, None, "wait"), ({"2025_03_01T05": ("in-flight", 1, 50)}, None, "ingest"),
        ({"2025_03_01T05": ("failed", 3, None)}, None, "incomplete"), ({"2025_03_01T05": ("failed", 3, None), "2025_03_02T00": ("in-flight", 1, 500)}, None, "wait"),
        ({}, "compacted", "skip"), ({}, "compacting", "resume-compaction"), ({}, "invalidated", "blocked"), ({}, "failed", "blocked"),
    ],
)
def test_day_plans(spark, hours, state, action):
    states = spark.createDataFrame([(DAY, state)] if state else [], "dt date, status string")
    plan = manifest.day_plans(spark.createDataFrame([(DAY,)], "dt date"), hour_rows(spark, **hours), states, now=100).first()
    assert plan.action == action and plan.todo + plan.done + plan.held + plan.exhausted == 24
    assert manifest.unfinished(manifest.day_plans(spark.createDataFrame([(DAY,)], "dt date"), hour_rows(spark, **hours), states, now=100)).count() == (action != "skip")


def test_window_has_all_source_hours(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-09-13', date'2026-09-12')) AS dt")
    hours = manifest.expected_hours(days)
    assert tuple(hours.agg(F.count_distinct("hour"), F.min("hour"), F.max("hour")).first()) == (17520, "2024-09-13T01", "2026-09-13T00")


def test_guard_claims_and_invalidation(spark):
    states = spark.createDataFrame([(date(2025, 1, d), s) for d, s in enumerate(("compacted", "compacting", "invalidated", "failed"), 1)], "dt date, status string")
    asked = spark.createDataFrame([(date(2025, 1, d), "h", f) for d in range(1, 6) for f in (True, False)], "dt date, hour string, force boolean")
    got = {(r.dt.day, r.force): r.decision for r in manifest.guard(asked, states).collect()}
    assert got == {(1, True): "invalidate", (1, False): "refuse", (2, True): "refuse", (2, False): "refuse", **{(3, f): "finish-quarantine" for f in (True, False)}, **{(d, f): "open" for d in (4, 5) for f in (True, False)}}
    rows = spark.createDataFrame([("a", None, None, None, False), ("b", "done", 1, None, False), ("c", "done", 1, None, True), ("d", "in-flight", 1, 99, False), ("e", "in-flight", 1, 100, False), ("f", "failed", 2, None, False)], HOURS + ", force boolean")
    got = {r.hour: (r.claimed, r.status, r.attempt, r.lease_expires) for r in manifest.claims(rows, now=100).collect()}
    assert {h for h, r in got.items() if r[0]} == {"a", "c", "d", "f"} and got["a"] == (True, "in-flight", 1, 160) and got["e"] == (False, "in-flight", 1, 100)
    gone = manifest.invalidate(spark.createDataFrame([(DAY, "compacted", 5, None)], "dt date, status string, rows long, views long")).first()
    assert (gone.status, gone.rows_previous, gone.views_previous) == ("invalidated", 5, -1)
    assert len(manifest.failed(rows, "x" * 2000).first().error) == 900


def test_completeness_of_partials(spark):
    expected = [r.hour for r in manifest.expected_hours(spark.createDataFrame([(DAY,)], "dt date")).collect()]
    objects = spark.createDataFrame([(DAY, h) for h in [*expected[:-2], "2025-03-05T01", None]], "dt date, hour string")
    assert tuple(manifest.completeness(objects, spark.createDataFrame([(DAY,)], "dt date")).first()) == (DAY, 2, 1, True)


def test_feeds(spark, tmp_path):
    index = spark.createDataFrame([("150383 297a http://x/20150218230000.export.CSV.zip",), ("318084 bb27 http://x/20150218230000.mentions.CSV.zip",), ("1 2",), ("5 6 http://x/a.gkg.csv.zip",)], "line string")
    assert [r.kind for r in feeds.parse_update_index(index).collect()] == ["export", "mentions", "gkg"]
    rest = spark.createDataFrame([('{"items":[{"timestamp":"2025010100","views":5},{"timestamp":"2025010200","views":7}]}',), ('{"items":[]}',)], "json string")
    assert [(r.stamp, r.views) for r in feeds.parse_rest_series(rest).collect()] == [(datetime(2025, 1, 1), 5), (datetime(2025, 1, 2), 7)]
    page = spark.createDataFrame([('<a href="../">../</a>\n<a href="f-1.gz">f-1.gz</a>   13-Sep-2024 02:10   58000000\n',)], "html string")
    assert tuple(feeds.parse_listing(page).first()) == ("f-1.gz", datetime(2024, 9, 13, 2, 10), 58000000)
    (tmp_path / "seed.csv").write_text("dt,hours_done\n2025-01-01,24\n")
    assert tuple(feeds.read_seed(spark, str(tmp_path / "seed.csv")).first()) == (date(2025, 1, 1), 24)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("m.csv", "one\ntwo\n")
    assert [(r.member, r.line) for r in feeds.read_zip_lines(spark, str(tmp_path / "a.zip")).collect()] == [("m.csv", "one"), ("m.csv", "two")]
    assert feeds.list_objects(spark, str(tmp_path), "*.zip").count() == 1
    assert len(feeds.file_digests(spark, str(tmp_path / "a.zip")).first().sha256) == 64


def test_small_functions(spark):
    ship_package(spark)
    one = spark.createDataFrame([([4_000_000, 0, 3], 1536, "A b/é", datetime(2024, 12, 31, 23))], "c array<long>, n long, t string, h timestamp_ntz")
    r = one.select(decode_curve(encode_curve("c")), human_bytes(F.col("n")), percent_encoded(F.col("t")), source_url("http://m/", F.col("h"))).first()
    assert tuple(r) == ([4_000_000, 0, 3], "1.5 KiB", "A%20b%2F%C3%A9", "http://m/2025/2025-01/pageviews-20250101-000000.gz")
    values = spark.createDataFrame([(v,) for v in (5, 1, 4, 2, None)], "v long")
    assert tuple(values.agg(nearest_rank("v", 0.25), nearest_rank("v", 0.75), upper_median("v")).first()) == (1, 4, 4)
    assert values.filter("v > 9").agg(nearest_rank("v", 0.5)).first()[0] is None


def test_checks_and_differences(spark):
    a = spark.createDataFrame([(1, None, 5), (2, 3, 5), (3, 3, -1)], "k long, x long, y long")
    b = spark.createDataFrame([(1, None, 5), (2, 4, 5), (4, 1, 1)], "k long, x long, y long")
    assert {r.k: r.status for r in reconcile.differences(a, b, ["k"]).collect()} == {2: "different", 3: "missing", 4: "unexpected"}
    assert reconcile.not_null(a, "x").count() == 1 and reconcile.non_negative(a, "y").count() == 1 and reconcile.in_range(a, "x", 0, 2).count() == 2
    checks = {r.name: (r.violations, r.ok) for r in reconcile.report({"unique": reconcile.unique(a, "k"), "y": reconcile.non_negative(a, "y")}).collect()}
    assert checks == {"unique": (0, True), "y": (1, False)}
    twice = a.unionAll(a)
    assert reconcile.day_summary(twice, "k", "y").filter("checksum = 0").count() == 0  # equal pairs do not cancel
    assert analysis.descents(a, "k", "y", "x").filter("x = 3").first().descents == 1


def test_scan_guard(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert scan_guard.guarded(df).count() == 1000
    with pytest.raises(scan_guard.ScanLimitExceeded):
        scan_guard.guarded(df, cap=10)


def test_streamed_days_equal_the_batch(spark, tmp_path):
    rows = [("A", datetime(2025, 1, 1, h), 1) for h in range(24)] + [("A", datetime(2025, 1, 4, 1), 5), ("B", datetime(2025, 1, 1, 3), 2)]
    spark.createDataFrame(rows, "page_title string, ts timestamp, views long").coalesce(1).write.parquet(str(tmp_path / "in"))
    late = [("A", datetime(2025, 1, 9), 1)]
    spark.createDataFrame(late, "page_title string, ts timestamp, views long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    totals = page_totals(read_table(spark, str(tmp_path / "in"), 1), "1 day").withColumn("dt", F.to_date("window_start")).drop("window_start")
    sink = replace_days(str(tmp_path / "out"))
    ingest_available(totals, str(tmp_path / "cp"), lambda batch, n: sink(batch, n) if not batch.isEmpty() else None).awaitTermination()
    got = {(r.page_title, r.dt.day): r.views for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[("A", 1)] == 24 and got[("B", 1)] == 2
    assert decay_by_event(spark.readStream.format("rate").load().select(F.col("timestamp").alias("ts"), F.col("value").alias("event"))).isStreaming


def test_stratified_sample_is_repeatable(spark):
    rows = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 40).alias("v"))
    one = analysis.stratified_sample(rows, "k", "v", [0, 10, 40], 7, seed=3)
    assert {r.stratum: r.n for r in one.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()} == {0: 7, 1: 7}
    assert sorted(one.collect()) == sorted(analysis.stratified_sample(rows.repartition(5), "k", "v", [0, 10, 40], 7, seed=3).collect())


class Fake:
    """A manifest in memory whose hours and day states the runner's collaborators change."""

    def __init__(self, spark, **special):
        self.spark, self.now, self.slept, self.state = spark, 100, [], None
        self.rows = {r.hour: [r.status, r.attempt, r.lease_expires] for r in hour_rows(spark, **special).collect()}
        self.works = True

    def runner(self):
        hours = lambda: self.spark.createDataFrame([(h, *r) for h, r in self.rows.items()], HOURS)
        states = lambda: self.spark.createDataFrame([(DAY, self.state)] if self.state else [], "dt date, status string")
        return runner.Runner(self.spark, states, hours, self.ingest, self.compact, lambda: self.now, self.sleep)

    def sleep(self, seconds):
        self.slept.append(seconds)
        self.now += int(seconds)

    def ingest(self, plan):
        for r in manifest.expected_hours(self.spark.createDataFrame([(DAY,)], "dt date")).collect():
            status, attempt, _ = self.rows.get(r.hour, ("pending", 0, None))
            if status != "done":
                self.rows[r.hour] = ["done", (attempt or 0) + 1, None] if self.works else ["failed", (attempt or 0) + 1, None]

    def compact(self, day):
        self.state = "compacted" if self.works else None
        return self.works


def test_runner_brings_a_day_to_its_end(spark):
    fake = Fake(spark, **{"2025_03_01T05": ("in-flight", 1, 150), "2025_03_01T06": ("failed", 1, None)})
    report = fake.runner().run_day(DAY)
    assert (report.outcome, report.log) == ("compacted", ["ingest", "compact", "skip"]) and fake.slept == [30]
    assert fake.runner().run_day(DAY).outcome == "skipped" and fake.runner().final_pass([DAY]) == {}
    waits = Fake(spark, **{"2025_03_01T05": ("in-flight", 1, 150)})
    assert waits.runner().run_day(DAY).log[:3] == ["wait", "ingest", "compact"] and waits.slept[0] == 51
    broken = Fake(spark, **{"2025_03_01T05": ("failed", 1, None)})
    broken.works = False
    report = broken.runner().run_day(DAY)
    assert report.outcome == "incomplete" and broken.slept == [30, 120]
    assert "failed for good" in broken.runner().final_pass([DAY])[DAY]
    held = Fake(spark)
    held.works = False
    assert held.runner().run_day(DAY).outcome == "compaction-failed"


def test_runner_takes_many_days_at_once(spark):
    fake = Fake(spark, **{"2025_03_01T05": ("failed", 1, None)})
    other = date(2025, 3, 2)  # a day without any record
    fake.works = False
    plans = []
    runs = fake.runner()
    runs.ingest = lambda plan: plans.append(plan.dt)
    reports = runs.run_days([DAY, other])
    assert {d: r.outcome for d, r in reports.items()} == {DAY: "stalled", other: "stalled"} and plans == [DAY, other] * runner.MAX_PASSES
    assert fake.slept == [30] + [120] * 7 and reports[other].retries == 0
    left = runs.final_pass([DAY, other])
    assert "2025-03-01T05: failed at attempt 1" in left[DAY] and left[other].count("never begun") == 24


def test_months_broken_off_are_loaded_again(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = spark.createDataFrame([("A", 1, date(2025, m, d)) for m in (1, 2) for d in (1, 2, 3)], "page_title string, views long, dt date")
    tiers.write_days(rows.filter("dt = date'2025-01-02'"), path)  # what a load left that died within January
    assert lake.load_months(spark, rows, path) == [date(2025, 1, 1), date(2025, 2, 1)]
    assert spark.read.parquet(path).count() == 6 and lake.load_months(spark, rows, path) == []


def test_curves_outside_the_format_are_refused(spark):
    for bad in ([-1], [1 << 32]):
        with pytest.raises(Exception, match="outside"):
            spark.createDataFrame([(bad,)], "c array<long>").select(encode_curve("c")).collect()
    rows = spark.createDataFrame([([0, (1 << 32) - 1],), ([],), (None,)], "c array<long>").select(decode_curve(encode_curve("c")).alias("c")).collect()
    assert [r.c for r in rows] == [[0, (1 << 32) - 1], [], None]


def test_footers_sizes_and_observed_counts(spark, tmp_path):
    ship_package(spark)
    rows = spark.range(20_000).select((F.hash("id") % 500).alias("t"), "id")
    sizes = analysis.layout_trial(rows, str(tmp_path), ["t"])
    assert sizes["sorted"] < sizes["as_is"]
    found = analysis.footers(spark, str(tmp_path / "sorted"))
    assert found.filter("column = 't'").agg(F.sum("rows")).first()[0] == 20_000
    df, seen = scan_guard.observed(spark.read.parquet(str(tmp_path / "sorted")), "counts", rows=F.count(F.lit(1)), large=F.count_if(F.col("id") > 9_999))
    df.write.mode("overwrite").parquet(str(tmp_path / "copy"))
    assert seen.get == {"rows": 20_000, "large": 10_000}
    again = spark.read.parquet(str(tmp_path / "copy")).groupBy("t").count()
    again.collect()
    assert scan_guard.read_bytes(again) > 1_000


def test_serving_facade(spark, tmp_path):
    from afterglow.plans import api, inputs

    found = inputs.chain(spark, "/root/testdata/sf0.01")
    api.store(found.facts, found.hours, str(tmp_path), inputs.EVENTS)
    server = api.Api(spark, str(tmp_path), inputs.EVENTS)
    code, body = server.handle("GET", "/api/summary", {})
    assert code == 200 and set(body) == {"stats", "fastest", "slowest"}
    code, hits = server.handle("GET", "/api/search", {"q": "user "})
    assert code == 200 and 0 < len(hits) <= 20 and "curve" not in hits[0]
    code, one = server.handle("GET", "/api/spike", {"id": hits[0]["spike_id"]})
    assert code == 200 and len(one["views"]) == len(one["excess"]) == inputs.EVENTS.horizon
    codes = [server.handle(m, r, q)[0] for m, r, q in (("POST", "/api/summary", {}), ("GET", "/x", {}), ("GET", "/api/search", {}), ("GET", "/api/search", {"q": "x" * 101}), ("GET", "/api/spike", {"id": ""}), ("GET", "/api/spike", {"id": "User none"}))]
    assert codes == [405, 404, 400, 400, 400, 404]


def test_lake_tables_and_months(spark, tmp_path):
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "a.csv").write_text("A;5\nB;7\n")
    lake.create_text_table(spark, "text_views", str(tmp_path / "text"), "page_title STRING, views BIGINT", ";")
    assert spark.table("text_views").agg(F.sum("views")).first()[0] == 12
    schema = "page_title string, dt date, views long"
    rows = spark.createDataFrame([("A", date(2025, m, d), m * d) for m in (1, 2, 3) for d in (1, 28)], schema)
    path = str(tmp_path / "lake")
    assert lake.load_months(spark, rows.filter("month(dt) < 3"), path) == [date(2025, 1, 1), date(2025, 2, 1)]
    assert lake.load_months(spark, rows, path) == [date(2025, 3, 1)] and lake.load_months(spark, rows, path) == []
    lake.create_day_table(spark, "day_views", path, "page_title STRING, views BIGINT, dt DATE")
    spark.sql("MSCK REPAIR TABLE day_views")
    assert spark.table("day_views").agg(F.sum("views"), F.count_distinct("dt")).first() == (174, 6)
    for name in ("text_views", "day_views"):
        lake.drop_table(spark, name)
    lake.append_journal(rows.limit(1), str(tmp_path / "journal"))
    lake.append_journal(rows.limit(1), str(tmp_path / "journal"))
    assert spark.read.json(str(tmp_path / "journal")).count() == 2


def test_publication_tells_refused_replacing_and_published_days(spark):
    days = [date(2024, 5, d) for d in (1, 2, 3)]
    daily = spark.createDataFrame([("A", d, 24) for d in days], "page_title string, dt date, views long")
    hourly = spark.createDataFrame([("A", datetime(2024, 5, d.day, h), 1) for d in days for h in range(24)], "page_title string, hour_start timestamp_ntz, views long")
    labels = manifest.expected_hours(daily.select("dt"))
    hours = labels.select("hour", F.when(F.col("hour") == "2024-05-02T05", 9).otherwise(1).alias("rows"))
    states = spark.createDataFrame([(days[0], "compacted", 1, 24), (days[1], "compacted", 1, 25), (days[2], None, 1, 24)], "dt date, status string, rows long, views long")
    found = {r.dt.day: (r.state, r.problems) for r in publish.publication(states, hours, daily, hourly).collect()}
    assert found == {1: ("published", 0), 2: ("replacing", 2), 3: ("refused", 0)}
    unrecorded = publish.publication(states, hours.limit(0), daily, hourly)
    assert {r.problems for r in unrecorded.collect()} == {24, 25}
    assert publish.publication(states.limit(0), hours, daily, hourly).collect() == []


def test_staging_of_published_days_is_retired_once(spark, tmp_path):
    keys = []
    for name in ("day.parquet", "part-0.parquet"):
        (tmp_path / name).write_text("x")
        keys.append((date(2024, 5, 1), f"file://{tmp_path}/{name}"))
    staging = spark.createDataFrame(keys, "dt date, key string")
    states = spark.createDataFrame([(date(2024, 5, 1), True)], "dt date, published boolean")
    with pytest.raises(ValueError, match="not published"):
        publish.retire(spark, staging, states.withColumn("published", F.lit(False)))
    assert len(list(tmp_path.glob("*.parquet"))) == 2
    assert publish.retire(spark, staging, states) == 2
    assert publish.retire(spark, staging, states) == 0
    assert not list(tmp_path.glob("*.parquet"))
