"""What floors cost: sweeps, sensitivity of baselines, samples, top lists, and layout statistics."""

from __future__ import annotations

import io

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from afterglow.config import CANDIDATE_FLOORS, SpikeConfig
from afterglow.functions import qualifies, strata


def floor_sweep(rows: DataFrame, value: str = "views", floors: tuple[int, ...] = CANDIDATE_FLOORS) -> DataFrame:
    """(floor, rows_kept, views_kept) at each floor, from one pass over the rows."""
    sums = [F.struct(F.lit(f).alias("floor"), F.count_if(F.col(value) >= f).alias("rows_kept"), F.coalesce(F.sum(F.when(F.col(value) >= f, F.col(value))), F.lit(0)).cast("long").alias("views_kept")) for f in floors]
    return rows.agg(F.array(*sums).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def floor_sensitivity(spine: DataFrame, config: SpikeConfig, floors: tuple[int, ...] = CANDIDATE_FLOORS) -> DataFrame:
    """(floor, spikes, days_lost, baselines_moved, spikes_lost, false_spikes): what each floor would do to first spikes.

    A page's first day that qualifies on full data is its spike. days_lost: days of their baseline windows under the
    floor; baselines_moved: baselines changed by over a tenth; spikes_lost: spikes that no longer qualify; false_spikes:
    pages without a spike that get one.

    Dropping small values to 0 keeps the order of a window, so every floor's median follows from the two middle values,
    which one window pass finds. Lost days are counted only for the windows of spikes, by a join back.
    """
    last, n = config.baseline_offset, config.baseline_days
    frame = Window.partitionBy("page_title").orderBy("dt").rowsBetween(-(last + n - 1), -last)
    middle = [((n - 1) // 2) / max(n - 1, 1), (n // 2) / max(n - 1, 1)]
    values = spine.select("page_title", "dt", F.coalesce("daily_views", F.lit(0)).alias("v"))
    based = values.withColumn("n", F.count("v").over(frame)).withColumn("m", F.percentile("v", F.array(*map(F.lit, middle))).over(frame))
    # middle values are whole numbers, which interpolation at their very ranks may miss by a rounding error
    low, high = (F.round(F.get("m", F.lit(i))).cast("long") for i in (0, 1))
    full = based.filter(F.col("n") == n).select("page_title", "dt", "v", low.alias("low"), high.alias("high"))
    at = lambda f: (F.when(F.col("low") >= f, F.col("low")).otherwise(0) + F.when(F.col("high") >= f, F.col("high")).otherwise(0)) / 2
    full = full.withColumn("base", (F.col("low") + F.col("high")) / 2).withColumn("ok", qualifies(F.col("v"), F.col("base"), config))
    for f in floors:
        full = full.withColumn(f"base_{f}", at(f)).withColumn(f"ok_{f}", qualifies(F.col("v"), F.col(f"base_{f}"), config))
    first = F.min(F.when(F.col("ok"), F.struct("dt", "v", "base", *(c for f in floors for c in (f"base_{f}", f"ok_{f}"))))).alias("s")
    pages = full.groupBy("page_title").agg(first, *(F.coalesce(F.bool_or(F.col(f"ok_{f}")), F.lit(False)).alias(f"any_{f}") for f in floors))
    spans = pages.filter("s IS NOT NULL").select("page_title", F.date_sub("s.dt", last + n - 1).alias("_a"), F.date_sub("s.dt", last).alias("_b"))
    inside = values.join(spans, "page_title").filter(F.col("dt").between(F.col("_a"), F.col("_b")))
    lost = inside.agg(*(F.count_if(F.col("v") < f).alias(f"lost_{f}") for f in floors))
    spiked = F.col("s").isNotNull()
    per_floor = [
        F.struct(
            F.lit(f).alias("floor"), F.count_if(spiked).alias("spikes"),
            F.count_if(spiked & (F.col("s.base") > 0) & (F.abs(F.col(f"s.base_{f}") - F.col("s.base")) * 10 > F.col("s.base"))).alias("baselines_moved"),
            F.count_if(spiked & ~F.col(f"s.ok_{f}")).alias("spikes_lost"), F.count_if(~spiked & F.col(f"any_{f}")).alias("false_spikes"),
        )
        for f in floors
    ]
    days = lost.select(F.explode(F.array(*(F.struct(F.lit(f).alias("floor"), F.col(f"lost_{f}").alias("days_lost")) for f in floors))).alias("d")).select("d.*")
    counts = pages.agg(F.array(*per_floor).alias("a")).select(F.explode("a").alias("a")).select("a.*")
    return counts.join(days, "floor").select("floor", "spikes", "days_lost", "baselines_moved", "spikes_lost", "false_spikes")


def stratum_counts(rows: DataFrame, value: str, edges: list[int]) -> DataFrame:
    """(stratum, n, total) of half-open ranges of a value."""
    return rows.withColumn("stratum", strata(F.col(value), edges)).filter("stratum IS NOT NULL").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def stratified_sample(rows: DataFrame, key: str, value: str, edges: list[int], per_stratum: int, seed: int = 0) -> DataFrame:
    """At most `per_stratum` rows of each range, drawn by a seeded hash of their key, so a repeated run draws the same."""
    draw = F.xxhash64(F.lit(seed), F.col(key).cast("string"))
    order = Window.partitionBy("stratum").orderBy(draw, key)
    return rows.withColumn("stratum", strata(F.col(value), edges)).filter("stratum IS NOT NULL").withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_stratum).drop("_n")


def top_k(rows: DataFrame, key: str, k: int) -> DataFrame:
    """(key, n) of the most frequent values, ties by value."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), key).limit(k)


def descents(rows: DataFrame, order: str, value: str, group: str) -> DataFrame:
    """(group, rows, descents): how often a value falls along an order; 0 says the layout is sorted."""
    before = F.lag(value).over(Window.partitionBy(group).orderBy(order, value))
    return rows.withColumn("_b", before).groupBy(group).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_b") > F.col(value)).alias("descents"))


def rest_mismatches(stored: DataFrame, reference: DataFrame, keys: list[str], value: str = "views") -> DataFrame:
    """Reference values that the store lacks or differs from."""
    joined = reference.withColumnRenamed(value, "_want").join(stored.select(*keys, value), keys, "left")
    return joined.filter(~F.col(value).eqNullSafe(F.col("_want"))).select(*keys, F.col("_want").alias("expected"), F.col(value).alias("stored"))


def item_bytes(*columns: Column) -> Column:
    """Bytes of an item's texts and blobs."""
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0))


def write_units(size: Column) -> Column:
    """Write units of an item: one a started kilobyte."""
    return F.ceil(size / 1024.0)


def daily_total(hourly: DataFrame, title: str) -> DataFrame:
    """(dt, views) of one title; the filter reaches the scan."""
    return hourly.filter(F.col("page_title") == title).groupBy(F.to_date("hour_start").alias("dt")).agg(F.sum("views").alias("views"))


def mean_and_most(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, mean, most) of a value; nulls count in neither."""
    return rows.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.max(value).alias("most"))


def sizes_by_prefix(objects: DataFrame, depth: int) -> DataFrame:
    """(prefix, objects, bytes) of stored objects (key, size) by the first `depth` parts of their keys."""
    return objects.groupBy(F.substring_index("key", "/", depth).alias("prefix")).agg(F.count(F.lit(1)).alias("objects"), F.sum("size").alias("bytes"))


def missing_hours(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """(hour_start) of the hours of a span without any row."""
    span = rows.sparkSession.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias("hour_start"))
    return span.join(rows.select("hour_start"), "hour_start", "left_anti")


def hour_convention(stored: DataFrame, reference: DataFrame, shifts: tuple[int, ...] = (-1, 0, 1)) -> DataFrame:
    """(shift, matches, compared): how often values agree exactly with a reference that is read so many hours later.

    The right convention of labels is the shift at which nearly all agree.
    """
    moved = reference.select("page_title", F.col("hour_start").alias("_hour"), F.col("views").alias("_views"))
    moved = moved.select("page_title", "_views", F.explode(F.array(*(F.struct(F.lit(s).alias("shift"), F.timestamp_add("HOUR", F.lit(s), F.col("_hour")).alias("hour_start")) for s in shifts))).alias("m"))
    moved = moved.select("page_title", "_views", F.col("m.shift").alias("shift"), F.col("m.hour_start").alias("hour_start"))
    joined = moved.join(stored.select("page_title", "hour_start", "views"), ["page_title", "hour_start"])
    return joined.groupBy("shift").agg(F.count_if(F.col("views") == F.col("_views")).alias("matches"), F.count(F.lit(1)).alias("compared"))


def footers(spark: SparkSession, path: str) -> DataFrame:
    """(path, row_group, column, rows, compressed, least, most) from the footers of Parquet files, one task a file."""

    def run(frames):
        for frame in frames:
            out = []
            for where, content in zip(frame["path"], frame["content"], strict=True):
                meta = pq.ParquetFile(io.BytesIO(content)).metadata
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        column = group.column(c)
                        stats = column.statistics
                        known = stats is not None and stats.has_min_max
                        out.append((where, g, column.path_in_schema, group.num_rows, column.total_compressed_size, str(stats.min) if known else None, str(stats.max) if known else None))
            yield pd.DataFrame(out, columns=["path", "row_group", "column", "rows", "compressed", "least", "most"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "content").mapInPandas(run, "path string, row_group int, column string, rows long, compressed long, least string, most string")


def column_sizes(found: DataFrame) -> DataFrame:
    """(column, compressed, row_groups) summed over footers."""
    return found.groupBy("column").agg(F.sum("compressed").alias("compressed"), F.count(F.lit(1)).alias("row_groups"))


def layout_trial(rows: DataFrame, path: str, sort: list[str]) -> dict[str, int]:
    """Compressed bytes of the rows written as they come and written sorted."""
    spark, out = rows.sparkSession, {}
    for name, df in (("as_is", rows), ("sorted", rows.repartitionByRange(*sort).sortWithinPartitions(*sort))):
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")
        out[name] = column_sizes(footers(spark, f"{path}/{name}")).agg(F.sum("compressed")).first()[0]
    return out
