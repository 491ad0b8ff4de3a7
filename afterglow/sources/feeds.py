"""Auxiliary feeds: mentions, update indexes, daily letter vectors, REST series, listings, archives and seeds."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.functions import upper_median
from afterglow.session import ship_package

#: Columns of the mentions feed.
MENTION_COLUMNS = (
    "GlobalEventID", "EventTimeDate", "MentionTimeDate", "MentionType", "MentionSourceName", "MentionIdentifier", "SentenceID", "Actor1CharOffset",
    "Actor2CharOffset", "ActionCharOffset", "InRawText", "Confidence", "MentionDocLen", "MentionDocTone", "MentionDocTranslationInfo", "Extras",
)
STAMP = "yyyyMMddHHmmss"


def read_mentions(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated mentions without a header; short lines are kept for counting."""
    return parse_mentions(spark.read.text(path).select(F.col("value").alias("line")))


def parse_mentions(lines: DataFrame) -> DataFrame:
    """The columns of each line, `malformed` under six fields, `lag_minutes` from event to mention, `bad_date`."""
    parts = F.split("line", "\t", -1)
    columns = [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(MENTION_COLUMNS)]
    rows = lines.filter(F.length("line") > 0).select(*columns, (F.size(parts) < 6).alias("malformed"))
    event, mention = (F.try_to_timestamp(F.col(c), F.lit(STAMP)) for c in ("EventTimeDate", "MentionTimeDate"))
    lag = F.timestamp_diff("MINUTE", event, mention)
    return rows.withColumn("lag_minutes", F.when(~F.col("malformed"), lag)).withColumn("bad_date", ~F.col("malformed") & (event.isNull() | mention.isNull()))


def lag_summary(mentions: DataFrame) -> DataFrame:
    """(rows, malformed, bad_dates, events, sources, min_lag, median_lag, max_lag); the median is the upper one."""
    return mentions.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("malformed").alias("malformed"), F.count_if("bad_date").alias("bad_dates"), F.count_distinct("GlobalEventID").alias("events"),
        F.count_distinct("MentionSourceName").alias("sources"), F.min("lag_minutes").alias("min_lag"), upper_median("lag_minutes").cast("long").alias("median_lag"), F.max("lag_minutes").alias("max_lag"),
    )


def parse_update_index(lines: DataFrame) -> DataFrame:
    """(kind, size, md5, url) of lines of exactly three tokens."""
    parts = F.split(F.trim("line"), r"\s+")
    url = F.get(parts, F.lit(2))
    kind = F.when(url.contains(".export."), "export").when(url.contains(".mentions."), "mentions").when(url.contains(".gkg."), "gkg")
    return lines.filter(F.size(parts) == 3).select(kind.alias("kind"), F.get(parts, F.lit(0)).try_cast("long").alias("size"), F.get(parts, F.lit(1)).alias("md5"), url.alias("url"))


def letter_hours(codes: Column) -> Column:
    """24 hourly counts of a letter vector such as A12C3: A is the hour from midnight, letters left out are 0."""
    letters, counts = F.regexp_extract_all(codes, F.lit("([A-X])([0-9]+)"), F.lit(1)), F.regexp_extract_all(codes, F.lit("([A-X])([0-9]+)"), F.lit(2))
    pairs = F.arrays_zip(letters.alias("l"), counts.alias("n"))
    at = lambda hour: F.aggregate(pairs, F.lit(0).cast("long"), lambda s, p: s + F.when(F.ascii(p["l"]) == hour + 65, p["n"].cast("long")).otherwise(0))
    return F.transform(F.sequence(F.lit(0), F.lit(23)), at)


def parse_letters(lines: DataFrame) -> DataFrame:
    """(wiki, title, page_id, access, daily, hours, consistent) of lines of six fields; consistent: the hours add up to the day."""
    parts = F.split("line", " ", -1)
    names = ("wiki", "title", "page_id", "access")
    rows = lines.filter(F.size(parts) == 6).select(*(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)), F.get(parts, F.lit(4)).try_cast("long").alias("daily"), letter_hours(F.get(parts, F.lit(5))).alias("hours"))
    total = F.aggregate("hours", F.lit(0).cast("long"), lambda s, n: s + n)
    return rows.withColumn("consistent", F.coalesce(total == F.col("daily"), F.lit(False)))


def parse_rest_series(documents: DataFrame, column: str = "json") -> DataFrame:
    """(stamp, views) of the items of REST answers; what is missing is absent."""
    schema = "items array<struct<timestamp:string,views:bigint>>"
    items = documents.select(F.explode(F.from_json(column, schema)["items"]).alias("i"))
    return items.select(F.try_to_timestamp("i.timestamp", F.lit("yyyyMMddHH")).cast("timestamp_ntz").alias("stamp"), F.col("i.views").alias("views"))


def parse_listing(pages: DataFrame, column: str = "html") -> DataFrame:
    """(name, modified, size) of the files that an HTML directory listing names."""
    pattern = r'<a href="([^"]+)">[^<]*</a>\s+(\d{2}-[A-Za-z]{3}-\d{4} \d{2}:\d{2})\s+(\d+)'
    fields = [F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(i)).alias(n) for i, n in enumerate(("name", "modified", "size"), 1)]
    rows = pages.select(F.explode(F.arrays_zip(*fields)).alias("f"))
    return rows.select("f.name", F.try_to_timestamp("f.modified", F.lit("dd-MMM-yyyy HH:mm")).cast("timestamp_ntz").alias("modified"), F.col("f.size").cast("long").alias("size"))


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """(dt, hours_done) of the seed of complete days."""
    return spark.read.schema("dt date, hours_done int").option("header", True).csv(path)


def list_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size, modified) of files under a folder, contents not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, sha256) of files, for checking what was downloaded."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def read_zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, line) of the text members of zip archives, one archive a task."""
    ship_package(spark)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for where, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        lines = archive.read(member).decode("utf-8", "replace").splitlines()
                        yield pd.DataFrame({"path": where, "member": member, "line": lines})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, line string")
