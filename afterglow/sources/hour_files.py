"""Byte-exact parsing of hourly counter files.

A line is "domain title count bytes", separated by single spaces, without quoting. Titles stay bytes until they are
grouped, because a title that is no UTF-8 counts once, with all its views, however many lines it has. Lines pass through
Latin-1, which keeps every byte, as Spark's string functions replace bytes that are no UTF-8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.config import PROJECTS
from afterglow.functions import is_excluded_bytes

LATIN = "ISO-8859-1"
#: What becomes of a line.
KEPT, EXCLUDED, BAD_INT, OTHER, INVALID = range(5)


def read_hour_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(line binary, source string) of text files, compressed or not; a compressed file is one task."""
    return spark.read.text(path).select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_name").alias("source"))


def source_hour(name: Column) -> Column:
    """Start of the hour of a file named `...-yyyyMMdd-HHmmss...`: files are named by its end."""
    stamp = F.regexp_extract(name, r"(\d{8})-(\d{6})", 0)
    return (F.try_to_timestamp(stamp, F.lit("yyyyMMdd-HHmmss")) - F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz")


def split_lines(lines: DataFrame) -> DataFrame:
    """Non-blank lines as `parts`, the four binary fields; null where a line has not exactly four."""
    text = F.decode("line", LATIN)
    parts = F.split(F.regexp_replace(text, "\r$", ""), " ", -1)
    found = lines.withColumn("_parts", parts).filter(F.length(text) > 0)
    field = lambda i: F.encode(F.get("_parts", F.lit(i)), LATIN)
    four = F.size("_parts") == 4
    return found.select(
        *[c for c in lines.columns if c != "line"], four.alias("valid"), F.when(four, field(0)).alias("domain"), F.when(four, field(1)).alias("title"), F.when(four, F.get("_parts", F.lit(2))).alias("count_text")
    )


def parse(lines: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """(titles, counters) of binary `line`s, for each value of the key columns, such as the source file.

    titles: keys, page_title, views of articles of the two projects, one row a title. counters: keys and the counts of
    everything skipped. Both are one aggregation on the binary title, so nothing is read twice for a counter.
    """
    split = split_lines(lines)
    project = F.col("domain").isin(*[p.encode() for p in PROJECTS])
    # digits beyond a long are as bad as no digits
    views = F.when(F.col("count_text").rlike("^[0-9]+$"), F.col("count_text").try_cast("long"))
    kind = F.when(~F.col("valid"), INVALID).when(~project, OTHER).when(views.isNull(), BAD_INT).when(is_excluded_bytes(F.col("title")), EXCLUDED).otherwise(KEPT)
    told = split.select(*keys, "title", kind.alias("kind"), views.alias("views"), (F.col("domain") == F.lit(PROJECTS[1].encode())).alias("mobile"))
    per_title = told.groupBy(*keys, "kind", F.when(F.col("kind") == KEPT, F.col("title")).alias("title")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("views"), F.lit(0)).alias("views"), F.coalesce(F.sum(F.when(F.col("mobile"), F.col("views"))), F.lit(0)).alias("mobile_views"),
        F.max("kind").alias("own_kind"),
    )
    # told by the aggregated kind: a filter on the grouping column would be pushed below and copy its whole expression there
    kept = F.col("own_kind") == KEPT
    per_title = per_title.withColumn("sound", F.when(kept, F.is_valid_utf8(F.col("title").cast("string"))).otherwise(False))
    titles = per_title.filter("sound").select(*keys, F.decode("title", "UTF-8").alias("page_title"), "views")
    total = lambda column, *kinds: F.coalesce(F.sum(F.when(F.col("own_kind").isin(*kinds), F.col(column))), F.lit(0))
    bad = kept & ~F.col("sound")
    counters = per_title.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
        total("n", OTHER).alias("rows_other_project"),
        total("n", INVALID).alias("rows_skipped_invalid"),
        total("n", BAD_INT).alias("rows_skipped_bad_int"),
        total("n", EXCLUDED).alias("rows_dropped_exclusions"),
        total("views", EXCLUDED).alias("views_dropped_exclusions"),
        total("views", KEPT, EXCLUDED).alias("views_before_exclusions"),
        (total("views", KEPT) - total("mobile_views", KEPT)).alias("views_en"),
        total("mobile_views", KEPT).alias("views_en_m"),
        total("n", KEPT).alias("rows_parsed"),
        F.count_if(bad).alias("rows_skipped_bad_utf8"),
        F.coalesce(F.sum(F.when(bad, F.col("views"))), F.lit(0)).alias("views_skipped_bad_utf8"),
        F.coalesce(F.sum(F.when(F.col("sound"), F.col("views"))), F.lit(0)).alias("views_kept"),
    )
    return titles, counters


def profile_lines(lines: DataFrame) -> DataFrame:
    """(fields, n) of a lenient reading: how many lines have how many fields. Blank lines have none."""
    text = F.decode("line", LATIN)
    size = F.when(F.length(F.trim(text)) == 0, 0).otherwise(F.size(F.split(text, " ", -1)))
    return lines.groupBy(size.cast("long").alias("fields")).agg(F.count(F.lit(1)).alias("n"))


def lenient(lines: DataFrame) -> DataFrame:
    """(rows, malformed, bad_counts, desktop_views, mobile_views) of a lenient reading: three fields are enough."""
    parts = F.split(F.decode("line", LATIN), " ", -1)
    count = F.when(F.get(parts, F.lit(2)).rlike("^-?[0-9]+$"), F.get(parts, F.lit(2)).try_cast("long"))
    rows = lines.filter(F.length(F.trim(F.decode("line", LATIN))) > 0).select((F.size(parts) >= 3).alias("ok"), F.get(parts, F.lit(0)).alias("domain"), count.alias("views"))
    total = lambda domain: F.coalesce(F.sum(F.when(F.col("ok") & (F.col("domain") == domain), F.col("views"))), F.lit(0))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("ok")).alias("malformed"), F.count_if(F.col("ok") & F.col("views").isNull()).alias("bad_counts"), total(PROJECTS[0]).alias("desktop_views"), total(PROJECTS[1]).alias("mobile_views"))
