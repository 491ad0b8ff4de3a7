"""Tables of the lake: external text tables, day-partitioned Parquet tables, and loading them month by month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.operators.publish import missing_months
from afterglow.operators.tiers import write_days


def quoted(name: str) -> str:
    """A table name, each part in backquotes."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def create_text_table(spark: SparkSession, name: str, path: str, columns: str, separator: str = ",") -> None:
    """An external table over delimited text files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING csv OPTIONS (sep '{separator}') LOCATION '{path}'")


def create_day_table(spark: SparkSession, name: str, path: str, columns: str, partition: str = "dt") -> None:
    """An external Parquet table partitioned by day, compressed with zstd."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY ({partition}) LOCATION '{path}'")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def load_months(spark: SparkSession, rows: DataFrame, path: str, sort: tuple[str, ...] = ("page_title",)) -> list:
    """Write the months that are not recorded as loaded, one after the other, and give their first days.

    A month is recorded in a journal beside the table, after its days are all there; a load that broke off within a month writes
    that month again, whole, and a recorded one is not read again.
    """
    journal = f"{path.rstrip('/')}_months"
    try:
        done = spark.read.schema("month_start date").json(journal)
        done.limit(0).collect()
    except Exception as missing:  # nothing is recorded yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        done = spark.createDataFrame([], "month_start date")
    months = sorted((r["month_start"], r["month_end"]) for r in missing_months(rows, done, stored_day="month_start").collect())  # one row a month
    for first, last in months:
        write_days(rows.filter(F.col("dt").between(F.lit(first), F.lit(last))), path, sort)
        append_journal(spark.createDataFrame([(first,)], "month_start date"), journal)
    return [first for first, _ in months]


def append_journal(records: DataFrame, path: str) -> None:
    """Add records to a journal of JSON lines."""
    records.write.mode("append").json(path)
