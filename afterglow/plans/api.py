"""The serving facade: what is stored for it, and the three answers it gives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.config import SpikeConfig
from afterglow.operators import serving


def documents(facts: DataFrame, config: SpikeConfig) -> DataFrame:
    """(name, body) of the stored JSON documents: headline numbers with quartiles, and both leaderboards."""
    eligible = F.col("leaderboard_eligible")
    named = {
        "attention_half_life": ("attention_half_life_hours", eligible), "attention_half_life_including_rekindled": ("attention_half_life_hours", serving.big_spikes(config)),
        "long_tail_share": ("long_tail_share", eligible), "peak_hour_half_life": ("peak_hour_half_life_hours", eligible),
    }
    stats = serving.headline(facts, config, **named)
    out = stats.select(F.lit("stats").alias("name"), F.to_json(F.struct(*stats.columns)).alias("body"))
    for name, slowest in (("fastest", False), ("slowest", True)):
        board = serving.leaderboard(facts, config, slowest)
        # a page of rows in one partition, in the order of their rank
        body = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.struct(*board.columns).alias("row")))), lambda r: r["row"]))
        out = out.unionAll(serving.numbered(board).agg(body.alias("body")).select(F.lit(name).alias("name"), "body"))
    return out


def store(facts: DataFrame, hours: DataFrame, path: str, config: SpikeConfig) -> None:
    """Write documents and items; items lie by the first character of their search key, so a search reads one folder, whose
    files are ranges of keys, as one character may begin many titles.

    A whole overwrite converges: items of spikes that are gone go with it.
    """
    items = serving.index_items(serving.curves(facts, hours, config))
    items.repartitionByRange("bucket", "search_key").sortWithinPartitions("bucket", "search_key").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/items")
    documents(facts, config).coalesce(1).write.mode("overwrite").parquet(f"{path}/documents")


class Api:
    """Answers from what `store` wrote, as (status, body)."""

    def __init__(self, spark: SparkSession, path: str, config: SpikeConfig):
        self.spark, self.path, self.config = spark, path, config

    def summary(self) -> tuple[int, dict]:
        found = {r["name"]: r["body"] for r in self.spark.read.parquet(f"{self.path}/documents").collect()}  # three rows
        return (200, found) if "stats" in found else (503, {"error": "not loaded"})

    def search(self, text: str | None) -> tuple[int, list | dict]:
        try:
            hits = serving.search(self.spark.read.parquet(f"{self.path}/items"), text or "", self.config)
        except ValueError as wrong:
            return 400, {"error": str(wrong)}
        return 200, [r.asDict() for r in hits.collect()]

    def spike(self, spike_id: str | None) -> tuple[int, dict]:
        if not spike_id or len(spike_id) > 400:
            return 400, {"error": "an id has 1 to 400 characters"}
        key = serving.first_bucket(spike_id)
        items = self.spark.read.parquet(f"{self.path}/items").filter(F.col("bucket") == key)
        row = serving.spike_detail(items, spike_id).drop("bucket", "search_key").first()
        return (200, row.asDict()) if row else (404, {"error": "no such spike"})

    def handle(self, method: str, route: str, query: dict[str, str]) -> tuple[int, object]:
        """Route a request."""
        if method != "GET":
            return 405, {"error": "only GET"}
        routes: dict[str, Callable[[], tuple[int, object]]] = {"/api/summary": self.summary, "/api/search": lambda: self.search(query.get("q")), "/api/spike": lambda: self.spike(query.get("id"))}
        return routes[route]() if route in routes else (404, {"error": "no such path"})
