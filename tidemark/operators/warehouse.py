"""Reports over stored layers: each reads the last days or hours of partitioned tables, by a literal bound."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import gold, reports
from tidemark.operators.incremental import DAY, from_day
from tidemark.plans.pruning import Scan, visit

#: The stored layers, by the day of this time.
LAYERS = {"bronze": "ingested_at", "dlq": "ingested_at", "silver": "event_ts", "alerts": "event_ts", "bursts": "window_start"}
#: How far back a report looks.
WEEK, HALF_DAY = timedelta(days=7), timedelta(hours=12)


def store(rows: DataFrame, root: str, layer: str) -> None:
    """Writes a layer by days: a file for each, but several tasks and files for a day that is large for one task."""
    at = LAYERS[layer]
    rows.where(F.col(at).isNotNull()).withColumn(DAY, F.date_format(at, "yyyy-MM-dd")).hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{root}/{layer}")


class Warehouse:
    """The stored layers at one logical time. Nothing is read but what `since` bounds."""

    def __init__(self, spark: SparkSession, root: str, now: datetime, watchlist: DataFrame):
        self.spark, self.root, self.now, self.watchlist = spark, root, now, watchlist

    def since(self, layer: str, back: timedelta) -> DataFrame:
        """Rows of the layer from so long ago on: the partition column is compared with a literal, then the time itself."""
        bound, at = self.now - back, LAYERS[layer]
        rows = self.spark.read.parquet(f"{self.root}/{layer}")
        # the partition's label stays text in the comparison, whatever type Spark reads it as
        return rows.where(from_day(bound) & (F.col(at) >= F.lit(bound.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")))

    def tables(self) -> dict[str, tuple[str, str]]:
        return {layer: (f"{self.root}/{layer}", DAY) for layer in LAYERS}


#: Each report of the documents, over the stored layers.
REPORTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "edits_per_minute": lambda w: gold.edits_per_minute(w.since("silver", WEEK)),
    "bot_ratio_hourly": lambda w: gold.bot_ratio_hourly(w.since("silver", WEEK)),
    "page_activity": lambda w: reports.page_activity(w.since("silver", WEEK), w.watchlist),
    "daily_digest": lambda w: gold.daily_digest(w.since("silver", WEEK), w.watchlist, w.since("alerts", WEEK), w.since("bursts", WEEK)),
    "detection_latency": lambda w: reports.detection_latency(w.since("alerts", WEEK)),
    "severities": lambda w: reports.severity_summary(w.since("alerts", WEEK).select("severity", "event_ts")),
    "funnel": lambda w: reports.funnel(w.since("bronze", HALF_DAY), w.since("dlq", HALF_DAY)),
    "freshness": lambda w: reports.freshness(w.since("bronze", HALF_DAY), w.since("silver", HALF_DAY), gold.edits_per_minute(w.since("silver", HALF_DAY))),
}


def audit(warehouse: Warehouse, chosen: dict[str, Callable[[Warehouse], DataFrame]] | None = None) -> dict[str, list[Scan]]:
    """The scans of each report's plan; no report is run."""
    return {name: visit(report(warehouse), warehouse.tables()) for name, report in (REPORTS if chosen is None else chosen).items()}
