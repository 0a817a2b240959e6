"""The layers of a run, as jobs over the table `events`."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import alerts, gold, layers
from tidemark.plans.workspace import folder
from tidemark.sources import feed


def stored_as(rows: DataFrame, name: str) -> DataFrame:
    """rows, written and read back."""
    path = folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Run:
    """Lazy frames of one run; burst windows of 10 minutes with 2 edits or more.

    With `stored` the typed layer is written once for the run, as it is in a running system, and what follows scans it for
    the columns that it needs: for queries that use it more than once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, min_edits: int = 2, stored: bool = False):
        self.spark, self.sf_dir, self.min_edits, self.stored = spark, sf_dir, min_edits, stored

    @property
    def received(self) -> DataFrame:
        return feed.received(self.spark, self.sf_dir)

    @property
    def topic(self) -> DataFrame:
        return feed.topic(self.spark, self.sf_dir)

    @property
    def dlq_topic(self) -> DataFrame:
        return feed.dlq_topic(self.spark, self.sf_dir)

    @property
    def bronze(self) -> DataFrame:
        return layers.to_bronze(self.topic, feed.SESSION)

    @property
    def dlq(self) -> DataFrame:
        return layers.to_dlq(self.dlq_topic, feed.SESSION)

    @cached_property
    def silver(self) -> DataFrame:
        rows = layers.silver(self.topic)
        return stored_as(rows, "silver") if self.stored else rows

    @cached_property
    def _alerts(self) -> DataFrame:
        found = alerts.find_alerts(self.silver, self.watchlist, self.rules)
        return stored_as(found, "alerts") if self.stored else found

    @property
    def watchlist(self) -> DataFrame:
        return feed.watchlist(self.spark)

    @property
    def rules(self) -> DataFrame:
        return feed.alert_rules(self.spark, self.min_edits)

    @property
    def alerts(self) -> DataFrame:
        """With detected_at: a fixed delay after ingestion, as no clock is read."""
        event_id = F.substring("meta_id", 4, 20).cast("long")
        return self._alerts.withColumn("detected_at", F.col("ingested_at") + F.make_dt_interval(secs=F.lit(1.5) * (event_id % 7)))

    @cached_property
    def bursts(self) -> DataFrame:
        found = gold.bursts(self.silver, self.watchlist, self.rules)
        return stored_as(found, "bursts") if self.stored else found

    @property
    def minutes(self) -> DataFrame:
        return gold.edits_per_minute(self.silver)

    @property
    def realtime(self) -> DataFrame:
        """What a view that waits 10 minutes for late rows has counted."""
        return gold.edits_per_minute(self.silver.where("not is_late"))

    @property
    def hourly(self) -> DataFrame:
        return gold.bot_ratio_hourly(self.silver)

    @property
    def digest(self) -> DataFrame:
        return gold.daily_digest(self.silver, self.watchlist, self.alerts, self.bursts)

    @property
    def now(self) -> datetime:
        """The logical time of the run: the last whole second of ingestion. One value, which then prunes as a literal."""
        last = feed.base_events(self.spark, self.sf_dir).agg(F.max("ingested_at")).first()[0]
        return (last or datetime(1970, 1, 1)).replace(microsecond=0)
