"""Batch models over typed rows: minutes, hours, bursts, daily digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.alerts import watched


def _count_if(c: Column, name: str) -> Column:
    return F.count_if(c).alias(name)


def counted(rows: DataFrame) -> DataFrame:
    """Edits and new pages: what all counts are over."""
    return rows.where(F.col("edit_type").isin(*S.COUNTED_TYPES))


def activity_counts() -> list[Column]:
    """What minutes hold, in the batch view and in the real-time one."""
    return [F.count("*").alias("edits"), _count_if(F.col("is_bot"), "bot_edits"), F.coalesce(F.sum(F.abs("byte_delta")), F.lit(0)).alias("bytes_changed")]


def edits_per_minute(rows: DataFrame) -> DataFrame:
    """Complete counts of each minute and wiki, late rows included."""
    out = counted(rows).groupBy(S.minute(F.col("event_ts")).alias("window_start"), "wiki").agg(*activity_counts())
    return out.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 MINUTE"))


def bot_ratio_hourly(rows: DataFrame) -> DataFrame:
    r = counted(rows).withColumn("hour_start", S.hour(F.col("event_ts")))
    bot = F.coalesce(F.col("is_bot"), F.lit(False))
    out = r.groupBy("hour_start", "wiki").agg(F.count("*").alias("edits"), _count_if(bot, "bot_edits"), _count_if(~bot, "human_edits"))
    return out.withColumn("bot_share", F.col("bot_edits").cast("double") / F.col("edits"))


def bursts(rows: DataFrame, watchlist: DataFrame, rules: DataFrame) -> DataFrame:
    """R5: pages with min_edits edits or more in a fixed window of window_minutes, aligned to the hour. A disabled rule gives no
    row; the rule is one row."""
    rule = rules.where("rule_id = 'R5' and enabled").select("severity", "min_edits", "window_minutes")
    r = watched(counted(rows), watchlist).crossJoin(F.broadcast(rule))
    into = F.floor(F.minute("event_ts") / F.col("window_minutes")) * F.col("window_minutes")
    r = r.withColumn("window_start", S.hour(F.col("event_ts")) + F.make_dt_interval(mins=into.cast("int")))
    out = r.groupBy("wiki", "title", "category", "owner_team", "severity", "window_start").agg(
        F.max("window_minutes").alias("_m"), F.max("min_edits").alias("_least"), F.count("*").alias("edits"), F.min("event_ts").alias("first_edit_ts"), F.max("event_ts").alias("last_edit_ts")
    )
    return out.where("edits >= _least").select(
        S.burst_alert_id(F.col("wiki"), F.col("title"), F.col("window_start")).alias("alert_id"), F.lit("R5").alias("rule_id"), "severity", "wiki", "title", "category", "owner_team",
        "window_start", (F.col("window_start") + F.make_dt_interval(mins="_m")).alias("window_end"), "edits", "first_edit_ts", "last_edit_ts",
    )


def digest_activity(rows: DataFrame, watchlist: DataFrame) -> DataFrame:
    counted = F.col("edit_type").isin(*S.COUNTED_TYPES)
    r = watched(rows, watchlist).withColumn("digest_date", F.to_date("event_ts"))
    return r.groupBy("digest_date", "wiki", "title", "category", "owner_team").agg(
        _count_if(counted, "edits"),
        _count_if(F.col("edit_type") == "log", "log_events"),
        F.coalesce(F.sum("byte_delta"), F.lit(0)).alias("net_bytes"),
        *[_count_if(counted & (F.col("editor_type") == t), f"{t}_edits") for t in S.EDITOR_TYPES],
    )


def digest_rules(alerts: DataFrame) -> DataFrame:
    rules = ["R1", "R2", "R3", "R4"]
    pivot = alerts.groupBy(F.to_date("event_ts").alias("digest_date"), "wiki", "title").pivot("rule_id", rules).count()
    return pivot.select("digest_date", "wiki", "title", *[F.coalesce(r, F.lit(0)).cast("long").alias(f"{r.lower()}_alerts") for r in rules])


def digest_bursts(burst_alerts: DataFrame) -> DataFrame:
    return burst_alerts.groupBy(F.to_date("window_start").alias("digest_date"), "wiki", "title").agg(F.count("*").alias("r5_alerts"))


def daily_digest(rows: DataFrame, watchlist: DataFrame, alerts: DataFrame, burst_alerts: DataFrame) -> DataFrame:
    """Activity with alert counts; a page-day without activity has no row, whatever its alerts."""
    key = ["digest_date", "wiki", "title"]
    out = digest_activity(rows, watchlist).join(digest_rules(alerts), key, "left").join(digest_bursts(burst_alerts), key, "left")
    counts = [f"r{i}_alerts" for i in range(1, 6)]
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
