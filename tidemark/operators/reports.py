"""Report queries: unions, merges of two views of the same minutes, top rows, latency."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.alerts import watched


def severity_rank() -> Column:
    return F.when(F.col("severity") == "high", 0).when(F.col("severity") == "medium", 1).otherwise(2)


def alerts_union(alerts: DataFrame, bursts: DataFrame, rules: DataFrame) -> DataFrame:
    """Edit alerts and burst alerts in one shape; what one kind lacks is null; alerts of unknown rules are left out. A burst without a
    time of detection of its own counts as detected at the end of its window."""
    names = rules.select("rule_id", "rule_name")
    a = alerts.withColumn("arrived_late", S.arrived_late(F.col("ingested_at"), F.col("event_ts")))
    columns = ["alert_id", "rule_id", "severity", "wiki", "title", "category", "owner_team", "edit_type", "log_action", "editor_type", "byte_delta", "event_ts", "detected_at", "revision_old", "revision_new", "arrived_late"]
    found = "detected_at" if "detected_at" in bursts.columns else "window_end"
    b = bursts.select("alert_id", "rule_id", "severity", "wiki", "title", "category", "owner_team", F.col("edits").alias("edits_in_window"), F.col("window_start").alias("event_ts"), F.col(found).alias("detected_at"))
    return a.select(*columns).unionByName(b, allowMissingColumns=True).join(names, "rule_id")


def top_alerts(union: DataFrame, n: int = 500) -> DataFrame:
    """By severity, then newest; ties by alert_id."""
    return union.orderBy(severity_rank(), F.col("event_ts").desc(), "alert_id").limit(n)


def top_digest(digest: DataFrame, n: int = 500) -> DataFrame:
    return digest.orderBy(F.col("digest_date").desc(), F.col("edits").desc(), "wiki", "title").limit(n)


def edits_by_minute(counts: DataFrame) -> DataFrame:
    return counts.groupBy(F.col("window_start").alias("minute")).agg(F.sum("edits").alias("edits"))


def last_rows(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n rows with the greatest values, in ascending order."""
    return df.orderBy(F.col(column).desc()).limit(n).orderBy(column)


def merged_minutes(final: DataFrame, realtime: DataFrame, n: int = 400) -> DataFrame:
    """minute, final_edits, realtime_edits of the last n minutes that either view has."""
    f = edits_by_minute(final).withColumnRenamed("edits", "final_edits")
    r = edits_by_minute(realtime).withColumnRenamed("edits", "realtime_edits")
    return last_rows(f.join(r, "minute", "full_outer"), "minute", n)


def minute_series(minutes: DataFrame, most: int = 400) -> DataFrame:
    """A row for each minute from first to last (if that is at most `most`, else the given ones), with the gap [real-time or 0,
    final] where final is larger."""
    ends = minutes.agg(F.min("minute").alias("a"), F.max("minute").alias("b")).where("a is not null")
    few = F.timestamp_diff("MINUTE", F.col("a"), F.col("b")) < most
    grid = ends.where(few).select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MINUTE"))).alias("minute"))
    whole = minutes.join(F.broadcast(ends.select((~few).alias("_wide"))), F.lit(True)).where("_wide").drop("_wide")  # one row
    series = grid.join(minutes, "minute", "left").unionByName(whole)
    known = F.coalesce("realtime_edits", F.lit(0))
    gap = F.col("final_edits") > known
    return series.withColumns({"gap_from": F.when(gap, known), "gap_to": F.when(gap, F.col("final_edits"))})


def bot_share(hourly: DataFrame) -> DataFrame:
    out = hourly.groupBy(F.col("hour_start").alias("hour")).agg(F.sum("edits").alias("edits"), F.sum("bot_edits").alias("bot_edits"))
    return out.withColumn("bot_share", F.when(F.col("edits") > 0, F.round(F.col("bot_edits") / F.col("edits"), 4)).otherwise(F.lit(0.0)))


def recorded_hours(final: DataFrame) -> DataFrame:
    return final.select(S.hour(F.col("window_start")).alias("hour")).distinct()


def page_activity(rows: DataFrame, watchlist: DataFrame) -> DataFrame:
    r = watched(rows.where(F.col("edit_type").isin(*S.COUNTED_TYPES)), watchlist)
    return r.groupBy("title", "category", S.hour(F.col("event_ts")).alias("hour")).agg(F.count("*").alias("edits"))


def top_activity(activity: DataFrame, n: int = 3000) -> DataFrame:
    return activity.orderBy(F.col("hour").desc(), F.col("edits").desc(), "title", "category").limit(n)


def page_averages(watchlist: DataFrame, activity: DataFrame, hours: DataFrame) -> DataFrame:
    """Total and average per recorded hour of each watched title, 0 if it has no edits; totals go by the title alone."""
    totals = activity.groupBy("title").agg(F.sum("edits").alias("_t"))
    n = hours.agg(F.greatest(F.count("*"), F.lit(1)).alias("_n"))
    out = watchlist.select("title", "category").join(totals, "title", "left").crossJoin(F.broadcast(n))  # one row
    total = F.coalesce("_t", F.lit(0))
    return out.select("title", "category", total.alias("total_edits"), F.bround(total / F.col("_n"), 3).alias("avg_edits_per_recorded_hour")).orderBy("title", "category").limit(100)


def page_hours(activity: DataFrame, hours: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Each watched title's edits in every recorded hour; hours and watched titles are capped reports of a few hundred rows."""
    grid = hours.crossJoin(F.broadcast(watchlist.select("title").distinct().orderBy("title").limit(100)))
    per = activity.groupBy("title", "hour").agg(F.sum("edits").alias("_e"))
    return grid.join(per, ["title", "hour"], "left").select("title", "hour", F.coalesce("_e", F.lit(0)).alias("edits"))


def pages_by_activity(averages: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.orderBy(F.col("total_edits").desc(), "title", "category"))  # at most 100 rows
    return averages.withColumn("place", rank)


def severity_summary(union: DataFrame) -> DataFrame:
    return union.groupBy("severity").agg(F.count("*").alias("alerts"), F.max("event_ts").alias("newest"))


#: Ranges that values are counted in, to find the few in which wanted places lie.
RANGES = 4096


def values_at(numbers: DataFrame, places: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One row: n, the greatest value, and the value at each place of the sorted whole numbers v (places from 0, computed from n).

    Exact, and no task takes all values: equal ones are counted where they are, then RANGES ranges, whose running sums name
    the ranges of the wanted places, then as many parts of each of those; only values of the parts found are ordered, which are
    whole numbers in 1 / RANGES^2 of the span: a far outlier doesn't bring all others together. Null values have no place.
    """
    counted = numbers.where("v is not null").groupBy("v").agg(F.count("*").alias("c"))
    ends = counted.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"))  # one row
    width = F.floor((F.col("high") - F.col("low")) / RANGES) + 1
    fine = F.floor(F.col("width") / RANGES) + 1
    ranged = counted.crossJoin(F.broadcast(ends.select("low", width.alias("width")))).withColumn("r", F.floor((F.col("v") - F.col("low")) / F.col("width")))
    ranged = ranged.select("v", "c", "r", F.floor((F.col("v") - F.col("low") - F.col("r") * F.col("width")) / fine).alias("part"))
    sums = ranged.groupBy("r").agg(F.sum("c").alias("c"))  # at most RANGES rows, so one task orders them
    sums = sums.withColumn("upto", F.sum("c").over(Window.orderBy("r"))).select("r", (F.col("upto") - F.col("c")).alias("below"), "upto")
    wanted = ends.select(F.explode(F.array(*(F.struct(F.lit(name).alias("name"), place(F.col("n")).cast("long").alias("place")) for name, place in places.items()))).alias("w")).select("w.*")
    holds = (F.col("place") >= F.col("below")) & (F.col("place") < F.col("upto"))
    inside = sums.join(F.broadcast(wanted), holds).select("name", "place", "r", "below")  # a row for each place
    # the same within each place's range
    parts = ranged.join(F.broadcast(inside), "r").groupBy("name", "place", "r", "below", "part").agg(F.sum("c").alias("c"))
    parts = parts.withColumn("upto", F.col("below") + F.sum("c").over(Window.partitionBy("name").orderBy("part"))).withColumn("below", F.col("upto") - F.col("c"))
    parts = parts.where(holds).select("name", "place", "r", "part", "below")
    near = ranged.join(F.broadcast(parts), ["r", "part"]).withColumn("until", F.col("below") + F.sum("c").over(Window.partitionBy("name").orderBy("v")))
    found = near.where(F.col("until") > F.col("place")).agg(*(F.min(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in places))
    return ends.select("n", F.col("high").alias("most")).crossJoin(F.broadcast(found))  # one row each


def _milliseconds(alerts: DataFrame) -> DataFrame:
    return alerts.select(F.timestamp_diff("MILLISECOND", F.col("event_ts"), F.col("detected_at")).alias("v"))


def _between(rank: float) -> dict[str, Callable[[Column], Column]]:
    """The places on both sides of an interpolated rank."""
    at = lambda n: F.greatest(n - 1, F.lit(0)) * F.lit(rank)
    return {f"below_{rank}": lambda n: F.floor(at(n)), f"above_{rank}": lambda n: F.ceil(at(n))}


def _interpolated(rank: float) -> Column:
    """Seconds at the rank, between the milliseconds on its two sides."""
    at = (F.col("n") - 1) * F.lit(rank)
    low, high = F.col(f"`below_{rank}`") / 1000, F.col(f"`above_{rank}`") / 1000
    return F.when(F.floor(at) == F.ceil(at), low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)


def detection_latency(alerts: DataFrame) -> DataFrame:
    """samples, p50, p95 of the seconds from event to detection of alerts that arrived on time; exact percentiles, 1 digit."""
    on_time = alerts.where(~S.arrived_late(F.col("ingested_at"), F.col("event_ts")))
    found = values_at(_milliseconds(on_time), _between(0.5) | _between(0.95))
    return found.select(F.col("n").alias("samples"), *(F.round(_interpolated(q), 1).alias(name) for name, q in (("p50", 0.5), ("p95", 0.95))))


def latency_summary(alerts: DataFrame) -> DataFrame:
    """Median, the value at place round(0.95 n) - 1 (half to even) of the sorted seconds, and the greatest, floored at 0."""
    floored = _milliseconds(alerts).select(F.greatest("v", F.lit(0)).alias("v"))
    found = values_at(floored, _between(0.5) | {"p95": lambda n: F.greatest(F.bround(F.lit(0.95) * n, 0).cast("long") - 1, F.lit(0))})
    return found.where("n > 0").select(_interpolated(0.5).alias("p50"), (F.col("most") / 1000).alias("max"), (F.col("p95") / 1000).alias("p95"))


def freshness(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    newest = lambda df, c, name: df.agg(F.max(c).alias(name))
    return newest(bronze, "ingested_at", "bronze").crossJoin(newest(silver, "event_ts", "silver")).crossJoin(newest(gold, "window_start", "gold"))


def funnel(bronze: DataFrame, dlq: DataFrame) -> DataFrame:
    """Rows and distinct ids of the raw layer, and rejected rows, with what was removed as duplicates."""
    b = bronze.agg(F.count("*").alias("bronze"), F.countDistinct("meta_id").alias("silver_unique"))
    return b.crossJoin(dlq.agg(F.count("*").alias("dlq")))


def funnel_steps(funnel_row: DataFrame) -> DataFrame:
    f = funnel_row.withColumn("received", F.col("bronze") + F.col("dlq"))
    top = F.greatest("received", "bronze", "silver_unique", "dlq")
    steps = F.stack(F.lit(4), *[x for c in ("received", "bronze", "silver_unique", "dlq") for x in (F.lit(c), F.col(c))]).alias("step", "rows")
    rows = f.select(steps, F.greatest(F.col("bronze") - F.col("silver_unique"), F.lit(0)).alias("duplicates_removed"), top.alias("_top"))
    return rows.select("step", "rows", "duplicates_removed", F.when(F.col("_top") > 0, F.col("rows") / F.col("_top")).otherwise(F.lit(0.0)).alias("share"))


def late_gap(final: DataFrame, realtime: DataFrame) -> DataFrame:
    """Edits of each window and wiki that the real-time view lacks."""
    r = realtime.select("window_start", "wiki", F.col("edits").alias("realtime_edits"))
    f = final.select("window_start", "wiki", F.col("edits").alias("final_edits"))
    return f.join(r, ["window_start", "wiki"], "full_outer").withColumn("missed", F.coalesce("final_edits", F.lit(0)) - F.coalesce("realtime_edits", F.lit(0)))


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that only one side has: side is missing (only expected) or unexpected (only actual)."""
    return expected.exceptAll(actual).withColumn("side", F.lit("missing")).unionByName(actual.exceptAll(expected).withColumn("side", F.lit("unexpected")))


def scenario(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Alerts (alert_id, rule_id, severity) by rule and severity: in both sets, only found (extra), only expected (missing). One set is
    as expected if extra and missing are 0 throughout; an alert that occurs twice is extra once."""
    side = lambda df, name: df.groupBy("alert_id", "rule_id", "severity").agg(F.count("*").alias(name))
    rows = side(expected, "e").join(side(found, "f"), ["alert_id", "rule_id", "severity"], "full_outer").na.fill(0, ["e", "f"])
    total = lambda c, name: F.sum(c).cast("long").alias(name)
    return rows.groupBy("rule_id", "severity").agg(
        total(F.least("e", "f"), "matched"), total(F.greatest(F.col("f") - F.col("e"), F.lit(0)), "extra"), total(F.greatest(F.col("e") - F.col("f"), F.lit(0)), "missing")
    )
