"""Checks that return the rows which break them, seed contracts, and completeness of the raw layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def not_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values (or combinations) that occur more than once, with their counts. Nulls are ignored for a single column."""
    rows = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values) -> DataFrame:
    """Values outside the list, with counts; nulls pass."""
    return df.where(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def burst_window_errors(bursts: DataFrame, rules: DataFrame) -> DataFrame:
    """Bursts whose window is not as long as the rule says."""
    minutes = rules.where("rule_id = 'R5'").select("window_minutes")  # one row
    return bursts.crossJoin(F.broadcast(minutes)).where(F.col("window_end") != F.col("window_start") + F.make_dt_interval(mins="window_minutes"))


def watchlist_errors(watchlist: DataFrame) -> DataFrame:
    """problem, rows: duplicate pages, blank fields, unknown categories. No row for a good file."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    parts = [
        watchlist.groupBy("wiki", "title").count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit("duplicate page").alias("problem"), "n"),
        watchlist.where(blank("wiki") | blank("title") | blank("category") | blank("owner_team")).agg(F.count("*").alias("n")).select(F.lit("blank field").alias("problem"), "n"),
        watchlist.where(~F.coalesce(F.col("category").isin(*S.CATEGORIES), F.lit(False))).agg(F.count("*").alias("n")).select(F.lit("unknown category").alias("problem"), "n"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where("n > 0")


def rules_errors(rules: DataFrame) -> DataFrame:
    """problem, found: ids of R1 to R5 that don't occur just once, and rules with an unknown id, an unknown severity, no flag, a
    missing limit, or a window that doesn't divide an hour. No row for a good file."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    r2, r5 = F.col("rule_id") == "R2", F.col("rule_id") == "R5"
    divides = (F.col("window_minutes") > 0) & (F.lit(60) % F.nullif(F.col("window_minutes"), F.lit(0)) == 0)
    demands = {
        "unknown rule": no(F.col("rule_id").isin(*S.RULE_IDS)),
        "unknown severity": no(F.col("severity").isin(*S.SEVERITIES)),
        "enabled not set": F.col("enabled").isNull(),
        "R2 without limits": r2 & (F.col("min_removed_bytes").isNull() | F.col("min_removed_fraction").isNull()),
        "R5 without limits": r5 & (F.col("min_edits").isNull() | F.col("window_minutes").isNull()),
        "R5 window does not divide an hour": r5 & no(divides),
    }
    once = sum((F.when(F.count_if(F.col("rule_id") == r) != 1, 1).otherwise(0) for r in S.RULE_IDS), F.lit(0)).cast("long")
    counts = {"rule missing or repeated": once} | {name: F.count_if(F.coalesce(bad, F.lit(False))) for name, bad in demands.items()}
    one = rules.agg(*(c.alias(name) for name, c in counts.items()))
    return one.select(F.stack(F.lit(len(counts)), *[x for c in counts for x in (F.lit(c), F.col(f"`{c}`"))]).alias("problem", "found")).where("found > 0")


def offset_gaps(bronze: DataFrame) -> DataFrame:
    """For each partition: first, last, rows, distinct offsets, and whether offsets repeat or are missing."""
    o = bronze.groupBy("kafka_partition").agg(
        F.min("kafka_offset").alias("first"), F.max("kafka_offset").alias("last"), F.count("*").alias("rows"), F.countDistinct("kafka_offset").alias("distinct_offsets")
    )
    return o.withColumns({"repeats": F.col("rows") != F.col("distinct_offsets"), "gap": (F.col("first") != 0) | (F.col("distinct_offsets") != F.col("last") - F.col("first") + 1)})


def behind(offsets: DataFrame, highs: DataFrame, allowed: int) -> DataFrame:
    """Partitions (kafka_partition, high) that are missing, or more than `allowed` records behind."""
    found = highs.join(offsets.select("kafka_partition", "last"), "kafka_partition", "left")
    return found.withColumn("behind", F.col("high") - F.coalesce(F.col("last") + 1, F.lit(0))).where((F.col("behind") > allowed) | F.col("last").isNull())


def missing_ids(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Distinct ids of the raw layer that the typed layer lacks."""
    return bronze.where("meta_id is not null").select("meta_id").distinct().join(silver.select("meta_id"), "meta_id", "left_anti")


def duplicates(df: DataFrame, key: str = "meta_id") -> DataFrame:
    """rows - distinct keys."""
    return df.agg((F.count(key) - F.countDistinct(key)).alias("duplicates"))


def bronze_report(bronze: DataFrame, silver: DataFrame, highs: DataFrame, allowed: int = 0) -> DataFrame:
    """check, found, passed of all checks of the raw layer."""
    offsets = offset_gaps(bronze)
    checks = {
        "offset gaps": offsets.where("gap"),
        "repeated offsets": offsets.where("repeats"),
        "partitions behind": behind(offsets, highs, allowed),
        "ids not in the typed layer": missing_ids(bronze, silver),
        "repeated ids in the typed layer": not_unique(silver, "meta_id"),
    }
    out = None
    for name, rows in checks.items():
        own = rows.agg(F.count("*").alias("found")).select(F.lit(name).alias("check"), "found", (F.col("found") == 0).alias("passed"))
        out = own if out is None else out.unionByName(own)
    return out


def overlap_missing(ours: DataFrame, reference: DataFrame, margin_seconds: int = 60) -> DataFrame:
    """Reference ids inside the time both recordings cover, less a margin at each end, that ours lack. Both: id, ts."""
    ends = lambda df, p: df.agg(F.min("ts").alias(f"{p}_a"), F.max("ts").alias(f"{p}_b"))
    m = F.make_dt_interval(secs=F.lit(margin_seconds))
    span = ends(ours, "o").crossJoin(ends(reference, "r")).select((F.greatest("o_a", "r_a") + m).alias("_from"), (F.least("o_b", "r_b") - m).alias("_to"))
    inside = reference.crossJoin(F.broadcast(span)).where("ts between _from and _to").drop("_from", "_to")  # one row
    return inside.join(ours.select("id"), "id", "left_anti")


def alert_link_errors(exported: DataFrame, alerts: DataFrame) -> DataFrame:
    """Exported edit alerts whose revisions or late flag differ from the edit that raised them, or whose id no edit gives."""
    own = alerts.select(
        S.alert_id(F.col("rule_id"), F.col("meta_id")).alias("alert_id"), F.col("revision_old").alias("o"), F.col("revision_new").alias("n"), S.arrived_late(F.col("ingested_at"), F.col("event_ts")).alias("l"), F.lit(True).alias("known")
    )
    joined = exported.where("rule_id <> 'R5'").join(own, "alert_id", "left")
    same = F.col("revision_old").eqNullSafe(F.col("o")) & F.col("revision_new").eqNullSafe(F.col("n")) & F.col("arrived_late").eqNullSafe(F.col("l"))
    return joined.where(F.col("known").isNull() | ~same).select("alert_id", "rule_id")
