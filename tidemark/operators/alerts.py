"""Alert rules over typed rows: one pass, whatever the number of rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def watched(rows: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Rows of watched pages in the article namespace, with category and owner. The watchlist is a seed file of at most a few
    thousand rows (a hundred are shown); Spark broadcasts it by its measured size."""
    return rows.where("namespace = 0").join(watchlist, ["wiki", "title"])


def rule_row(rules: DataFrame) -> DataFrame:
    """The rules table as one row: which rules are enabled, their severities and limits."""
    when = lambda rule, c: F.max(F.when(F.col("rule_id") == rule, F.col(c)))
    return rules.agg(
        *[F.bool_or((F.col("rule_id") == r) & F.col("enabled")).alias(f"{r.lower()}_enabled") for r in ("R1", "R2", "R3", "R4")],
        *[when(r, "severity").alias(f"{r.lower()}_severity") for r in ("R1", "R2", "R3", "R4")],
        when("R2", "min_removed_bytes").alias("r2_min_bytes"),
        when("R2", "min_removed_fraction").alias("r2_min_fraction"),
    )


def find_alerts(rows: DataFrame, watchlist: DataFrame, rules: DataFrame) -> DataFrame:
    """A row for each (edit, rule) that matches, with a deterministic alert_id. The rows are read once: each gives an array of
    its matching rules, which is exploded."""
    r = watched(rows, watchlist).crossJoin(F.broadcast(rule_row(rules)))  # one row
    r2, r3 = S.rule_r2(F.col("r2_min_bytes"), F.col("r2_min_fraction")), F.coalesce(S.rule_r3(), F.lit(False))
    severity = {"R1": F.col("r1_severity"), "R2": F.when(r3, "high").otherwise(F.col("r2_severity")), "R3": F.col("r3_severity"), "R4": F.col("r4_severity")}
    matches = {"R1": S.rule_r1(), "R2": r2, "R3": r3, "R4": S.rule_r4()}
    hits = F.array_compact(F.array(*[F.when(F.col(f"{k.lower()}_enabled") & m, F.struct(F.lit(k).alias("rule_id"), severity[k].alias("severity"))) for k, m in matches.items()]))
    found = r.withColumn("hit", F.explode(hits))
    return found.select(
        S.alert_id(F.col("hit.rule_id"), F.col("meta_id")).alias("alert_id"), "hit.rule_id", "hit.severity", "meta_id", "wiki", "title", "category", "owner_team",
        "edit_type", "log_action", "editor_type", "byte_delta", "revision_old", "revision_new", "event_ts", "ingested_at", "is_late",
    )


def reconcile(rows: DataFrame, watchlist: DataFrame, rules: DataFrame, alerts: DataFrame) -> DataFrame:
    """Matches without an alert, by a second implementation of the rules in SQL that shares nothing with find_alerts."""
    spark = rows.sparkSession
    return spark.sql(
        """
        WITH limits AS (
          SELECT bool_or(rule_id = 'R1' AND enabled) AS on1, bool_or(rule_id = 'R2' AND enabled) AS on2, bool_or(rule_id = 'R3' AND enabled) AS on3,
                 bool_or(rule_id = 'R4' AND enabled) AS on4, max(CASE WHEN rule_id = 'R2' THEN min_removed_bytes END) AS bytes,
                 max(CASE WHEN rule_id = 'R2' THEN min_removed_fraction END) AS part
          FROM {rules}
        ), judged AS (
          SELECT s.meta_id, stack(4,
            'R1', on1 AND edit_type = 'log' AND log_type IN ('delete', 'move') AND log_action IN ('delete', 'delete_redir', 'move', 'move_redir'),
            'R2', on2 AND edit_type = 'edit' AND editor_type <> 'bot'
                  AND (byte_delta <= -bytes OR (length_old > 0 AND CAST(length_old - length_new AS DECIMAL(20,4)) > part * length_old)),
            'R3', on3 AND edit_type IN ('edit', 'new') AND editor_type = 'unregistered',
            'R4', on4 AND edit_type = 'log' AND log_type = 'protect') AS (rule_id, hit)
          FROM {rows} s JOIN {watchlist} w ON s.wiki = w.wiki AND s.title = w.title CROSS JOIN limits
          WHERE s.namespace = 0
        )
        SELECT j.meta_id, j.rule_id FROM judged j LEFT ANTI JOIN {alerts} a ON a.meta_id = j.meta_id AND a.rule_id = j.rule_id WHERE j.hit
        """,
        rules=rules, rows=rows, watchlist=watchlist, alerts=alerts,
    )
