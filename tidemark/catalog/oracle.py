"""The model of change events in DuckDB SQL, written independently of the Spark jobs."""

from __future__ import annotations

import re

VIEWS = {
    "ev": """
  SELECT event_id, 'ev-' || event_id AS meta_id, ts AS event_ts, ts + to_minutes(CAST(event_id % 13 AS BIGINT)) AS ingested_at,
    CASE WHEN k % 4 = 3 THEN 'dewiki' ELSE 'enwiki' END AS wiki, 'Page ' || (k % 8) AS title, CAST(CASE WHEN user_id % 6 = 5 THEN 1 ELSE 0 END AS INTEGER) AS namespace,
    CASE event_type WHEN 'signup' THEN 'new' WHEN 'error' THEN 'log' ELSE 'edit' END AS edit_type,
    CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 2 THEN 'move' WHEN 3 THEN 'protect' ELSE 'delete' END END AS log_type,
    CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'delete' WHEN 1 THEN 'restore' WHEN 2 THEN 'move' ELSE 'modify' END END AS log_action,
    CASE user_id % 10 WHEN 0 THEN '192.0.2.' || (user_id % 250) WHEN 1 THEN '~2026-' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '-01' ELSE 'Editor-' || user_id END AS user_raw,
    user_id % 7 = 0 AS is_bot,
    CAST(CASE WHEN event_type NOT IN ('signup', 'error') THEN 1000 + 100 * k END AS BIGINT) AS length_old,
    CAST(CASE WHEN event_type = 'signup' THEN floor(10 * value) WHEN event_type <> 'error' THEN greatest(0, 1500 + 100 * k - floor(8 * value)) END AS BIGINT) AS length_new,
    CASE WHEN event_type NOT IN ('signup', 'error') THEN event_id END AS revision_old,
    CASE WHEN event_type <> 'error' THEN event_id + 1 END AS revision_new
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
    "silver": """
  SELECT event_id, meta_id, event_ts, ingested_at, wiki, title, namespace, edit_type, log_type, log_action,
    CASE WHEN user_raw LIKE '192.0.2.%' THEN NULL ELSE user_raw END AS user_name, is_bot,
    CASE WHEN is_bot THEN 'bot' WHEN user_raw LIKE '192.0.2.%' OR user_raw LIKE '~2026-%' THEN 'unregistered' ELSE 'registered' END AS editor_type,
    length_old, length_new,
    CASE WHEN length_old IS NOT NULL AND length_new IS NOT NULL THEN length_new - length_old WHEN edit_type = 'new' THEN length_new END AS byte_delta,
    revision_old, revision_new, date_diff('minute', date_trunc('minute', event_ts), date_trunc('minute', ingested_at)) > 10 AS is_late
  FROM ev""",
    "received": """
  SELECT event_id, 'base' AS kind, meta_id, wiki, title, ingested_at FROM ev
  UNION ALL SELECT event_id, 'copy', meta_id, wiki, title, ingested_at + INTERVAL 1 MINUTE FROM ev WHERE event_id % 100 = 99
  UNION ALL SELECT event_id, 'bad', 'bad-' || event_id, wiki, NULL, ingested_at FROM ev WHERE event_id % 211 = 0
  UNION ALL SELECT event_id, 'broken', NULL, NULL, NULL, ingested_at FROM ev WHERE event_id % 307 = 0
  UNION ALL SELECT event_id, 'canary', 'canary-' || event_id, wiki, title, ingested_at FROM ev WHERE event_id % 503 = 0""",
    "topic": """
  SELECT meta_id, wiki || ':' || title AS kafka_key, kind, ingested_at, CAST(event_id % 6 AS INTEGER) AS kafka_partition,
    CAST(row_number() OVER (PARTITION BY event_id % 6 ORDER BY kind = 'copy', event_id) - 1 AS BIGINT) AS kafka_offset
  FROM received WHERE kind IN ('base', 'copy')""",
    "watch": "SELECT * FROM (VALUES ('enwiki', 'Page 0', 'own_brand', 'team-a'), ('enwiki', 'Page 1', 'product', 'team-b'), ('enwiki', 'Page 2', 'product', 'team-b'), ('enwiki', 'Page 4', 'competitor', 'team-c'), ('enwiki', 'Page 3', 'competitor', 'team-c')) t(wiki, title, category, owner_team)",
    "rules": "SELECT * FROM (VALUES ('R1', 'Page deleted or moved', 'high'), ('R2', 'Large removal', 'medium'), ('R3', 'Unregistered editor', 'low'), ('R4', 'Protection change', 'low'), ('R5', 'Edit burst', 'medium')) t(rule_id, rule_name, severity)",
    "watched": "SELECT s.*, w.category, w.owner_team FROM silver s JOIN watch w ON s.wiki = w.wiki AND s.title = w.title WHERE s.namespace = 0",
    "hits": """
  SELECT 'R1' AS rule_id, * FROM watched WHERE edit_type = 'log' AND log_type IN ('delete', 'move') AND log_action IN ('delete', 'delete_redir', 'move', 'move_redir')
  UNION ALL SELECT 'R2', * FROM watched WHERE edit_type = 'edit' AND editor_type <> 'bot' AND (byte_delta <= -2000 OR (length_old > 0 AND 10 * (length_old - length_new) > 2 * length_old))
  UNION ALL SELECT 'R3', * FROM watched WHERE edit_type IN ('edit', 'new') AND editor_type = 'unregistered'
  UNION ALL SELECT 'R4', * FROM watched WHERE edit_type = 'log' AND log_type = 'protect'""",
    "alerts": """
  SELECT sha256(h.rule_id || ':' || meta_id) AS alert_id, h.rule_id,
    CASE WHEN h.rule_id = 'R2' AND editor_type = 'unregistered' THEN 'high' ELSE r.severity END AS severity, event_id, meta_id, wiki, title, category, owner_team, edit_type,
    log_action, editor_type, byte_delta, revision_old, revision_new, event_ts, ingested_at, is_late, ingested_at + to_milliseconds(CAST(1500 * (event_id % 7) AS BIGINT)) AS detected_at
  FROM hits h JOIN rules r ON h.rule_id = r.rule_id""",
    "bursts": """
  SELECT sha256('R5:' || wiki || ':' || title || ':' || strftime(window_start, '%Y-%m-%dT%H:%M:%S')) AS alert_id, 'R5' AS rule_id, 'medium' AS severity, wiki, title, category, owner_team,
    window_start, window_start + INTERVAL 10 MINUTE AS window_end, count(*) AS edits, min(event_ts) AS first_edit_ts, max(event_ts) AS last_edit_ts
  FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, event_ts) AS window_start FROM watched WHERE edit_type IN ('edit', 'new'))
  GROUP BY wiki, title, category, owner_team, window_start HAVING count(*) >= 2""",
    "minutes": """
  SELECT date_trunc('minute', event_ts) AS window_start, wiki, count(*) AS edits, count(*) FILTER (WHERE is_bot) AS bot_edits, CAST(coalesce(sum(abs(byte_delta)), 0) AS BIGINT) AS bytes_changed,
    date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end
  FROM silver WHERE edit_type IN ('edit', 'new') GROUP BY 1, 2, 6""",
    "realtime": """
  SELECT date_trunc('minute', event_ts) AS window_start, wiki, count(*) AS edits FROM silver WHERE edit_type IN ('edit', 'new') AND NOT is_late GROUP BY 1, 2""",
    "hourly": """
  SELECT date_trunc('hour', event_ts) AS hour_start, wiki, count(*) AS edits, count(*) FILTER (WHERE is_bot) AS bot_edits, count(*) FILTER (WHERE NOT is_bot) AS human_edits,
    CAST(count(*) FILTER (WHERE is_bot) AS DOUBLE) / count(*) AS bot_share
  FROM silver WHERE edit_type IN ('edit', 'new') GROUP BY 1, 2""",
    "activity": """
  SELECT CAST(event_ts AS DATE) AS digest_date, wiki, title, category, owner_team, count(*) FILTER (WHERE edit_type IN ('edit', 'new')) AS edits, count(*) FILTER (WHERE edit_type = 'log') AS log_events,
    CAST(coalesce(sum(byte_delta), 0) AS BIGINT) AS net_bytes, count(*) FILTER (WHERE edit_type <> 'log' AND editor_type = 'registered') AS registered_edits,
    count(*) FILTER (WHERE edit_type <> 'log' AND editor_type = 'unregistered') AS unregistered_edits, count(*) FILTER (WHERE edit_type <> 'log' AND editor_type = 'bot') AS bot_edits
  FROM watched GROUP BY 1, 2, 3, 4, 5""",
    "ruledays": """
  SELECT CAST(event_ts AS DATE) AS digest_date, wiki, title, count(*) FILTER (WHERE rule_id = 'R1') AS r1_alerts, count(*) FILTER (WHERE rule_id = 'R2') AS r2_alerts,
    count(*) FILTER (WHERE rule_id = 'R3') AS r3_alerts, count(*) FILTER (WHERE rule_id = 'R4') AS r4_alerts FROM alerts GROUP BY 1, 2, 3""",
    "burstdays": "SELECT CAST(window_start AS DATE) AS digest_date, wiki, title, count(*) AS r5_alerts FROM bursts GROUP BY 1, 2, 3",
    "digest": """
  SELECT a.*, coalesce(r1_alerts, 0) AS r1_alerts, coalesce(r2_alerts, 0) AS r2_alerts, coalesce(r3_alerts, 0) AS r3_alerts, coalesce(r4_alerts, 0) AS r4_alerts, coalesce(r5_alerts, 0) AS r5_alerts
  FROM activity a LEFT JOIN ruledays USING (digest_date, wiki, title) LEFT JOIN burstdays USING (digest_date, wiki, title)""",
    "run": "SELECT date_trunc('second', max(ingested_at)) AS now FROM ev",
    "allalerts": """
  SELECT alert_id, a.rule_id, r.rule_name, a.severity, wiki, title, category, owner_team, edit_type, log_action, editor_type, byte_delta, CAST(NULL AS BIGINT) AS edits_in_window, event_ts, detected_at,
    revision_old, revision_new, ingested_at >= event_ts + INTERVAL 10 MINUTE AS arrived_late FROM alerts a JOIN rules r ON a.rule_id = r.rule_id
  UNION ALL SELECT alert_id, b.rule_id, r.rule_name, b.severity, wiki, title, category, owner_team, NULL, NULL, NULL, NULL, edits, window_start, window_end, NULL, NULL, NULL FROM bursts b JOIN rules r ON b.rule_id = r.rule_id""",
    "pages": """
  SELECT title, category, date_trunc('hour', event_ts) AS hour, count(*) AS edits FROM watched WHERE edit_type IN ('edit', 'new') GROUP BY 1, 2, 3""",
    "hours": "SELECT DISTINCT date_trunc('hour', window_start) AS hour FROM minutes",
    "bothours": """
  SELECT hour_start AS hour, CAST(sum(edits) AS BIGINT) AS edits, CAST(sum(bot_edits) AS BIGINT) AS bot_edits, round(CAST(sum(bot_edits) AS DOUBLE) / sum(edits), 4) AS bot_share FROM hourly GROUP BY 1""",
    "merged": """
  SELECT * FROM (SELECT coalesce(f.minute, r.minute) AS minute, f.edits AS final_edits, r.edits AS realtime_edits FROM
    (SELECT window_start AS minute, CAST(sum(edits) AS BIGINT) AS edits FROM minutes GROUP BY 1) f FULL JOIN (SELECT window_start AS minute, CAST(sum(edits) AS BIGINT) AS edits FROM realtime GROUP BY 1) r ON f.minute = r.minute)
  ORDER BY minute DESC LIMIT 400""",
}


def complete(sql: str) -> str:
    """The SELECT with the views that it needs before it."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in need and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need.append(name)
                visit(VIEWS[name])

    visit(sql)
    order = [n for n in VIEWS if n in need]
    if not order:
        return sql
    views = ",\n".join(f"v_{n} AS ({_named(VIEWS[n])})" for n in order)
    own = _named(sql).lstrip()
    return f"WITH {views}" + (f",\n{own[5:]}" if own.startswith("WITH ") else f"\n{own}")


def _named(text: str) -> str:
    """View names after FROM and JOIN get a prefix, as `pages` and others are tables of the driver too."""
    return re.sub(rf"\b(FROM|JOIN)\s+({'|'.join(VIEWS)})\b", r"\1 v_\2", text)
