"""Explicit schemas; nothing is inferred."""

from __future__ import annotations

#: A decoded record of the stream.
RECORD = "kafka_key string, raw string, kafka_partition int, kafka_offset bigint, ingested_at timestamp_ntz"
WATCHLIST = "wiki string, title string, category string, owner_team string"
RULES = "rule_id string, rule_name string, severity string, min_removed_bytes bigint, min_removed_fraction decimal(10,4), min_edits int, window_minutes int, enabled boolean"
PROGRESS = (
    "session_id string, query string, run_id string, batch_id bigint, timestamp string, num_input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, trigger_ms bigint, add_batch_ms bigint, watermark string, "
    "sources array<struct<start_offset: string, end_offset: string, latest_offset: string>>, "
    "state_rows bigint, state_bytes bigint, state_dropped bigint, observed map<string, bigint>"
)
