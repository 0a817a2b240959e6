"""Registered queries against their SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from tests.conftest import SMALL
from tidemark import catalog
from tidemark.catalog import batch, streams  # noqa: F401

#: One of each kind here; the driver compares all of them.
NAMES = [
    "to_silver", "contract_reason", "rules_union", "burst_alerts", "daily_digest", "edits_per_min_final", "full_outer_minutes", "minute_gap_fill", "detection_latency", "latency_summary",
    "sink_insert_only_merge", "dq_bronze_complete", "set_diff", "change_link", "streaming_stats", "stream_edits_per_min", "export_alerts", "contains_ip",
    "sink_append", "record_filter", "pseudonymise", "ingest_stats", "sink_overwrite_ref", "detection_sketch", "offset_gaps", "alert_scenario", "dq_rules_seed", "cross_rule_params", "dq_snapshot_contract", "export_meta", "export_isolated", "sink_snapshot_json", "stream_silver",
]


def plain(rows):
    def one(v):
        return None if v is None or (isinstance(v, float) and math.isnan(v)) else round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted((tuple(map(one, r)) for r in rows), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    db = duckdb.connect()
    for file in os.listdir(SMALL):
        db.sql(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SMALL}/{file}'")
    want = db.sql(catalog.ORACLES[name])
    got = catalog.QUERIES[name](spark, SMALL)
    assert sorted(want.columns) == sorted(got.columns)
    columns = sorted(want.columns)
    assert plain(got.select(*[f"`{c}`" for c in columns]).collect()) == plain(want.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry_imports():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
