"""Merges, compaction, streams: repeats change nothing, nothing is lost."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalars as S
from tidemark.operators import documents, export, layers, maintenance, merge, privacy, reports
from tidemark.plans.pruning import unpruned
from tidemark.streaming import jobs
from tests.test_rules import NOON, event, typed


def test_appends_hold_what_a_set_would(spark, tmp_path):
    """Random batches with repeats, empty ones and ones that come again: the table is the set of all (key, hour) so far."""
    path, dice, want = f"file://{tmp_path}/table", random.Random(7), {}
    start = datetime(2026, 3, 1, 22)
    at = {f"k{i}": start + timedelta(minutes=dice.randrange(400)) for i in range(40)}
    for batch in [dice.choices(sorted(at), k=dice.randrange(1, 25)) for _ in range(5)] + [[]]:
        rows = spark.createDataFrame([(k, at[k], f"{k}-{n}") for n, k in enumerate(batch)], "meta_id string, event_ts timestamp_ntz, note string")
        for _ in range(2):
            assert merge.append_new(rows, path, "meta_id", ("note",), seen=F.lit(len(want))) == len(set(batch))
        for n, k in enumerate(batch):
            note = min(f"{k}-{m}" for m, other in enumerate(batch) if other == k)
            want.setdefault(k, note)
    got = spark.read.parquet(path)
    assert {r.meta_id: r.note for r in got.collect()} == want and got.count() == len(want)
    plan = merge.plan_append(merge.by_hour(rows.limit(0)), path, "meta_id")
    assert plan.sizes == {} and plan.commit() == 0
    plan = merge.plan_append(merge.by_hour(spark.createDataFrame([("k0", at["k0"], "x"), ("new", at["k0"], "x")], rows.schema)), path, "meta_id")
    assert [r.meta_id for r in plan.fresh.collect()] == (["new"] if "k0" in want else ["k0", "new"])
    assert not unpruned(plan.fresh, merge.HOUR)


def test_upsert_keeps_first_stamp(spark, tmp_path):
    path = f"file://{tmp_path}/bursts"
    frame = lambda *rows: spark.createDataFrame(rows, "alert_id string, edits int, seen int, day string")
    merge.upsert(frame(("a", 5, 1, "d1"), ("b", 5, 1, "d2")), path, ["alert_id"], "day", ("seen",))
    for _ in range(2):
        merge.upsert(frame(("b", 7, 2, "d2"), ("c", 6, 2, "d2")), path, ["alert_id"], "day", ("seen",))
    assert sorted(map(tuple, spark.read.parquet(path).select("alert_id", "edits", "seen").collect())) == [("a", 5, 1), ("b", 7, 1), ("c", 6, 2)]


def test_compaction_spares_today(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(120).select("id", F.when(F.col("id") % 2 == 0, "2026-10-01").otherwise("2026-10-02").alias("day")).repartition(6).write.partitionBy("day").parquet(path)
    assert maintenance.compact(spark, path, "day", datetime(2026, 10, 2, 9)) == 1
    assert maintenance.compact(spark, path, "day", datetime(2026, 10, 2, 9)) == 0
    files = dict(spark.read.parquet(path).select("day", F.col("_metadata.file_path").alias("f")).distinct().groupBy("day").count().select(F.col("day").cast("string"), "count").collect())
    assert files["2026-10-01"] == 1 and files["2026-10-02"] == 6
    assert spark.read.parquet(path).count() == 120


def feed_files(spark, path, *events):
    spark.createDataFrame(list(events), schemas.RECORD).coalesce(1).write.mode("append").parquet(path)


def test_four_feeds(spark, tmp_path):
    """Duplicates count once, late rows are dropped, each window is written once, the flush row's own window never."""
    src, out, check = (f"file://{tmp_path}/{x}" for x in ("src", "out", "check"))
    at = lambda m, s: NOON + timedelta(minutes=m, seconds=s)
    a = event("a", old=1000, new=700, at=at(0, 10))
    feeds = [
        [a, a, event("b", bot=True, old=0, new=40, at=at(0, 50)), event("c", kind="log", at=at(0, 20)), event("d", wiki="dewiki", old=0, new=10, at=at(1, 30))],
        [event("e", old=0, new=10, at=at(5, 0))],
        [event("late", old=0, new=1, at=at(0, 40))],
        [event("f", old=0, new=1, at=at(10, 0))],
    ]
    for events in feeds:
        feed_files(spark, src, *events)
        stream = layers.to_silver(spark.readStream.schema(schemas.RECORD).parquet(src))
        jobs.finished(jobs.append_to(jobs.edits_per_minute(stream), out, check, "four_feeds"))
    got = sorted((r.window_start.minute, r.wiki, r.edits, r.bot_edits, r.bytes_changed) for r in spark.read.parquet(out).collect())
    assert got == [(0, "enwiki", 2, 1, 340), (1, "dewiki", 1, 0, 10), (5, "enwiki", 1, 0, 10)]


def test_minute_series_and_averages(spark):
    m = lambda x: NOON + timedelta(minutes=x)
    minutes = spark.createDataFrame([(m(0), 12, 9), (m(3), 4, None), (m(4), 5, 5)], "minute timestamp_ntz, final_edits long, realtime_edits long")
    got = [(r.minute.minute, r.final_edits, r.gap_from, r.gap_to) for r in reports.minute_series(minutes).orderBy("minute").collect()]
    assert got == [(0, 12, 9, 12), (1, None, None, None), (2, None, None, None), (3, 4, 0, 4), (4, 5, None, None)]
    w = spark.createDataFrame([("enwiki", "A", "product", "t"), ("enwiki", "B", "product", "t")], schemas.WATCHLIST)
    activity = spark.createDataFrame([("A", "product", NOON, 4)], "title string, category string, hour timestamp_ntz, edits long")
    hours = spark.createDataFrame([(NOON,), (m(60),)], "hour timestamp_ntz")
    assert [(r.title, r.total_edits, r.avg_edits_per_recorded_hour) for r in reports.page_averages(w, activity, hours).collect()] == [("A", 4, 2.0), ("B", 0, 0.0)]


GOOD_ALERT = {
    "alert_id": "a" * 64, "rule_id": "R1", "rule_name": "n", "severity": "high", "wiki": "enwiki", "title": "T", "category": "product", "owner_team": "t", "edit_type": None, "log_action": None,
    "editor_type": "bot", "byte_delta": None, "edits_in_window": 3, "event_ts": "2026-10-03T12:00:00Z", "detected_at": "2026-10-03T12:00:00Z",
}
GOOD_ALERTS = {"schema_version": 1, "generated_at": "2026-10-03T12:00:00Z", "window_days": 7, "alerts": [GOOD_ALERT, GOOD_ALERT | {"arrived_late": None}], "digest": []}
GOOD_META = {
    "schema_version": 1, "generated_at": "2026-10-03T12:00:00Z", "dbt": {"status": "unknown", "finished_at": None, "models_ok": 0, "tests_ok": 0, "failures": 0},
    "snapshots": {"alerts": 1, "digest": 0, "edits_per_min": None, "bot_share_hourly": None, "page_activity": None},
    "exports": {"alerts": {"status": "ok", "failed_query": None}, "baseline": {"status": "failed", "failed_query": "edits_per_min"}},
}
GOOD_BASELINE = {"schema_version": 1, "generated_at": "2026-10-03T12:00:00Z", "edits_per_min": [], "bot_share_hourly": [{"hour": "2026-10-03T12:00:00Z", "edits": 1, "bot_edits": 1, "bot_share": 1.0}], "recorded_hours": ["2026-10-03T12:00:00Z"], "page_activity": [], "page_averages": []}
BROKEN = [
    ("alerts", GOOD_ALERTS, {}), ("meta", GOOD_META, {}), ("baseline", GOOD_BASELINE, {}), ("meta", {k: v for k, v in GOOD_META.items() if k != "exports"}, {}),
    ("alerts", GOOD_ALERTS | {"user": "x"}, {"$: additionalProperties": 1}),
    ("alerts", GOOD_ALERTS | {"alerts": [GOOD_ALERT | {"user_name": "x", "severity": "urgent"}] * 3}, {"alerts[]: additionalProperties": 3, "alerts[].severity: enum": 3}),
    ("alerts", GOOD_ALERTS | {"alerts": [GOOD_ALERT] * 501}, {"alerts: maxItems": 1}),
    ("alerts", GOOD_ALERTS | {"alerts": [1, {k: v for k, v in GOOD_ALERT.items() if k != "title"}], "window_days": 8}, {"alerts[]: type": 1, "alerts[].title: required": 1, "window_days: const": 1}),
    ("alerts", GOOD_ALERTS | {"alerts": {}, "generated_at": "2026-10-03 12:00"}, {"alerts: type": 1, "generated_at: format": 1}),
    ("alerts", GOOD_ALERTS | {"alerts": [GOOD_ALERT | {"alert_id": "A" * 64, "edits_in_window": "3", "event_ts": "2026-13-03T12:00:00Z"}]}, {"alerts[].alert_id: pattern": 1, "alerts[].edits_in_window: type": 1, "alerts[].event_ts: format": 1}),
    ("baseline", GOOD_BASELINE | {"recorded_hours": ["2026-10-03T12:00:00Z", 3, "noon"], "bot_share_hourly": [{"hour": None, "edits": -1, "bot_edits": 1.5, "bot_share": 1.01}]}, {"recorded_hours[]: type": 1, "recorded_hours[]: format": 1, "bot_share_hourly[].hour: type": 1, "bot_share_hourly[].edits: minimum": 1, "bot_share_hourly[].bot_edits: type": 1, "bot_share_hourly[].bot_share: maximum": 1}),
    ("meta", GOOD_META | {"exports": {"alerts": {"status": "odd", "failed_query": "s3://bucket"}}, "dbt": None}, {"exports.baseline: required": 1, "exports.alerts.status: enum": 1, "exports.alerts.failed_query: pattern": 1, "dbt: type": 1}),
    ("meta", [1], {"$: type": 1}), ("meta", None, {"$: invalid_json": 1}),
]


def test_document_contracts(spark):
    for name, doc, want in BROKEN:
        texts = spark.createDataFrame([("{broken" if doc is None else json.dumps(doc),)], "json string")
        assert dict(map(tuple, documents.violations(texts, name).collect())) == want, (name, want)


def test_export_of_a_run_tells_of_failures(spark, tmp_path):
    """What can't be built or breaks its contract isn't written; the run's document is, and then the export raises."""
    paths = {name: f"file://{tmp_path}/{name}" for name in ("alerts", "baseline", "meta")}
    doc = lambda body: spark.createDataFrame([(json.dumps(body),)], "json string")
    run, now = spark.sql("SELECT 'success' AS status, 3L AS models_ok, 2L AS tests_ok, 0L AS failures"), F.lit("2026-10-03 12:00:00").cast("timestamp_ntz")
    meta = lambda: json.loads(spark.read.text(paths["meta"]).first()[0])
    lengths = export.export_run(spark, {"alerts": lambda: doc(GOOD_ALERTS), "baseline": lambda: doc(GOOD_BASELINE)}, paths, run, now)
    assert lengths == {"alerts": {"alerts": 2, "digest": 0}, "baseline": {"edits_per_min": 0, "bot_share_hourly": 1, "page_activity": 0}}
    assert meta()["exports"]["alerts"] == {"status": "ok", "failed_query": None} and meta()["snapshots"]["alerts"] == 2
    with pytest.raises(export.ExportFailed, match="alerts, baseline"):
        export.export_run(spark, {"alerts": lambda: doc(GOOD_ALERTS | {"extra": 1}), "baseline": lambda: doc(GOOD_BASELINE).select(F.raise_error(F.lit("secret")).alias("json"))}, paths, run, now)
    assert meta()["exports"] == {"alerts": {"status": "failed", "failed_query": None}, "baseline": {"status": "failed", "failed_query": "baseline"}}
    assert meta()["snapshots"]["alerts"] is None and json.loads(spark.read.text(paths["alerts"]).first()[0]) == GOOD_ALERTS
    with pytest.raises(export.BrokenContract, match="bytes"):
        export.publish(doc(GOOD_ALERTS | {"alerts": [GOOD_ALERT | {"title": "t" * 1_000_000}]}), "alerts", paths["alerts"])


@pytest.mark.parametrize("spread", [1, 7, 10_000_019])
def test_values_at_places(spark, spread):
    dice = random.Random(spread)
    numbers = [dice.randrange(0, 50) * spread - 20 * spread for _ in range(301)] + [dice.randrange(10**9) for _ in range(5 * (spread > 7))]
    places = {"first": lambda n: n * 0, "p50": lambda n: F.floor(n / 2), "p95": lambda n: F.floor(n * 0.95), "last": lambda n: n - 1}
    got = reports.values_at(spark.createDataFrame([(v,) for v in [*numbers, None]], "v long").repartition(3), places).first().asDict()
    want, n = sorted(numbers), len(numbers)
    assert got == {"n": n, "most": want[-1], "first": want[0], "p50": want[n // 2], "p95": want[int(n * 0.95)], "last": want[-1]}
    assert reports.values_at(spark.createDataFrame([], "v long"), places).first().asDict() == {"n": 0, "most": None, "first": None, "p50": None, "p95": None, "last": None}


def test_pseudonyms_stay_distinct(spark):
    names = spark.range(50_000).select(F.concat(F.lit("~2026-"), F.col("id").cast("string"), F.lit("-1")).alias("u"))
    out = names.select(privacy.pseudonym(F.col("u"), F.lit(False), "salt").alias("p"))
    assert out.distinct().count() == 50_000 and out.where(~F.col("p").rlike(S.TEMPORARY_ACCOUNT)).isEmpty()


def test_few_files_for_each_hour(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/silver"
    rows = spark.range(3000).select(F.col("id").cast("string").alias("meta_id"), (F.lit(NOON).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") % 3).cast("int"))).alias("event_ts")).repartition(8)
    monkeypatch.setattr(merge, "ROWS_A_FILE", 400)
    assert merge.append_new(rows.where("event_ts < timestamp_ntz'2026-10-03 14:00:00'"), path, "meta_id", ()) == 2000
    files = spark.read.parquet(path).select("event_hour", F.col("_metadata.file_path").alias("f")).distinct().groupBy("event_hour").count()
    assert {r["count"] for r in files.collect()} <= {1, 2, 3} and spark.read.parquet(path).count() == 2000
    monkeypatch.setattr(merge, "ROWS_A_FILE", 10_000)
    assert merge.append_new(rows, path, "meta_id", ()) == 3000 and spark.read.parquet(path).count() == 3000
