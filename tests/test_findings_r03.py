"""The findings of round 3, each on rows that showed it."""

from __future__ import annotations

import json
import re
from datetime import timedelta

import duckdb
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.test_rules import NOON, event
from tidemark import catalog, schemas
from tidemark.catalog import batch, streams  # noqa: F401
from tidemark.catalog.model import Run
from tidemark.operators import contract, export, warehouse
from tidemark.operators.layers import to_silver
from tidemark.sources import feed, readers
from tidemark.streaming import jobs


def test_alerts_of_one_second_are_newest_first(spark):
    """the document's order is that of the whole time, not of its seconds."""
    times = {"a": 100, "b": 300, "c": 200}  # microseconds within one second
    rows = [(i, "medium", NOON + timedelta(microseconds=u)) for i, u in times.items()]
    top = spark.createDataFrame(rows, "alert_id string, severity string, event_ts timestamp_ntz").withColumn("detected_at", F.col("event_ts"))
    top = top.withColumns({c: F.lit(None).cast("string") for c in export.ALERT_FIELDS if c not in top.columns})
    digest = spark.createDataFrame([], "digest_date date, wiki string, title string, edits long, owner_team string")
    doc = export.alerts_document(top, digest, F.lit(NOON).cast("timestamp_ntz")).first()
    assert [x["alert_id"] for x in json.loads(doc.json)["alerts"]] == ["b", "c", "a"]


def test_a_row_is_late_when_its_window_is(spark, tmp_path):
    """F2 to F4: a row behind the watermark counts while its window is open; one of a closed window doesn't."""
    src, out, check = (f"file://{tmp_path}/{x}" for x in ("src", "out", "check"))
    at = lambda m, s: NOON + timedelta(minutes=m, seconds=s)
    feeds = [
        [event("a", old=0, new=1, at=at(3, 20)), event("b", old=0, new=1, at=at(5, 30))],  # the watermark is then 3:30
        [event("open", old=0, new=1, at=at(3, 10)), event("a", old=0, new=1, at=at(3, 20)), event("closed", old=0, new=1, at=at(2, 50))],
        [event("flush", old=0, new=1, at=at(20, 0))],
    ]
    for events in feeds:
        spark.createDataFrame(events, schemas.RECORD).coalesce(1).write.mode("append").parquet(src)
        jobs.finished(jobs.append_to(jobs.edits_per_minute(to_silver(readers.event_stream(spark, src))), out, check, "late"))
    assert sorted((r.window_start.minute, r.edits) for r in spark.read.parquet(out).collect()) == [(3, 2), (5, 1)]


def test_replay_of_ids_that_do_not_follow_time(spark, tmp_path):
    """F2 to F4: the second half of the ids has the times of the first again."""
    e = spark.read.parquet(f"{SMALL}/events.parquet").where("event_id < 400")
    e.unionByName(e.withColumn("event_id", F.col("event_id") + 400)).coalesce(1).write.parquet(f"file://{tmp_path}/events.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    for name in ("stream_watermark", "two_phase_replay"):
        want = db.execute(f"SELECT * FROM ({catalog.ORACLES[name]}) ORDER BY ALL").fetchall()
        got = catalog.QUERIES[name](spark, f"file://{tmp_path}")
        columns = ["window_start", "wiki", "edits"] if name == "stream_watermark" else ["edits", "all_edits"]
        assert sorted(map(tuple, got.select(*columns).collect())) == want


def test_the_contract_compiles(spark, tmp_path, capfd):
    """F8: the JVM leaves methods of over 8,000 bytes uncompiled; all checks of a payload are one."""
    rows = spark.createDataFrame([("{}",)], "raw string")
    rows.write.parquet(f"file://{tmp_path}/raw")
    capfd.readouterr()
    contract.routed(spark.read.parquet(f"file://{tmp_path}/raw")).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capfd.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_a_batch_has_a_file_for_each_core(spark):
    """F5, F6, F8, F10, F12: batches of one or two files kept one or two cores busy, whatever their number."""
    run = Run(spark, SMALL)
    path = streams._files(run, run.topic, "topic", 2)
    files = spark.read.parquet(path).select("_metadata.file_path").distinct().count()
    assert files == 2 * spark.sparkContext.defaultParallelism


def test_the_last_hour_of_no_events(spark, tmp_path):
    """the last hour is that of the table, which a feed without events doesn't make."""
    spark.read.parquet(f"{SMALL}/events.parquet").limit(0).write.parquet(f"file://{tmp_path}/events.parquet")
    assert catalog.QUERIES["hour_filter"](spark, f"file://{tmp_path}").count() == 0


def event_text(**changed):
    usual = {"meta": {"id": "a", "dt": "2026-01-01T00:00:00Z"}, "type": "edit", "namespace": 0, "title": "T", "wiki": "enwiki", "length": {"old": None, "new": 2}}
    return json.dumps({k: v for k, v in (usual | changed).items() if v is not ...})


def test_valid_events_are_told_by_their_whole_type(spark):
    """no field of a usual event is looked at alone; what isn't usual is judged as before, valid or not."""
    events = {
        event_text(): None, event_text(user="u", log_type=None, timestamp=1): None, event_text(other=1): None, event_text(**{"bot: BOOLEAN, user": "x"}): None, event_text(title=""): "title: minLength",
        event_text(length={"new": 1.5}): "length.new: type", event_text(bot=None): "bot: type", event_text(wiki="en-wiki"): "wiki: pattern", event_text(title=...): "title: required", event_text(type="x"): "type: enum",
        event_text(meta={"id": "", "dt": "x"}): "meta.id: minLength", "{": "invalid_json", "[]": "not_an_object",
    }
    rows = spark.createDataFrame([(raw,) for raw in events], "raw string")
    assert {r.raw: r.reason for r in contract.with_reason(rows).collect()} == events
    typed = rows.withColumn("_v", F.try_parse_json("raw")).withColumn("_k_", F.schema_of_variant("_v"))
    typed = typed.withColumns({f"_t_{contract._name(f)}": F.try_variant_get("_v", f"$.{f}", "string") for f in contract._TEXTS})
    assert {r.raw for r in typed.where(contract._usual()).collect()} == set(list(events)[:2])


def test_a_payload_is_made_and_parsed_once(spark):
    """the filter on ids and times parsed it again, twice, and had the feed made again for it."""
    plan = to_silver(Run(spark, SMALL).topic)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    plan = Run(spark, SMALL).dlq._jdf.queryExecution().optimizedPlan().toString()
    assert all("StructsToJson" not in line for line in plan.splitlines() if "+- Filter" in line)


def test_the_feed_is_made_on_all_cores(spark):
    """one file of one row group kept one core busy."""
    tasks = Run(spark, SMALL).topic.select(F.spark_partition_id().alias("p"), "kafka_offset").where("p >= 0").distinct().select("p").distinct().count()
    assert tasks >= spark.sparkContext.defaultParallelism


def test_events_written_as_usual_are_valid_by_their_fields(spark):
    """no type is looked for in a text that its own fields give when written; any other text goes through the checks of types."""
    usual = {"meta": {"id": "a", "dt": "x", "domain": "d"}, "type": "edit", "namespace": 0, "title": 'T "é\\', "wiki": "enwiki", "bot": False, "length": {"new": 2}, "revision": {}}
    text = lambda **changed: json.dumps({k: v for k, v in (usual | changed).items() if v is not ...}, separators=(",", ":"), ensure_ascii=False)
    plain = [text(), text(length=...), text(meta={"id": "a", "dt": "x"})]
    others = {
        json.dumps(usual): None, text(other=1): None, text(log_type=None): None, text().replace('"bot":false', '"bot":false,"bot":false'): "invalid_json", text(bot="false"): "bot: type", text(title=1): "title: type",
        text(title=""): "title: minLength", text(title=...): "title: required", text(namespace="0"): "namespace: type", text(namespace=0.5): "namespace: type", text(length={"new": "2"}): "length.new: type", text(length=None): "length: type",
        text(type="x"): "type: enum", text(wiki="en-wiki"): "wiki: pattern", text(meta={"id": "", "dt": "x"}): "meta.id: minLength", text(meta={"id": "a"}): "meta.dt: required", "null": "not_an_object", "{": "invalid_json",
    }
    rows = spark.createDataFrame([(raw,) for raw in [*plain, *others]], "raw string")
    assert {r.raw for r in contract._opened(rows, "raw").where(contract._plain()).collect()} == set(plain)
    assert {r.raw: r.reason for r in contract.with_reason(rows).collect()} == dict.fromkeys(plain) | others
    canaries = spark.createDataFrame([(text(meta={"id": "a", "dt": "x", "domain": "canary"}),), (json.dumps({"meta": {"domain": "canary"}}),), (text(),), (text(meta=...),)], "raw string")
    assert sorted(str(r.reason) for r in contract.routed(canaries).collect()) == ["None", "meta: required"]


def test_a_run_makes_its_log_and_bursts_once(spark, monkeypatch):
    """the health document wrote the log of progress twice, and each use of the bursts read the typed layer again."""
    made, recent = [], batch._recent
    monkeypatch.setattr(batch, "_recent", lambda *args: made.append(args) or recent(*args))
    run = Run(spark, SMALL, stored=True)
    batch._health(run)
    assert len(made) == 1
    assert run.bursts is run.bursts and "/bursts-" in run.bursts.inputFiles()[0]


def test_a_records_key_is_its_producers(spark):
    """the key was looked for in the payload, which took two more passes over it; the id is the only thing that is."""
    run = Run(spark, SMALL)
    assert run.bronze._jdf.queryExecution().optimizedPlan().toString().count("get_json_object(raw") == 1
    told = F.concat(F.get_json_object("raw", "$.wiki"), F.lit(":"), F.get_json_object("raw", "$.title"))
    rows = feed.topic(spark, SMALL, ("base", "copy", "bad", "broken", "canary"))
    assert rows.where(~told.eqNullSafe(F.col("kafka_key"))).count() == 0


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    """all rows of a day went to one task, whatever their number."""
    rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("alert_id"), F.lit(NOON).cast("timestamp_ntz").alias("event_ts"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        warehouse.store(rows, f"file://{tmp_path}/house", "alerts")
    finally:
        spark.conf.set(size, before)
    stored = spark.read.parquet(f"file://{tmp_path}/house/alerts")
    assert stored.count() == 200_000 and len(stored.inputFiles()) > 1
