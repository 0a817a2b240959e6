"""The running system: records of batches, the flusher, the application, seeds, bounded batches, state."""

from __future__ import annotations

import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_rules import NOON, event
from tidemark import schemas
from tidemark.functions import scalars as S
from tidemark.operators.layers import to_silver
from tidemark.sources import feed, readers, seeds
from tidemark.streaming import application, jobs
from tidemark.streaming.progress import ProgressWriter, IngestReport, ProgressListener, json_files


def stamp():
    return F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")


def record(n, query="q", **observed):
    return {"session_id": "s", "query": query, "run_id": "r", "batch_id": n, "num_input_rows": n, "observed": observed}


def test_flusher_loses_and_doubles_nothing(spark, tmp_path):
    """A sink that fails before, in the middle of and after its write, and is slow: the streams go on, every record is there once."""
    path = f"file://{tmp_path}/log"
    listener, write, attempts = ProgressListener("s"), json_files(spark, path), []

    def unsteady(batch):
        attempts.append(batch.name)
        time.sleep(0.02)
        if len(attempts) % 3 == 1:
            raise OSError("before")
        write(batch)
        if len(attempts) % 3 == 2:
            raise OSError("after")

    flusher = ProgressWriter(listener, unsteady, 0.01, lambda: datetime(2026, 1, 2)).start()
    began = time.time()
    for n in range(200):
        listener.add(record(n))
        time.sleep(0.001)
    assert time.time() - began < 2  # adding never waits for the sink
    assert flusher.stop() == 0 and flusher.failures > 1 and flusher.written == 200
    rows = readers.progress_log(spark, path)
    assert sorted(r.batch_id for r in rows.collect()) == list(range(200)) and {str(r.dt) for r in rows.collect()} == {"2026-01-02"}


def test_flusher_keeps_what_cannot_be_written():
    listener = ProgressListener("s")

    def broken(batch):
        raise OSError

    flusher = ProgressWriter(listener, broken, 60)
    listener.add(record(1))
    assert flusher.flush() == 0 and flusher.flush() == 0 and flusher.stop() == 1
    flusher.write = lambda batch: None
    assert flusher.flush() == 1 and flusher.stop() == 0


def test_ingest_report_counts_batches_once():
    now = [0.0]
    report = IngestReport("ingest", lambda: now[0])
    now[0] = 10.0
    report.add([record(1, "ingest", rows=30, rejected=2), record(1, "ingest", rows=30, rejected=2), record(2, "other", rows=9)])
    assert report.report() == {"rows": 30, "rejected": 2, "events_per_second": 3.0}
    now[0] = 12.0
    assert report.add([record(2, "ingest", rows=5, rejected=1)]).report() == {"rows": 35, "rejected": 3, "events_per_second": 2.5}


def feed_of(spark, path, *events):
    spark.createDataFrame(list(events), schemas.RECORD).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def states(spark):
    """The session's state store settings, as they were before."""
    yield
    for name in application.STATE_STORE:
        spark.conf.unset(name)


def test_application_stops_all_when_one_fails_and_resumes(spark, tmp_path, states):
    """Rules that can't be read end the alerts; the others drain and end. With rules again, all go on where they were."""
    edits, dlq, root = (f"file://{tmp_path}/{x}" for x in ("edits", "dlq", "root"))
    feed_of(spark, edits, event("a", title="Page 0", kind="log", log=("delete", "delete")), event("b", old=0, new=5))
    feed_of(spark, dlq, event("x"))
    held = seeds.Reference("1", feed.watchlist(spark), feed.alert_rules(spark))

    def none():
        raise seeds.SeedError("no rules")

    settings = application.Settings(root, "s", {"processingTime": "100 milliseconds"}, 0.2)
    make = lambda reference: application.Application(spark, settings, lambda: readers.event_stream(spark, edits), lambda: readers.event_stream(spark, dlq), reference, stamp())
    app = make(none).start()
    with pytest.raises(application.QueryFailed) as failed:
        app.wait(60)
    assert failed.value.query == "page_alerts" and not [q for q in spark.streams.active if q.name in app.queries()]
    assert spark.read.parquet(app.path("silver")).count() == 2 and spark.read.parquet(app.path("bronze")).count() == 2
    feed_of(spark, edits, event("c", old=0, new=5))
    app = make(lambda: held).start()
    assert app.wait(1) is False and len(app.running) == 5
    assert app.stop() == 0
    assert sorted(r.meta_id for r in spark.read.parquet(app.path("silver")).collect()) == ["a", "b", "c"]
    assert spark.read.parquet(app.path("bronze")).count() == 3 and spark.read.parquet(app.path("dlq")).count() == 1
    assert [(r.rule_id, r.meta_id) for r in spark.read.parquet(app.path("alerts")).collect()] == [("R1", "a")]
    log = readers.progress_log(spark, app.path("progress"))
    assert {r[0] for r in log.select("query").distinct().collect()} == set(app.queries())
    assert log.where("query = 'bronze_edits'").agg(F.sum("num_input_rows")).first()[0] == 3


def test_state_is_in_rocksdb_and_falls_behind_the_watermark(spark, tmp_path, states):
    src, out, check = (f"file://{tmp_path}/{x}" for x in ("src", "out", "check"))
    for name, value in application.STATE_STORE.items():
        spark.conf.set(name, value)
    listener = ProgressListener("s")
    spark.streams.addListener(listener)
    try:
        for at, n in ((0, 40), (30, 1), (60, 1)):
            feed_of(spark, src, *(event(f"{at}-{i}", old=0, new=1, at=NOON + timedelta(minutes=at, seconds=i % 50)) for i in range(n)))
            jobs.finished(jobs.append_to(jobs.edits_per_minute(to_silver(readers.event_stream(spark, src))), out, check, "state"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    rows = [r["state_rows"] for r in listener.take()]
    assert max(rows) >= 40 and rows[-1] <= 4
    assert list((tmp_path / "check" / "state").rglob("*.changelog"))
    assert sum(r.edits for r in spark.read.parquet(out).collect()) == 41


def test_batches_are_bounded_by_bytes_and_files_archived(spark, tmp_path):
    src, out, check, old = (f"file://{tmp_path}/{x}" for x in ("src", "out", "check", "old"))
    for i in range(6):
        feed_of(spark, src, *(event(f"{i}-{k}") for k in range(20)))
    size = max(f.stat().st_size for f in (tmp_path / "src").glob("*.parquet"))
    listener = ProgressListener("s")
    spark.streams.addListener(listener)
    try:
        for _ in range(2):  # the second run finds nothing to read
            stream = readers.event_stream(spark, src, max_bytes=2 * size, archive=old)
            jobs.finished(jobs.append_to(stream, out, check, "bounded"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    batches = [r["num_input_rows"] for r in listener.take() if r["num_input_rows"]]
    assert sum(batches) == 120 and max(batches) <= 40 and len(batches) >= 3
    assert spark.read.parquet(out).count() == 120
    assert list((tmp_path / "old").rglob("*.parquet"))
    with pytest.raises(ValueError, match="bounded"):
        readers.event_stream(spark, src, max_files=1, max_bytes=1)


WATCH = "wiki,title,category,owner_team\nenwiki,A,product,t\nenwiki,B,competitor,t\n"
RULES = "rule_id,rule_name,severity,min_removed_bytes,min_removed_fraction,min_edits,window_minutes,enabled\nR1,n,high,,,,,true\nR2,n,medium,2000,0.2,,,true\nR3,n,low,,,,,false\nR4,n,low,,,,,true\nR5,n,medium,,,5,10,true\n"


@pytest.mark.parametrize(("watchlist", "rules"), [
    (WATCH + "enwiki,A,product,t\n", RULES), (WATCH + "enwiki,C,other,t\n", RULES), (WATCH + "enwiki,,product,t\n", RULES),
    (WATCH, RULES.replace("R4,", "R9,")), (WATCH, RULES.replace("high", "urgent")), (WATCH, RULES.replace("2000", "")), (WATCH, RULES.replace(",10,", ",7,")), (WATCH, RULES.replace("false", "")),
    (WATCH, RULES.replace("2000", "many")),
])
def test_a_bad_seed_changes_nothing(spark, tmp_path, watchlist, rules):
    root, files = f"file://{tmp_path}/root", tmp_path / "seeds"
    files.mkdir()
    for name, text in (("watchlist", WATCH), ("alert_rules", RULES)):
        (files / f"{name}.csv").write_text(text)
    assert seeds.load_if_empty(spark, f"file://{files}", root, "2026-01-01 00:00:00") == {"watchlist": 2, "alert_rules": 5}
    assert seeds.load_if_empty(spark, f"file://{files}", root, "2026-01-02 00:00:00") is None
    version = seeds.current(spark, root)
    (files / "watchlist.csv").write_text(watchlist)
    (files / "alert_rules.csv").write_text(rules)
    with pytest.raises(Exception, match=r"."):  # the reader's own error for a malformed row, else a SeedError
        seeds.load(spark, f"file://{files}", root, "2026-01-03 00:00:00")
    held = seeds.reference(spark, root)
    assert held.version == version == seeds.current(spark, root)
    assert sorted(r.title for r in held.watchlist.collect()) == ["A", "B"] and held.rules.count() == 5


def test_a_reader_keeps_one_version_during_a_swap(spark, tmp_path):
    root, files = f"file://{tmp_path}/root", tmp_path / "seeds"
    files.mkdir()

    def load(titles):
        (files / "watchlist.csv").write_text("wiki,title,category,owner_team\n" + "".join(f"enwiki,{t},product,t\n" for t in titles))
        (files / "alert_rules.csv").write_text(RULES if len(titles) == 1 else RULES.replace("2000", "3000"))
        seeds.load(spark, f"file://{files}", root, "2026-01-01 00:00:00")

    load("A")
    old = seeds.reference(spark, root)
    seen, done = set(), threading.Event()

    def read():
        while not done.is_set():
            held = seeds.reference(spark, root)
            seen.add((held.watchlist.count(), held.rules.where("rule_id = 'R2'").first().min_removed_bytes))

    reader = threading.Thread(target=read)
    reader.start()
    load("AB")
    load("A")
    done.set()
    reader.join()
    assert seen <= {(1, 2000), (2, 3000)} and old.watchlist.count() == 1
    with pytest.raises(seeds.SeedError):
        seeds.reference(spark, f"{root}-none")


def test_session_id_needs_something_safe(spark):
    make = lambda text: spark.createDataFrame([(text,)], "c string").select(S.session_id(F.col("c"))).first()[0]
    assert make("_cluster.0f/1e!") == "cluster-0f-1e"
    for text in ("", "...", "--", None):
        with pytest.raises(Exception, match="letter or digit"):
            make(text)


def test_extreme_lengths_decide_without_overflow(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    rows = spark.createDataFrame([(1, "edit", "registered", 5, low), (2, "edit", "registered", low, high), (3, "edit", "registered", 3000, 900)], "i int, edit_type string, editor_type string, length_old long, length_new long")
    rows = rows.withColumn("byte_delta", S.byte_delta(F.col("edit_type"), F.col("length_old"), F.col("length_new")))
    assert [r.byte_delta for r in rows.orderBy("i").collect()] == [None, None, -2100]
    edges = rows.withColumn("byte_delta", F.when(F.col("i") == 1, F.lit(low)).when(F.col("i") == 2, F.lit(high)).otherwise(-2000))
    fraction = F.lit("0.99").cast("decimal(10,4)")
    assert [r.i for r in edges.where(S.rule_r2(F.lit(2000).cast("long"), fraction)).orderBy("i").collect()] == [1, 3]
