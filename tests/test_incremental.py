"""Incremental models, plan audits, compaction, sketches by hour."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental, maintenance, merge, reports, sketches, warehouse
from tidemark.plans import pruning

START = datetime(2026, 5, 1)


def typed_layer(spark, path, rows):
    """rows (id, hours after START, amount) as a table by hours."""
    frame = spark.createDataFrame([(i, START + timedelta(hours=h), n) for i, h, n in rows], "id string, event_ts timestamp_ntz, amount long")
    merge.by_hour(frame).repartition(merge.HOUR).write.mode("overwrite").partitionBy(merge.HOUR).parquet(path)


def sums(rows):
    at = F.date_trunc("day", "event_ts").cast("timestamp_ntz")
    return rows.groupBy(at.alias("at"), (F.col("amount") % 3).alias("kind")).agg(F.sum("amount").alias("total"))


MODEL = incremental.Model(sums, ("at", "kind"), "at", "day", ("first_run",))


def test_lower_bound():
    now = datetime(2026, 5, 9, 13, 45)
    assert incremental.lower_bound(now, "hour") == datetime(2026, 5, 9, 7)
    assert incremental.lower_bound(now, "day") == datetime(2026, 5, 9)
    assert incremental.lower_bound(now, "day", first=True) == datetime(2026, 5, 2)
    assert incremental.lower_bound(now, "hour", since=datetime(2026, 5, 3, 4, 5)) == datetime(2026, 5, 3, 4)


def test_incremental_runs_equal_a_full_rebuild(spark, tmp_path):
    source, path, full, dice = f"file://{tmp_path}/typed", f"file://{tmp_path}/model", f"file://{tmp_path}/full", random.Random(3)
    rows = [(f"r{i}", dice.random() * 24 * 6, dice.randrange(100)) for i in range(300)]
    for day in range(1, 7):
        typed_layer(spark, source, [r for r in rows if r[1] < 24 * day])
        run_time = START + timedelta(hours=24 * day - 1)
        since = run_time - timedelta(hours=30) if day > 1 else None
        for again in range(2):
            found = incremental.refresh(spark, MODEL, source, path, run_time, since, first_run=F.lit(10 * day + again))
            assert found.exists == (day > 1 or again > 0)
            for scan in pruning.visit(found.rows, {"source": (source, merge.HOUR), "model": (path, "day")}):
                assert scan.bounded_by == ("literal",)
            found.commit()
    incremental.refresh(spark, MODEL, source, full, START + timedelta(days=6), START, first_run=F.lit(0)).commit()
    read = lambda p: {(r["at"], r.kind): r.total for r in spark.read.parquet(p).collect()}
    assert read(path) == read(full) and len(read(path)) == 18
    # what came first stays: no row has the stamp of a run that only repeated it
    stamps = {(r["at"], r.first_run) for r in spark.read.parquet(path).collect()}
    assert {s for _, s in stamps} == {10 * d for d in range(1, 7)}


def test_days_before_the_bound_are_not_touched(spark, tmp_path):
    source, path = f"file://{tmp_path}/typed", f"file://{tmp_path}/model"
    typed_layer(spark, source, [(f"r{h}", h, h) for h in range(0, 96, 3)])
    incremental.refresh(spark, MODEL, source, path, START + timedelta(days=4), START, first_run=F.lit(1)).commit()
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "model").rglob("*.parquet") if p.parent.name < "day=2026-05-04"}
    before = files()
    incremental.refresh(spark, MODEL, source, path, START + timedelta(days=3, hours=9), first_run=F.lit(2)).commit()
    assert files() == before and len(before) >= 3
    # nothing in the bounds: nothing to do
    incremental.refresh(spark, MODEL, source, path, START + timedelta(days=30), first_run=F.lit(3)).commit()
    assert files() == before


def test_audit_tells_bounds_from_free_scans(spark, tmp_path):
    path, small = f"file://{tmp_path}/t", f"file://{tmp_path}/small"
    spark.range(40).select("id", F.concat(F.lit("2026-05-0"), (F.col("id") % 4 + 1).cast("string")).alias("day")).write.partitionBy("day").parquet(path)
    spark.createDataFrame([(date(2026, 5, 2), 1)], "day date, wanted int").write.parquet(small)
    table, tables = spark.read.parquet(path), {"t": (path, "day")}
    how = lambda df: [s.bounded_by for s in pruning.visit(df, tables)]
    assert how(table.where("day >= '2026-05-03'")) == [("literal",)]
    assert how(table.where(F.col("day").isin("2026-05-03", "2026-05-01"))) == [("literal",)]
    for free in (table, table.where("day is not null"), table.where("id > 3"), table.where("date_format(day, 'dd') = '02'"), table.where("day <> '2026-05-03'")):
        assert how(free) == [()]
        with pytest.raises(pruning.UnboundedScan, match="t"):
            pruning.bounded(free, tables)
    # a join with a filtered table prunes as it runs
    joined = table.join(spark.read.parquet(small).where("wanted = 1"), "day")
    assert how(joined) == [("dynamic",)] and joined.count() == 10
    both = table.where("day >= '2026-05-03'").unionByName(table)
    assert sorted(how(both)) == [(), ("literal",)]
    with pytest.raises(pruning.UnboundedScan, match="no table"):
        pruning.bounded(spark.range(3), tables)


def test_compaction_is_planned_from_the_listing(spark, tmp_path):
    path, now = f"file://{tmp_path}/t", datetime(2026, 5, 3, 9)
    rows = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.when(F.col("id") < 3000, "2026-05-01").when(F.col("id") < 3500, "2026-05-02").otherwise("2026-05-03").alias("day"))
    rows.where("day <> '2026-05-02'").repartition(8).write.partitionBy("day").parquet(path)
    rows.where("day = '2026-05-02'").repartition(4).write.mode("append").partitionBy("day").parquet(path)
    listed = maintenance.listed_files(spark, path, "day")
    assert {r[0]: r[1] for r in listed.groupBy("partition").count().collect()} == {"2026-05-01": 8, "2026-05-02": 4, "2026-05-03": 8}
    on_disk = {p.parent.name: sum(x.stat().st_size for x in p.parent.glob("*.parquet")) for p in (tmp_path / "t").rglob("*.parquet")}
    assert {f"day={r[0]}": r[1] for r in listed.groupBy("partition").agg(F.sum("bytes")).collect()} == on_disk
    plan = maintenance.compaction_plan(listed, now, on_disk["day=2026-05-01"] // 2)
    text = plan._jdf.queryExecution().toString()
    assert "Scan parquet" not in text and "binaryFile" in text and "content" not in text.split("== Physical Plan ==")[1]
    assert {r.partition for r in plan.collect()} == {"2026-05-01"} and {r.part for r in plan.collect()} <= {0, 1, 2}
    kept = {p.name for d in ("2026-05-02", "2026-05-03") for p in (tmp_path / "t" / f"day={d}").glob("*.parquet")}
    before = spark.read.parquet(path).count()
    assert maintenance.compact(spark, path, "day", now) == 1 and maintenance.compact(spark, path, "day", now) == 0
    assert len(list((tmp_path / "t" / "day=2026-05-01").glob("*.parquet"))) == 1
    assert {p.name for d in ("2026-05-02", "2026-05-03") for p in (tmp_path / "t" / f"day={d}").glob("*.parquet")} == kept
    after = spark.read.parquet(path)
    assert after.count() == before == 4000 and after.select("id").distinct().count() == 4000
    assert maintenance.compact(spark, f"{path}-none", "day", now) == 0


def test_latency_sketches_against_sorted_lists(spark, tmp_path):
    path, dice = f"file://{tmp_path}/latencies", random.Random(5)
    rows = [(START + timedelta(hours=h), dice.choice([0, -4, 0.2, 1, 3]) * dice.expovariate(0.05)) for h in range(50) for _ in range(40)]
    alerts = spark.createDataFrame([(at, at + timedelta(milliseconds=round(1000 * s))) for at, s in rows], "event_ts timestamp_ntz, detected_at timestamp_ntz")
    for _ in range(2):  # an hour that comes again is replaced
        sketches.store_latencies(alerts, path)
    bound = START + timedelta(hours=20)
    ranks = {"p01": 0.01, "p50": 0.5, "p95": 0.95, "most": 1.0}
    got = sketches.latency_percentiles(spark, path, bound, ranks).first()
    values = sorted(max(0, round(1000 * s)) / 1000 for at, s in rows if at >= bound)
    assert got.samples == len(values)
    for name, q in ranks.items():
        exact = values[max(0, math.ceil(q * len(values)) - 1)]
        assert abs(got[name] - exact) <= sketches.ERROR * exact + 0.0005
    none = sketches.latency_percentiles(spark, path, START + timedelta(days=90), ranks).first()
    assert none.samples == 0 and none.p50 is None


def test_exact_places_with_far_outliers(spark):
    dice = random.Random(6)
    values = [dice.randrange(3000) for _ in range(800)] + [10**14, -(10**13), 10**14]
    ordered = sorted(values)
    places = {f"p{k}": (lambda n, k=k: F.lit(k)) for k in (0, 1, 57, 400, 799, 800, 802)}
    got = reports.values_at(spark.createDataFrame([(v,) for v in [*values, None]], "v long"), places).first()
    assert got.n == len(values) and got.most == 10**14 and all(got[name] == ordered[int(name[1:])] for name in places)
    one = reports.values_at(spark.createDataFrame([(7,)] * 3, "v long"), places).first()
    assert one.n == 3 and one.p0 == one.p1 == 7 and one.p57 is None


def test_id_sketches_are_within_their_error(spark, tmp_path):
    path = f"file://{tmp_path}/ids"
    rows = spark.range(60_000).select(F.concat(F.lit("e"), (F.col("id") % 20_000).cast("string")).alias("meta_id"), (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") / 2_000).cast("int"))).alias("ingested_at"))
    sketches.store_ids(rows, path)
    got = sketches.distinct_ids(spark, path, START + timedelta(hours=10)).first()
    assert got.bronze == 40_000 and abs(got.ids - 20_000) <= sketches.ID_ERROR * 20_000
    assert tuple(sketches.distinct_ids(spark, path, START + timedelta(days=90)).first()) == (0, 0)


def test_reports_are_bounded(spark, tmp_path):
    """Every report's plan, over empty days and full ones; one that forgets its bound is found."""
    from tidemark.catalog.model import Run
    from tests.conftest import SMALL

    run, root = Run(spark, SMALL, stored=True), f"file://{tmp_path}/house"
    for layer, rows in (("bronze", run.bronze), ("dlq", run.silver.select("ingested_at", F.lit("x").alias("error"))), ("silver", run.silver), ("alerts", run.alerts), ("bursts", run.bursts)):
        warehouse.store(rows, root, layer)
    house = warehouse.Warehouse(spark, root, run.now, run.watchlist)
    found = warehouse.audit(house)
    assert set(found) == set(warehouse.REPORTS) and all(scans and all(s.bounded_by for s in scans) for scans in found.values())
    free = warehouse.audit(house, {"free": lambda w: w.since("silver", warehouse.WEEK).join(spark.read.parquet(f"{root}/bronze"), "meta_id")})
    assert [s.table for s in free["free"] if not s.bounded_by] == ["bronze"]
