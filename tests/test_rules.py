"""Boundary cases of scalars and rules, the scripted scenario and the burst cases."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import alerts, gold, layers, quality
from tidemark.operators.contract import with_reason
from tidemark.sources import feed

NOON = datetime(2026, 10, 3, 12)


def event(i, user="ExampleUser", bot=False, kind="edit", old=None, new=None, wiki="enwiki", title="Page 0", ns=0, log=None, at=NOON, late=0, dt=None):
    body = {"meta": {"id": i, "dt": dt or at.strftime("%Y-%m-%dT%H:%M:%SZ")}, "type": kind, "namespace": ns, "title": title, "wiki": wiki, "user": user, "bot": bot, "length": {"old": old, "new": new}}
    if log:
        body |= {"log_type": log[0], "log_action": log[1]}
    return (f"{wiki}:{title}", json.dumps(body), 0, 0, at + timedelta(seconds=late))


def typed(spark, *events):
    return layers.to_silver(spark.createDataFrame(list(events), schemas.RECORD))


def test_typed_rows(spark):
    rows = typed(
        spark, event("a"), event("b", "192.0.2.10"), event("c", "2001:db8::10"), event("d", "~2026-12345-67"), event("e", "~2026-12345-67", True), event("f", "Bot", True), event("g", None),
        event("h", old=10000, new=7000), event("i", kind="new", new=512), event("j", kind="log"), event("k", old=5), event("l", late=600), event("m", late=601), event("n", dt="not a time"),
        ("k", "{broken", 0, 0, NOON), ("k", '{"type": "edit"}', 0, 0, NOON),
    )
    got = {r.meta_id: r for r in rows.collect()}
    assert set(got) == set("abcdefghijklm")
    assert [got[x].editor_type for x in "abcdefg"] == ["registered", "unregistered", "unregistered", "unregistered", "bot", "bot", "registered"]
    assert [got[x].user_name for x in "bcd"] == [None, None, "~2026-12345-67"]
    assert [got[x].byte_delta for x in "hijk"] == [-3000, 512, None, None]
    assert [got[x].is_late for x in "lm"] == [False, True]


CASES = {
    "delete": (dict(kind="log", log=("delete", "delete")), {("R1", "high")}),
    "move by bot": (dict(kind="log", log=("move", "move_redir"), bot=True), {("R1", "high")}),
    "restore": (dict(kind="log", log=("delete", "restore")), set()),
    "protect": (dict(kind="log", log=("protect", "move_prot")), {("R4", "low")}),
    "minus 2000": (dict(old=10000, new=8000), {("R2", "medium")}),
    "minus 1999": (dict(old=10000, new=8001), set()),
    "exactly a fifth": (dict(old=1000, new=800), set()),
    "over a fifth": (dict(old=1000, new=799), {("R2", "medium")}),
    "empty": (dict(old=0, new=0), set()),
    "bot removes": (dict(old=10000, new=100, bot=True), set()),
    "temporary removes": (dict(user="~2026-1-1", old=10000, new=100), {("R2", "high"), ("R3", "low")}),
    "ip adds": (dict(user="192.0.2.1", old=100, new=150), {("R3", "low")}),
    "temporary new page": (dict(user="~2026-1-1", kind="new", new=300), {("R3", "low")}),
    "unwatched": (dict(user="192.0.2.1", title="Page 7", old=1, new=2), set()),
    "other wiki": (dict(user="192.0.2.1", title="Page 3", wiki="dewiki", old=1, new=2), set()),
    "talk page": (dict(user="192.0.2.1", ns=1, old=1, new=2), set()),
    "categorize": (dict(user="192.0.2.1", kind="categorize"), set()),
}


def test_rules(spark):
    rows = typed(spark, *(event(name, **case) for name, (case, _) in CASES.items()))
    found = alerts.find_alerts(rows, feed.watchlist(spark), feed.alert_rules(spark)).collect()
    got = {name: {(a.rule_id, a.severity) for a in found if a.meta_id == name} for name in CASES}
    assert got == {name: want for name, (_, want) in CASES.items()}
    assert all(len(a.alert_id) == 64 for a in found)
    # the second implementation agrees, and notices when a rule is off
    known = spark.createDataFrame([(a.meta_id, a.rule_id) for a in found], "meta_id string, rule_id string")
    none = alerts.reconcile(rows, feed.watchlist(spark), feed.alert_rules(spark), known).count()
    broken = alerts.find_alerts(rows, feed.watchlist(spark), feed.alert_rules(spark, disabled=("R1",)))
    assert none == 0
    assert {r.meta_id for r in alerts.reconcile(rows, feed.watchlist(spark), feed.alert_rules(spark), broken).collect()} == {"delete", "move by bot"}


def test_threshold_is_data(spark):
    rows = typed(spark, event("a", old=10000, new=8500))
    assert alerts.find_alerts(rows, feed.watchlist(spark), feed.alert_rules(spark)).count() == 0
    assert alerts.find_alerts(rows, feed.watchlist(spark), feed.alert_rules(spark, min_removed_bytes=1000)).count() == 1


def test_alert_ids(spark):
    from tidemark.functions import scalars as S

    got = spark.range(1).select(S.alert_id(F.lit("R1"), F.lit("ev-7")), S.burst_alert_id(F.lit("enwiki"), F.lit("Some title"), F.lit("2026-10-03 12:00:00").cast("timestamp_ntz"))).first()
    assert tuple(got) == tuple(sha256(x.encode()).hexdigest() for x in ("R1:ev-7", "R5:enwiki:Some title:2026-10-03T12:00:00"))


@pytest.mark.parametrize(("minutes", "want"), [([0, 2, 4, 6, 9], [(0, 5)]), ([0, 2, 4, 6], []), ([5, 7, 9, 11, 12, 14], []), ([10, 11, 12, 13, 14], [(10, 5)])])
def test_bursts(spark, minutes, want):
    rows = typed(spark, *(event(f"e{m}", bot=m % 2 == 0, old=1, new=2, at=NOON + timedelta(minutes=m)) for m in minutes), event("talk", ns=1, at=NOON), event("log", kind="log", at=NOON))
    got = gold.bursts(rows, feed.watchlist(spark), feed.alert_rules(spark)).collect()
    assert [(b.window_start.minute, b.edits) for b in got] == want
    assert gold.bursts(rows, feed.watchlist(spark), feed.alert_rules(spark, disabled=("R5",))).count() == 0


GOOD = {"meta": {"id": "a", "dt": "2026-10-03T12:00:00Z"}, "type": "edit", "namespace": 0, "title": "T", "wiki": "enwiki"}
REASONS = [
    (GOOD, None), (GOOD | {"more": 1}, None), (GOOD | {"length": {"old": None, "new": 123}}, None), (GOOD | {"namespace": 1.0}, None),
    *[({k: v for k, v in GOOD.items() if k != f}, f"{f}: required") for f in GOOD],
    ({}, "meta: required"), (GOOD | {"meta": {"dt": "x"}}, "meta.id: required"), (GOOD | {"meta": {"id": "a"}}, "meta.dt: required"), (GOOD | {"meta": {}}, "meta.id: required"), (GOOD | {"meta": 1}, "meta: type"),
    (GOOD | {"meta": {"id": "", "dt": "x"}}, "meta.id: minLength"), (GOOD | {"namespace": "192.0.2.44"}, "namespace: type"), (GOOD | {"namespace": True}, "namespace: type"), (GOOD | {"title": ""}, "title: minLength"),
    (GOOD | {"type": "x"}, "type: enum"), (GOOD | {"wiki": "EN wiki"}, "wiki: pattern"), (GOOD | {"length": None}, "length: type"), (GOOD | {"bot": "yes", "user": 1}, "bot: type"), (GOOD | {"length": {"old": "1"}}, "length.old: type"),
    ([1, 2], "not_an_object"), ("text", "not_an_object"),
]


def test_contract(spark):
    raw = [(i, json.dumps(body)) for i, (body, _) in enumerate(REASONS)] + [(len(REASONS), "{not json")]
    got = dict(with_reason(spark.createDataFrame(raw, "i int, raw string")).select("i", "reason").collect())
    assert [got[i] for i in range(len(raw))] == [want for _, want in REASONS] + ["invalid_json"]


def test_seed_errors(spark):
    w = feed.watchlist(spark)
    assert quality.watchlist_errors(w).count() == 0
    bad = w.unionByName(w.limit(1)).unionByName(spark.createDataFrame([("enwiki", "", "friend", "t")], schemas.WATCHLIST))
    assert {r.problem for r in quality.watchlist_errors(bad).collect()} == {"duplicate page", "blank field", "unknown category"}
    assert quality.rules_errors(feed.alert_rules(spark)).count() == 0
    for window in (0, 7, 45):
        assert [r.problem for r in quality.rules_errors(feed.alert_rules(spark, window_minutes=window)).collect()] == ["R5 window does not divide an hour"]
    assert "rule missing or repeated" in {r.problem for r in quality.rules_errors(feed.alert_rules(spark).where("rule_id <> 'R3'")).collect()}
