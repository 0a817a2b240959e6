"""Change events made from the table `events`, and the reference tables they are judged by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.scalars import message_key

SESSION = "s1"


def base_events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """One row for each row of events, with the fields of a change event.

    With `spread` the rows go to all cores before anything is made of them: a file is read by as many tasks as it has row groups,
    and a group may hold a million rows.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    kind, i, u = F.col("event_type"), F.col("event_id"), F.col("user_id")
    is_log, is_new = kind == "error", kind == "signup"
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    if spread:
        e = e.repartition(2 * spark.sparkContext.defaultParallelism, "event_id")
    return e.select(
        i.alias("event_id"),
        F.concat(F.lit("ev-"), i.cast("string")).alias("meta_id"),
        F.col("ts").alias("event_ts"),
        (F.col("ts") + F.make_dt_interval(mins=(i % 13).cast("int"))).alias("ingested_at"),
        F.when(k % 4 == 3, "dewiki").otherwise("enwiki").alias("wiki"),
        F.concat(F.lit("Page "), (k % 8).cast("string")).alias("title"),
        F.when(u % 6 == 5, 1).otherwise(0).alias("namespace"),
        F.when(is_new, "new").when(is_log, "log").otherwise("edit").alias("edit_type"),
        F.when(is_log, F.when(i % 4 == 2, "move").when(i % 4 == 3, "protect").otherwise("delete")).alias("log_type"),
        F.when(is_log, F.element_at(F.array(*map(F.lit, ("delete", "restore", "move", "modify"))), (i % 4 + 1).cast("int"))).alias("log_action"),
        F.when(u % 10 == 0, F.concat(F.lit("192.0.2."), (u % 250).cast("string"))).when(u % 10 == 1, F.concat(F.lit("~2026-"), F.lpad(u.cast("string"), 5, "0"), F.lit("-01"))).otherwise(F.concat(F.lit("Editor-"), u.cast("string"))).alias("user"),
        (u % 7 == 0).alias("is_bot"),
        F.when(~is_log & ~is_new, (1000 + 100 * k).cast("long")).alias("length_old"),
        F.when(is_new, F.floor(10 * F.col("value"))).when(~is_log, F.greatest(F.lit(0), 1500 + 100 * k - F.floor(8 * F.col("value")))).cast("long").alias("length_new"),
        F.when(~is_log & ~is_new, i).alias("revision_old"),
        F.when(~is_log, i + 1).alias("revision_new"),
    )


def _payload(title, domain) -> F.Column:
    t = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.to_json(
        F.struct(
            F.struct(F.col("meta_id").alias("id"), t.alias("dt"), F.lit(domain).alias("domain")).alias("meta"),
            F.col("edit_type").alias("type"),
            F.col("namespace").cast("long").alias("namespace"),
            title.alias("title"),
            "wiki",
            "user",
            F.col("is_bot").alias("bot"),
            F.struct(F.col("length_old").alias("old"), F.col("length_new").alias("new")).alias("length"),
            F.struct(F.col("revision_old").alias("old"), F.col("revision_new").alias("new")).alias("revision"),
            "log_type",
            "log_action",
        )
    )


def received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What comes in before any check: raw, event_id, kind, ingested_at. Every row of events, a copy of every hundredth, and
    for a few rows one without a title, one that is no JSON, and one of the canary domain."""
    return _keyed(spark, sf_dir).drop("kafka_key")


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What comes in, with the keys that its producer gives to the records: it knows the page, and needn't look for it in the payload."""
    e = base_events(spark, sf_dir)
    key, none = message_key(F.col("wiki"), F.col("title")).alias("kafka_key"), F.lit(None).cast("string").alias("kafka_key")
    as_base = lambda rows: rows.select(_payload(F.col("title"), "wiki.example").alias("raw"), "event_id", F.lit("base").alias("kind"), "ingested_at", key)
    main = as_base(base_events(spark, sf_dir, spread=True))
    copies = as_base(e.where(F.col("event_id") % 100 == 99)).withColumns({"kind": F.lit("copy"), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 MINUTE")})
    bad = e.where(F.col("event_id") % 211 == 0).withColumn("meta_id", F.concat(F.lit("bad-"), F.col("event_id").cast("string")))
    bad = bad.select(_payload(F.lit(None).cast("string"), "wiki.example").alias("raw"), "event_id", F.lit("bad").alias("kind"), "ingested_at", none)
    broken = e.where(F.col("event_id") % 307 == 0).select(F.concat(F.lit("{broken "), F.col("meta_id")).alias("raw"), "event_id", F.lit("broken").alias("kind"), "ingested_at", none)
    canary = e.where(F.col("event_id") % 503 == 0).withColumn("meta_id", F.concat(F.lit("canary-"), F.col("event_id").cast("string")))
    canary = canary.select(_payload(F.col("title"), "canary").alias("raw"), "event_id", F.lit("canary").alias("kind"), "ingested_at", key)
    return main.unionByName(copies).unionByName(bad).unionByName(broken).unionByName(canary)


def topic(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = ("base", "copy")) -> DataFrame:
    """The topic of valid events as decoded records: 6 partitions, offsets from 0 without gaps, copies after all others."""
    rows = _keyed(spark, sf_dir).where(F.col("kind").isin(*kinds))
    last = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("event_id").alias("_last"))
    i, p = F.col("event_id"), F.col("event_id") % 6
    rows = rows.crossJoin(F.broadcast(last))  # one row
    own = F.floor((F.col("_last") - p) / 6) + 1  # base rows of the partition
    offset = F.when(F.col("kind") == "base", F.floor(i / 6)).otherwise(own + F.floor((i - 99) / 300))
    return rows.select("kafka_key", "raw", p.cast("int").alias("kafka_partition"), offset.cast("long").alias("kafka_offset"), "ingested_at")


def dlq_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic of rejected events: one partition; the envelope holds the reason, the payload and the time."""
    from tidemark.operators.contract import routed

    rows = routed(received(spark, sf_dir).where(F.col("kind") != "canary")).where(F.col("reason").isNotNull())
    envelope = F.to_json(F.struct(F.col("reason").alias("error"), "raw", F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("rejected_at")))
    offset = F.when(F.col("kind") == "bad", 2 * F.floor(F.col("event_id") / 211)).otherwise(2 * F.floor(F.col("event_id") / 307) + 1)
    return rows.select(F.lit(None).cast("string").alias("kafka_key"), envelope.alias("raw"), F.lit(0).alias("kafka_partition"), offset.cast("long").alias("kafka_offset"), "ingested_at")


WATCHLIST_ROWS = [
    ("enwiki", "Page 0", "own_brand", "team-a"),
    ("enwiki", "Page 1", "product", "team-b"),
    ("enwiki", "Page 2", "product", "team-b"),
    ("enwiki", "Page 4", "competitor", "team-c"),
    ("enwiki", "Page 3", "competitor", "team-c"),
]


def watchlist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WATCHLIST_ROWS, schemas.WATCHLIST)


def alert_rules(spark: SparkSession, min_edits: int = 5, window_minutes: int = 10, disabled: tuple[str, ...] = (), min_removed_bytes: int = 2000) -> DataFrame:
    from decimal import Decimal

    rows = [
        ("R1", "Page deleted or moved", "high", None, None, None, None),
        ("R2", "Large removal", "medium", min_removed_bytes, Decimal("0.2"), None, None),
        ("R3", "Unregistered editor", "low", None, None, None, None),
        ("R4", "Protection change", "low", None, None, None, None),
        ("R5", "Edit burst", "medium", None, None, min_edits, window_minutes),
    ]
    return spark.createDataFrame([(*r, r[0] not in disabled) for r in rows], schemas.RULES)
