"""Batch queries, in the order of the inventory: sources, scalars and filters, joins, aggregates, order and sets, checks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.catalog import query
from tidemark.catalog.model import Run, stored_as
from tidemark.functions import scalars as S
from tidemark.operators import alerts as A
from tidemark.operators import contract, documents, export, gold, incremental, layers, maintenance, merge, ops, privacy, quality, reports, sketches, warehouse
from tidemark.plans.pruning import bounded, unpruned
from tidemark.plans.workspace import folder
from tidemark.sources import feed, readers, seeds

# ---- sources ----------------------------------------------------------------------------------------------------------


@query("SELECT kafka_key, kafka_partition, kafka_offset, ingested_at FROM topic")
def src_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Run(spark, sf_dir).topic
    raw = t.select(F.col("kafka_key").cast("binary").alias("key"), F.col("raw").cast("binary").alias("value"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), F.col("ingested_at").cast("timestamp").alias("timestamp"))
    return layers.decoded(raw).drop("raw")


@query("SELECT wiki, title, count(*) AS edits FROM ev GROUP BY 1, 2")
def src_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "table")
    Run(spark, sf_dir).silver.select("meta_id", "wiki", "title").write.parquet(path)
    return spark.read.parquet(path).groupBy("wiki", "title").agg(F.count("*").alias("edits"))


@query("SELECT DISTINCT wiki, title, 'product' AS category, 'team-' || namespace AS owner_team FROM ev")
def src_seed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "seed")
    pages = feed.base_events(spark, sf_dir).select("wiki", "title", F.lit("product").alias("category"), F.concat(F.lit("team-"), F.col("namespace").cast("string")).alias("owner_team")).distinct()
    pages.write.csv(path, header=True)
    return readers.seed_csv(spark, path, schemas.WATCHLIST)


@query("SELECT meta_id FROM received WHERE kind <> 'broken'")
def src_jsonl_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "jsonl")
    Run(spark, sf_dir).received.select("raw").write.option("compression", "gzip").text(path)
    return readers.json_lines(spark, path).select(F.get_json_object("raw", "$.meta.id").alias("meta_id"))


def _progress(run: Run) -> DataFrame:
    """A progress log as a stream of 1,000 events a batch would have left it."""
    e = run.spark.read.parquet(f"{run.sf_dir}/events.parquet")
    b = e.groupBy(F.floor(F.col("event_id") / 100).alias("batch_id")).agg(F.max("ts").alias("at"), F.count("*").alias("n"), F.max("event_id").alias("last"), F.sum("user_id").alias("u"))
    names = F.array(F.lit("silver_edits"), F.lit("page_alerts"))
    end = F.concat(F.lit('{"edits": {"0": '), (F.col("last") + 1).cast("string"), F.lit(', "1": '), F.floor(F.col("last") / 2).cast("string"), F.lit("}}"))
    rows = b.withColumn("query", F.explode(names)).select(
        F.when(F.col("batch_id") % 10 == 9, "s0").otherwise("s1").alias("session_id"), "query", F.lit("r").alias("run_id"), "batch_id",
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"), F.col("n").alias("num_input_rows"),
        F.when(F.col("batch_id") % 3 == 0, 0.0).otherwise(F.col("n") / 8.0).alias("input_rows_per_second"), F.lit(1.0).alias("processed_rows_per_second"),
        (F.col("u") % 1000).alias("trigger_ms"), F.lit(1).cast("long").alias("add_batch_ms"), F.lit(None).cast("string").alias("watermark"),
        F.array(F.struct(F.lit(None).cast("string").alias("start_offset"), F.when(F.col("batch_id") % 4 != 1, end).alias("end_offset"), F.lit(None).cast("string").alias("latest_offset"))).alias("sources"),
        F.to_date("at").alias("dt"),
    )
    return rows


_LOG = """b AS (SELECT event_id // 100 AS batch_id, max(ts) AS tstamp, count(*) AS n, max(event_id) AS last, sum(user_id) AS u FROM events GROUP BY 1),
log AS (SELECT CASE WHEN batch_id % 10 = 9 THEN 's0' ELSE 's1' END AS session_id, query, batch_id, date_trunc('millisecond', tstamp) AS tstamp,
  CASE WHEN batch_id % 3 = 0 THEN 0.0 ELSE n / 8.0 END AS rate, CAST(u % 1000 AS BIGINT) AS trigger_ms, last FROM b, (VALUES ('silver_edits'), ('page_alerts')) q(query)),
recent AS (SELECT * FROM log WHERE session_id = 's1' AND tstamp <= (SELECT max(tstamp) FROM log) AND tstamp >= (SELECT max(tstamp) FROM log) - INTERVAL 2880 MINUTE)"""


def _recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "progress")
    log = _progress(Run(spark, sf_dir))
    log.write.partitionBy("dt").json(path)
    now = readers.progress_log(spark, path).agg(F.max("timestamp")).first()[0] or "1970-01-01T00:00:00.000Z"
    return ops.recent_progress(readers.progress_log(spark, path), feed.SESSION, now.rstrip("Z").replace("T", " "), 2880)


@query(f"WITH {_LOG} SELECT query, batch_id, trigger_ms FROM recent")
def src_progress_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir).select("query", "batch_id", "trigger_ms")


@query(f"WITH {_LOG} SELECT query, count(*) AS batches, round_even(arg_max(rate, tstamp) FILTER (WHERE rate > 0), 2) AS input_rows_per_second, median(trigger_ms) AS batch_duration_ms_p50, max(trigger_ms) AS batch_duration_ms_max FROM recent GROUP BY 1")
def streaming_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.streaming_stats(_recent(spark, sf_dir))


_OFFSETS = f"""{_LOG}, done AS (SELECT arg_max(last, tstamp) AS last FROM recent WHERE query = 'silver_edits' AND batch_id % 4 <> 1),
highs AS (SELECT CAST(event_id % 3 AS INTEGER) AS kafka_partition, max(event_id) + 1 AS high FROM events GROUP BY 1)"""


def _highs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").groupBy((F.col("event_id") % 3).cast("int").alias("kafka_partition")).agg((F.max("event_id") + 1).alias("high"))


@query(f"WITH {_OFFSETS} SELECT 0 AS kafka_partition, last + 1 AS processed_offset FROM done UNION ALL SELECT 1, last // 2 FROM done")
def latest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.processed_offsets(_recent(spark, sf_dir), "silver_edits", "edits")


_LAG = f"""WITH {_OFFSETS}, p AS (SELECT 0 AS kafka_partition, last + 1 AS processed_offset FROM done UNION ALL SELECT 1, last // 2 FROM done)
SELECT kafka_partition, high AS latest_offset, processed_offset, CASE WHEN processed_offset IS NOT NULL THEN greatest(high - processed_offset, 0) END AS lag FROM highs LEFT JOIN p USING (kafka_partition)"""


def _lag(spark: SparkSession, sf_dir: str, recent: DataFrame) -> DataFrame:
    return ops.lag(_highs(spark, sf_dir), ops.processed_offsets(recent, "silver_edits", "edits"))


@query(_LAG)
def left_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lag(spark, sf_dir, _recent(spark, sf_dir))


@query(f"SELECT CAST(sum(lag) AS BIGINT) AS lag FROM ({_LAG})")
def lag_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.lag_total(left_lag(spark, sf_dir))


@query("""SELECT CASE event_id % 5 WHEN 0 THEN 'unavailable' WHEN 1 THEN 'unreadable' WHEN 2 THEN 'version' WHEN 3 THEN 'invalid' ELSE 'ok' END AS status, count(*) AS n FROM events GROUP BY 1""")
def src_snapshot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    at = S.iso_utc(F.col("ts"))
    text = (
        F.when(i % 5 == 1, F.concat(F.lit("{"), F.col("props")))
        .when(i % 5 == 2, F.to_json(F.struct(F.lit(2).alias("schema_version"), at.alias("generated_at"))))
        .when(i % 5 == 3, F.to_json(F.struct(F.lit(1).alias("schema_version"), F.col("event_type"))))
        .when(i % 5 == 4, F.to_json(F.struct(F.lit(1).alias("schema_version"), at.alias("generated_at"))))
    )
    docs = spark.read.parquet(f"{sf_dir}/events.parquet").select(text.alias("json"))
    return export.snapshot_status(docs).groupBy("status").agg(F.count("*").alias("n"))


# ---- sinks ------------------------------------------------------------------------------------------------------------


@query("SELECT meta_id, wiki, title, edit_type, editor_type FROM silver")
def sink_insert_only_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of a stream, each of some days, by insert-only merge: the second overlaps the first, and comes twice. The records
    are stored once, as a topic keeps them, and each batch reads and parses them."""
    run, path = Run(spark, sf_dir), folder(spark, "merge")
    rows = layers.to_silver(stored_as(run.topic, "topic"))
    first, last = feed.base_events(spark, sf_dir).agg(F.min("event_ts"), F.max("event_ts")).first()
    if first is None:
        return rows.select("meta_id", "wiki", "title", "edit_type", "editor_type")
    at = lambda share: F.col("event_ts") >= F.lit(first + (last - first) * share)
    for part in (~at(0.6), at(0.4), at(0.4)):
        merge.append_new(rows.where(part), path, "meta_id")
    return spark.read.parquet(path).select("meta_id", "wiki", "title", "edit_type", "editor_type")


def _typed_by_hour(run: Run) -> str:
    """The typed layer in its hours, as the stream leaves it."""
    path = folder(run.spark, "typed")
    rows = merge.by_hour(run.silver)
    rows.repartition(merge.HOUR).write.partitionBy(merge.HOUR).parquet(path)
    return path


@query("SELECT alert_id, edits, CASE WHEN window_start < (SELECT date_trunc('day', now - INTERVAL 1 DAY) FROM run) THEN 1 ELSE 2 END AS seen FROM bursts WHERE window_start >= (SELECT date_trunc('day', now - INTERVAL 8 DAY) FROM run)")
def sink_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bursts of the last week in three runs of the incremental model, a day apart, each over its own hours of the typed layer: stamps
    are those of the run that first saw a burst. The first run knows the feed up to its own time alone."""
    run, path = Run(spark, sf_dir), folder(spark, "bursts")
    source = _typed_by_hour(run)
    day = run.now.replace(hour=0, minute=0, second=0) - timedelta(days=1)
    model = incremental.Model(lambda rows: gold.bursts(rows, run.watchlist, run.rules), ("alert_id",), "window_start", "day", ("seen",))
    early = incremental.Model(lambda rows: model.build(rows.where(F.col("event_ts") < F.lit(day))), model.keys, model.at, model.grain, model.preserved)
    incremental.refresh(spark, early, source, path, day, seen=F.lit(1)).commit()
    for _ in range(2):  # the second run changes nothing
        last = incremental.refresh(spark, model, source, path, run.now, since=day - timedelta(days=1), seen=F.lit(2))
        last.commit()
    # a model that never had a row has no table yet
    return (spark.read.schema(last.rows.schema).parquet(path) if merge.table_exists(spark, path) else last.rows).select("alert_id", "edits", "seen")


@query("SELECT wiki, title, 'product' AS category, 'team-' || min(namespace) AS owner_team, count(*) OVER () AS loaded, 1 AS refused FROM ev GROUP BY wiki, title")
def sink_overwrite_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both seeds loaded as one version, three times: the second load wins, the third has pages twice and changes nothing."""
    root = folder(spark, "reference")
    pages = feed.base_events(spark, sf_dir).groupBy("wiki", "title").agg(F.lit("product").alias("category"), F.concat(F.lit("team-"), F.min("namespace").cast("string")).alias("owner_team"))
    loaded, refused = {"watchlist": 0}, 0
    for watchlist in (pages.limit(1), pages, pages.unionByName(pages)):
        files = folder(spark, "seeds")
        watchlist.write.csv(f"{files}/watchlist.csv", header=True)
        Run(spark, sf_dir).rules.write.csv(f"{files}/alert_rules.csv", header=True)
        try:
            loaded = seeds.load(spark, files, root, "2024-01-02 00:00:00")
        except seeds.SeedError:
            refused += 1
    return seeds.reference(spark, root).watchlist.drop("loaded_at").withColumns({"loaded": F.lit(loaded["watchlist"]).cast("long"), "refused": F.lit(refused)})


@query("SELECT wiki, count(*) AS n FROM ev GROUP BY 1")
def sink_load_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "once_" + folder(spark, "x").rpartition("-")[2]
    counts = feed.base_events(spark, sf_dir).groupBy("wiki").agg(F.count("*").alias("n"))
    maintenance.load_if_empty(counts, name, "2024-01-01 00:00:00")
    maintenance.load_if_empty(counts.limit(0), name, "2024-01-02 00:00:00")  # leaves the table alone
    return spark.table(name).drop("loaded_at")


@query("SELECT kafka_partition, latest_offset, lag FROM (" + _LAG + ")")
def sink_lag_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "lag")
    for _ in range(2):  # a repeated run overwrites its own file
        left_lag(spark, sf_dir).write.mode("overwrite").json(path)
    return spark.read.schema("kafka_partition int, latest_offset bigint, lag bigint").json(path)


@query("SELECT edit_type, wiki, count(*) AS n, count(CASE WHEN event_id % 2 = 1 THEN user_name END) AS named FROM silver GROUP BY 1, 2")
def sink_add_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table gets a column; rows written before read null there."""
    name = "grown_" + folder(spark, "x").rpartition("-")[2]
    maintenance.create_table(spark, name, "meta_id string, wiki string, edit_type string", "edit_type")
    number = F.substring("meta_id", 4, 20).cast("long")
    silver = Run(spark, sf_dir).silver.where("meta_id is not null")
    silver.where(number % 2 == 0).select("meta_id", "wiki", "edit_type").write.mode("append").insertInto(name)
    maintenance.add_missing_columns(spark, name, {"user_name": "string"})
    silver.where(number % 2 == 1).select("meta_id", "wiki", "user_name", "edit_type").write.mode("append").insertInto(name)
    return spark.table(name).groupBy("edit_type", "wiki").agg(F.count("*").alias("n"), F.count("user_name").alias("named"))


@query("SELECT strftime(event_ts, '%Y-%m-%d') AS day, count(*) AS n FROM ev GROUP BY 1")
def sink_compact_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files of each day become few; no row is lost."""
    run, path = Run(spark, sf_dir), folder(spark, "files")
    rows = feed.base_events(spark, sf_dir).withColumn("day", F.date_format("event_ts", "yyyy-MM-dd"))
    rows.repartition(6).write.partitionBy("day").parquet(path)
    maintenance.compact(spark, path, "day", run.now)
    return spark.read.schema(rows.schema).parquet(path).groupBy("day").agg(F.count("*").alias("n"))


# ---- projections, filters, scalars ------------------------------------------------------------------------------------


@query("SELECT meta_id, kafka_key, 's1' AS session_id, kafka_partition, kafka_offset, ingested_at FROM topic")
def to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).bronze.drop("raw")


@query("SELECT CASE kind WHEN 'bad' THEN 'title: required' ELSE 'invalid_json' END AS error, ingested_at AS rejected_at, 's1' AS session_id FROM received WHERE kind IN ('bad', 'broken')")
def to_bronze_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).dlq.select("error", "rejected_at", "session_id")


_SILVER = ", ".join(layers.TYPED)


@query(f"SELECT {_SILVER} FROM silver")
def to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).silver


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_ts END AS ts FROM ev")
def parse_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, "not a time").otherwise(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return feed.base_events(spark, sf_dir).select("event_id", S.parse_utc(text).alias("ts"))


@query("SELECT event_id, editor_type, user_name FROM silver")
def editor_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.base_events(spark, sf_dir).select("event_id", S.editor_type(F.col("user"), F.col("is_bot")).alias("editor_type"), S.public_user(F.col("user")).alias("user_name"))


@query("SELECT event_id, byte_delta FROM silver")
def byte_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.base_events(spark, sf_dir).select("event_id", S.byte_delta(F.col("edit_type"), F.col("length_old"), F.col("length_new")).alias("byte_delta"))


@query("SELECT event_id, is_late FROM silver")
def is_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.base_events(spark, sf_dir).select("event_id", S.is_late(F.col("ingested_at"), F.col("event_ts")).alias("is_late"))


@query("SELECT event_id, ingested_at >= event_ts + INTERVAL 10 MINUTE AS arrived_late FROM ev")
def arrived_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.base_events(spark, sf_dir).select("event_id", S.arrived_late(F.col("ingested_at"), F.col("event_ts")).alias("arrived_late"))


@query("SELECT event_id, user_name FROM silver")
def privacy_null_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.base_events(spark, sf_dir).select("event_id", S.public_user(F.col("user")).alias("user_name"))


@query("SELECT event_id, sha256('R1:' || meta_id) AS alert_id FROM ev")
def alert_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.base_events(spark, sf_dir).select("event_id", S.alert_id(F.lit("R1"), F.col("meta_id")).alias("alert_id"))


@query("SELECT event_id, sha256('R5:' || wiki || ':' || title || ':' || strftime(date_trunc('hour', event_ts), '%Y-%m-%dT%H:%M:%S')) AS alert_id FROM ev")
def burst_alert_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.base_events(spark, sf_dir).select("event_id", S.burst_alert_id(F.col("wiki"), F.col("title"), S.hour(F.col("event_ts"))).alias("alert_id"))


def _rule(name: str, where: str):
    def job(spark: SparkSession, sf_dir: str) -> DataFrame:
        from decimal import Decimal

        rows = Run(spark, sf_dir).silver
        test = {"rule_r1": S.rule_r1(), "rule_r2": S.rule_r2(F.lit(2000), F.lit(Decimal("0.2000"))), "rule_r3": S.rule_r3(), "rule_r4": S.rule_r4()}[name]
        return rows.where(test).select("meta_id")

    query(f"SELECT meta_id FROM silver WHERE {where}", name)(job)


_rule("rule_r1", "edit_type = 'log' AND log_type IN ('delete', 'move') AND log_action IN ('delete', 'delete_redir', 'move', 'move_redir')")
_rule("rule_r2", "edit_type = 'edit' AND editor_type <> 'bot' AND (byte_delta <= -2000 OR (length_old > 0 AND 10 * (length_old - length_new) > 2 * length_old))")
_rule("rule_r3", "edit_type IN ('edit', 'new') AND editor_type = 'unregistered'")
_rule("rule_r4", "edit_type = 'log' AND log_type = 'protect'")


@query("SELECT meta_id FROM silver WHERE namespace = 0")
def namespace_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).silver.where("namespace = 0").select("meta_id")


@query("SELECT meta_id FROM silver WHERE edit_type IN ('edit', 'new')")
def counted_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).silver.where(F.col("edit_type").isin(*S.COUNTED_TYPES)).select("meta_id")


@query("SELECT meta_id FROM silver WHERE event_ts >= (SELECT date_trunc('hour', now - INTERVAL 6 HOUR) FROM run)")
def incremental_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours of a run, read from the stored layer by a literal on its partitions."""
    run = Run(spark, sf_dir)
    source = _typed_by_hour(run)
    rows = spark.read.parquet(source).where(incremental.from_hour(incremental.lower_bound(run.now, "hour")))
    return bounded(rows, {"typed": (source, merge.HOUR)}).select("meta_id")


@query("SELECT meta_id FROM silver WHERE event_ts >= (SELECT date_trunc('day', now - INTERVAL 7 DAY) FROM run) AND ingested_at < (SELECT now - INTERVAL 15 MINUTE FROM run)")
def recent_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    source = _typed_by_hour(run)
    settled = F.col("ingested_at") < F.lit(run.now - timedelta(minutes=15)).cast("timestamp_ntz")
    rows = spark.read.parquet(source).where(incremental.from_hour(incremental.lower_bound(run.now, "day", first=True)) & settled)
    return bounded(rows, {"typed": (source, merge.HOUR)}).select("meta_id")


@query("SELECT count(*) AS n FROM silver WHERE event_ts >= (SELECT now - INTERVAL 12 HOUR FROM run)")
def run_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds as parameters of a statement; the partition's label is one, too."""
    run = Run(spark, sf_dir)
    source = _typed_by_hour(run)
    since = (run.now - timedelta(hours=12)).replace(tzinfo=None)
    out = spark.sql("SELECT count(*) AS n FROM {rows} WHERE event_hour >= :hour AND event_ts >= :since", args={"hour": since.strftime("%Y-%m-%d-%H"), "since": since}, rows=spark.read.parquet(source))
    return bounded(out, {"typed": (source, merge.HOUR)})


@query("SELECT meta_id FROM silver WHERE date_trunc('hour', event_ts) IN (SELECT max(date_trunc('hour', event_ts)) FROM silver)")
def hour_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by hours, read for the last hour alone."""
    run, path = Run(spark, sf_dir), folder(spark, "hours")
    merge.append_new(layers.to_silver(run.topic), path, "meta_id")
    if not merge.table_exists(spark, path):  # a feed without events makes no table
        return run.silver.select("meta_id").limit(0)
    table = spark.read.parquet(path)
    last = list(merge.rows_of(table))[-1:]  # the scan takes the hours of its files' folders, and no column of the rows
    return table.where(merge.only(last)).select("meta_id")


@query("SELECT DISTINCT date_trunc('hour', event_ts) AS hour FROM silver")
def batch_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).silver.select(S.hour(F.col("event_ts")).alias("hour")).distinct()


@query("SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN wiki || ':' || title END AS key FROM ev")
def message_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = feed.base_events(spark, sf_dir).withColumn("title", F.when(F.col("event_id") % 7 != 0, F.col("title")))
    return e.select("event_id", S.message_key(F.col("wiki"), F.col("title")).alias("key"))


@query("SELECT kind, count(*) AS n FROM received WHERE kind <> 'canary' GROUP BY 1")
def drop_canary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).received.where(~contract.is_canary(F.col("raw"))).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT event_id, kind, CASE kind WHEN 'bad' THEN 'title: required' WHEN 'broken' THEN 'invalid_json' END AS reason FROM received")
def contract_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.with_reason(Run(spark, sf_dir).received).select("event_id", "kind", "reason")


@query("SELECT CASE WHEN kind IN ('bad', 'broken') THEN 'dlq' ELSE 'edits' END AS topic, count(*) AS n FROM received WHERE kind <> 'canary' GROUP BY 1")
def route_valid_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = contract.routed(Run(spark, sf_dir).received)
    return r.groupBy(F.when(F.col("reason").isNull(), "edits").otherwise("dlq").alias("topic")).agg(F.count("*").alias("n"))


_IP = r"(^|[^\w.])([0-9]{1,3}\.){3}[0-9]{1,3}([^\w.]|$)"
_IP6 = r"(^|[^\w:])(?i:([0-9a-f]{0,4}:){2,7}[0-9a-f]{0,4})([^\w:]|$)"


@query(f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{_IP}') OR regexp_matches(text, '{_IP6}')")
def contains_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").where(S.contains_ip(F.col("text"))).select("doc_id")


@query(f"SELECT doc_id, count(*) AS lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '{_IP}') OR regexp_matches(line, '{_IP6}') GROUP BY 1")
def dq_fixture_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.lines_with_ip(spark.read.parquet(f"{sf_dir}/documents.parquet")).groupBy("doc_id").agg(F.count("*").alias("lines"))


@query("""SELECT s.meta_id, CASE WHEN user_name LIKE 'Editor-%' THEN CASE WHEN is_bot THEN 'Bot-' ELSE 'Editor-' END || substr(sha256('salt' || user_name), 1, 10)
  WHEN user_name LIKE '~%' THEN '~2000-' || lpad(CAST(CAST('0x' || substr(sha256('salt' || user_name), 1, 16) AS UBIGINT) AS VARCHAR), 20, '0') || '-' || lpad(CAST(CAST('0x' || substr(sha256('salt' || user_name), 17, 16) AS UBIGINT) AS VARCHAR), 20, '0') END AS pseudonym
FROM silver s LEFT JOIN watch w ON s.wiki = w.wiki AND s.title = w.title WHERE w.wiki IS NULL""")
def pseudonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    rows = privacy.pseudonymised(run.silver, run.watchlist, "salt")
    return rows.select("meta_id", F.col("user_name").alias("pseudonym"))


@query("""SELECT CASE WHEN r.kind = 'canary' THEN 'canary' WHEN r.kind IN ('bad', 'broken') THEN 'invalid' WHEN e.user_raw LIKE '192.0.2.%' THEN 'private' ELSE 'kept' END AS outcome, count(*) AS events
FROM received r JOIN ev e ON r.event_id = e.event_id GROUP BY 1""")
def record_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four outcomes: users of a tenth of the events are addresses, which no other payload holds."""
    return ops.outcome_counts(contract.outcome(Run(spark, sf_dir).received))


@query("SELECT event_id, trim(regexp_replace('_' || meta_id || '.' || event_type || '/', '[^A-Za-z0-9-]+', '-', 'g'), '-') AS session_id FROM (SELECT event_id, 'ev-' || event_id AS meta_id, event_type FROM events)")
def session_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    cluster = F.concat(F.lit("_ev-"), F.col("event_id").cast("string"), F.lit("."), F.col("event_type"), F.lit("/"))
    return e.select("event_id", S.session_id(cluster).alias("session_id"))


@query("SELECT event_id, strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM ev")
def iso_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.base_events(spark, sf_dir).select("event_id", S.iso_utc(F.col("event_ts")).alias("iso"))


@query("""SELECT alert_id, CASE WHEN revision_new > 0 THEN 'https://' || substr(wiki, 1, 2) || '.wikipedia.org/w/index.php?diff=' || revision_new || CASE WHEN revision_old > 0 THEN '&oldid=' || revision_old ELSE '' END
  ELSE 'https://' || substr(wiki, 1, 2) || '.wikipedia.org/w/index.php?title=' || replace(title, ' ', '_') || '&action=history&offset=' || strftime(event_ts + CASE WHEN rule_id = 'R5' THEN INTERVAL 1 HOUR ELSE INTERVAL 1 MINUTE END, '%Y%m%d%H%M%S') END AS link FROM allalerts""")
def change_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _union(Run(spark, sf_dir, stored=True))
    return u.select("alert_id", S.change_link(*(F.col(c) for c in ("wiki", "title", "rule_id", "event_ts", "revision_old", "revision_new"))).alias("link"))


@query("SELECT alert_id, greatest(date_diff('millisecond', event_ts, detected_at) / 1000.0, 0) AS seconds, ingested_at >= event_ts + INTERVAL 10 MINUTE AS arrived_late FROM alerts")
def detection_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = Run(spark, sf_dir).alerts
    return a.select("alert_id", F.greatest(S.seconds_between(F.col("event_ts"), F.col("detected_at")), F.lit(0.0)).alias("seconds"), S.arrived_late(F.col("ingested_at"), F.col("event_ts")).alias("arrived_late"))


@query("""SELECT (SELECT max(ingested_at) FROM topic) >= now - INTERVAL 10 MINUTE AS bronze_fresh, (SELECT max(event_ts) FROM silver) >= now - INTERVAL 10 MINUTE AS silver_fresh,
 (SELECT max(window_start) FROM realtime) >= now - INTERVAL 10 MINUTE AS gold_fresh, NOT ((SELECT max(ingested_at) FROM topic) >= now - INTERVAL 15 MINUTE) AS offline,
 (SELECT quantile_cont(date_diff('millisecond', event_ts, detected_at) / 1000.0, 0.95) FROM alerts WHERE ingested_at < event_ts + INTERVAL 10 MINUTE) <= 120 AS detection_within_target FROM run""")
def status_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir, stored=True)
    return ops.status_flags(reports.freshness(run.bronze, run.silver, run.realtime), reports.detection_latency(run.alerts), F.lit(run.now).cast("timestamp_ntz"))


# ---- joins ------------------------------------------------------------------------------------------------------------


@query("SELECT meta_id, category, owner_team FROM watched")
def join_watchlist_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    return A.watched(run.silver, run.watchlist).select("meta_id", "category", "owner_team")


@query("SELECT a.alert_id, r.rule_name FROM alerts a JOIN rules r ON a.rule_id = r.rule_id")
def join_rule_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    return run.alerts.join(run.rules.select("rule_id", "rule_name"), "rule_id").select("alert_id", "rule_name")


@query("SELECT wiki, title, count(*) AS rows, CAST(max(hour(event_ts)) AS INTEGER) AS min_edits, count(*) FILTER (WHERE hour(event_ts) % 2 = 0) AS rows_when_disabled FROM watched GROUP BY 1, 2")
def cross_rule_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit of the rule's row beside every row of watched pages. There is a rule for each hour, whose limit is the hour; of the
    others those of odd hours are disabled, and leave no row."""
    run = Run(spark, sf_dir)
    rows = A.watched(run.silver, run.watchlist).withColumn("hour", F.hour("event_ts"))
    rules = spark.range(24).select(F.col("id").cast("int").alias("hour"), F.col("id").cast("int").alias("min_edits"), (F.col("id") % 2 == 0).alias("enabled"))  # 24 rows
    found = rows.join(F.broadcast(rules), "hour")
    return found.groupBy("wiki", "title").agg(F.count("*").alias("rows"), F.max("min_edits").alias("min_edits"), F.count_if("enabled").alias("rows_when_disabled"))


@query("SELECT digest_date, wiki, title, r1_alerts, r5_alerts FROM digest")
def left_join_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir, stored=True).digest.select("digest_date", "wiki", "title", "r1_alerts", "r5_alerts")


@query("SELECT meta_id, rule_id FROM alerts WHERE event_id % 10 = 0")
def anti_missing_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every tenth event's alerts are taken away, exactly those are reported."""
    run = Run(spark, sf_dir, stored=True)
    kept = run.alerts.where(F.substring("meta_id", 4, 20).cast("long") % 10 != 0)
    return run.alerts.select("meta_id", "rule_id").join(kept.select("meta_id", "rule_id"), ["meta_id", "rule_id"], "left_anti")


@query("SELECT meta_id FROM ev WHERE event_id % 50 = 0")
def anti_bronze_not_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    return quality.missing_ids(run.bronze, run.silver.where(F.substring("meta_id", 4, 20).cast("long") % 50 != 0))


@query("SELECT meta_id FROM ev WHERE event_id % 4 = 3")
def merge_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    number = F.substring("meta_id", 4, 20).cast("long")
    return merge.missing(layers.to_silver(run.topic).dropDuplicates(["meta_id"]), run.silver.where(number % 4 != 3), "meta_id").select("meta_id")


@query("SELECT minute, final_edits, realtime_edits FROM merged")
def full_outer_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir, stored=True)
    return reports.merged_minutes(run.minutes, run.realtime)


_AVERAGES = """SELECT w.title, w.category, CAST(coalesce(t, 0) AS BIGINT) AS total_edits, round_even(coalesce(t, 0) / CAST(greatest((SELECT count(*) FROM hours), 1) AS DOUBLE), 3) AS avg_edits_per_recorded_hour
FROM watch w LEFT JOIN (SELECT title, sum(edits) AS t FROM pages GROUP BY 1) p ON w.title = p.title"""


@query(_AVERAGES)
def left_watchlist_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir, stored=True)
    return reports.page_averages(run.watchlist, reports.page_activity(run.silver, run.watchlist), reports.recorded_hours(run.minutes))


@query("""SELECT meta_id AS id, event_ts AS ts FROM ev WHERE event_id % 9 = 4 AND event_ts BETWEEN (SELECT min(event_ts) FROM ev WHERE event_id % 9 <> 4) + INTERVAL 60 SECOND AND (SELECT max(event_ts) FROM ev WHERE event_id % 9 <> 4) - INTERVAL 60 SECOND
 AND event_ts BETWEEN (SELECT min(event_ts) FROM ev) + INTERVAL 60 SECOND AND (SELECT max(event_ts) FROM ev) - INTERVAL 60 SECOND""")
def overlap_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = feed.base_events(spark, sf_dir).select(F.col("meta_id").alias("id"), F.col("event_ts").alias("ts"), "event_id")
    return quality.overlap_missing(e.where("event_id % 9 <> 4").drop("event_id"), e.drop("event_id"))


@query("""SELECT minute, final_edits, realtime_edits, CASE WHEN final_edits > coalesce(realtime_edits, 0) THEN coalesce(realtime_edits, 0) END AS gap_from, CASE WHEN final_edits > coalesce(realtime_edits, 0) THEN final_edits END AS gap_to
FROM (SELECT unnest(CASE WHEN date_diff('minute', a, b) < 400 THEN generate_series(a, b, INTERVAL 1 MINUTE) ELSE m END) AS minute FROM (SELECT min(minute) AS a, max(minute) AS b, list(minute) AS m FROM merged)) g LEFT JOIN merged USING (minute)""")
def minute_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.minute_series(full_outer_minutes(spark, sf_dir))


@query("SELECT t.title, h.hour, CAST(coalesce(sum(p.edits), 0) AS BIGINT) AS edits FROM (SELECT DISTINCT title FROM watch) t CROSS JOIN hours h LEFT JOIN pages p ON p.title = t.title AND p.hour = h.hour GROUP BY 1, 2")
def hour_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir, stored=True)
    return reports.page_hours(reports.page_activity(run.silver, run.watchlist), reports.recorded_hours(run.minutes), run.watchlist)


# ---- aggregates -------------------------------------------------------------------------------------------------------


@query("SELECT window_start, wiki, edits, bot_edits, bytes_changed, window_end FROM minutes")
def edits_per_min_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).minutes


@query("SELECT hour_start, wiki, edits, bot_edits, human_edits, bot_share FROM hourly")
def bot_ratio_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).hourly


@query("SELECT alert_id, rule_id, severity, wiki, title, category, owner_team, window_start, window_end, edits, first_edit_ts, last_edit_ts FROM bursts")
def burst_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir).bursts


@query("SELECT * FROM activity")
def digest_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir, stored=True)
    return gold.digest_activity(run.silver, run.watchlist)


@query("SELECT * FROM ruledays")
def digest_rule_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.digest_rules(Run(spark, sf_dir, stored=True).alerts)


@query("SELECT * FROM burstdays")
def digest_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.digest_bursts(Run(spark, sf_dir, stored=True).bursts)


@query("SELECT * FROM digest")
def daily_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Run(spark, sf_dir, stored=True).digest


@query("SELECT window_start AS minute, CAST(sum(edits) AS BIGINT) AS edits FROM minutes WHERE window_start >= (SELECT now - INTERVAL 6 HOUR FROM run) GROUP BY 1")
def edits_by_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    return reports.edits_by_minute(run.minutes.where(F.col("window_start") >= F.lit(run.now).cast("timestamp_ntz") - F.expr("INTERVAL 6 HOUR")))


@query("SELECT * FROM bothours")
def bot_share_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.bot_share(Run(spark, sf_dir).hourly)


@query("SELECT hour FROM hours")
def recorded_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recorded_hours(Run(spark, sf_dir).minutes)


@query("SELECT title, category, hour, edits FROM pages")
def page_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    return reports.page_activity(run.silver, run.watchlist)


@query("SELECT (SELECT count(*) FROM topic) AS bronze, (SELECT count(*) FROM ev) AS silver_unique, (SELECT count(*) FROM received WHERE kind IN ('bad', 'broken')) AS dlq")
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    return reports.funnel(run.bronze, run.dlq)


@query("""WITH f AS (SELECT (SELECT count(*) FROM topic) AS bronze, (SELECT count(*) FROM ev) AS u, (SELECT count(*) FROM received WHERE kind IN ('bad', 'broken')) AS dlq)
SELECT step, rows, duplicates_removed, rows / CAST(top AS DOUBLE) AS share FROM (SELECT unnest(['received', 'bronze', 'silver_unique', 'dlq']) AS step, unnest([bronze + dlq, bronze, u, dlq]) AS rows, bronze - u AS duplicates_removed, bronze + dlq AS top FROM f)""")
def funnel_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.funnel_steps(funnel(spark, sf_dir))


@query("SELECT (SELECT max(ingested_at) FROM topic) AS bronze, (SELECT max(event_ts) FROM silver) AS silver, (SELECT max(window_start) FROM realtime) AS gold")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir, stored=True)
    return reports.freshness(run.bronze, run.silver, run.realtime)


_SECONDS = "date_diff('millisecond', event_ts, detected_at) / 1000.0"


@query(f"SELECT count(*) AS samples, round(quantile_cont({_SECONDS}, 0.5), 1) AS p50, round(quantile_cont({_SECONDS}, 0.95), 1) AS p95 FROM alerts WHERE ingested_at < event_ts + INTERVAL 10 MINUTE")
def detection_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.detection_latency(Run(spark, sf_dir).alerts)


_BIN = f"CASE WHEN {_SECONDS} > 0 THEN CAST(floor(ln({_SECONDS}) / ln(1.01)) AS BIGINT) ELSE -2147483648 END"


@query(f"""WITH b AS (SELECT {_BIN} AS bin, count(*) AS n FROM alerts WHERE ingested_at < event_ts + INTERVAL 10 MINUTE AND event_ts >= (SELECT date_trunc('hour', now - INTERVAL 7 DAY) FROM run) GROUP BY 1),
u AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS upto, sum(n) OVER () AS total FROM b), v AS (SELECT *, CASE WHEN bin = -2147483648 THEN 0 ELSE round(pow(1.01, bin + 0.5), 3) END AS value FROM u)
SELECT CAST(coalesce(max(total), 0) AS BIGINT) AS samples, min(value) FILTER (WHERE upto >= ceil(0.5 * total)) AS p50, min(value) FILTER (WHERE upto >= ceil(0.95 * total)) AS p95, true AS within FROM v""")
def detection_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the last 7 days from sketches that each hour stored, and whether they are within their error of the exact ones."""
    run, path = Run(spark, sf_dir, stored=True), folder(spark, "latencies")
    on_time = run.alerts.where(~S.arrived_late(F.col("ingested_at"), F.col("event_ts")))
    sketches.store_latencies(on_time, path)
    bound = incremental.lower_bound(run.now, "hour", first=True)
    found = sketches.latency_percentiles(spark, path, bound, {"p50": 0.5, "p95": 0.95})
    exact = reports.values_at(on_time.where(F.col("event_ts") >= F.lit(bound)).select(F.timestamp_diff("MILLISECOND", F.col("event_ts"), F.col("detected_at")).alias("v")), {f"_{q}": (lambda n, q=q: F.greatest(F.ceil(n * q) - 1, F.lit(0))) for q in (0.5, 0.95)})
    near = lambda c, q: F.abs(F.col(c) - F.greatest(F.col(f"`_{q}`"), F.lit(0)) / 1000) <= sketches.ERROR * F.greatest(F.col(f"`_{q}`"), F.lit(0)) / 1000 + 0.0005
    return found.crossJoin(exact).select("samples", "p50", "p95", F.coalesce(near("p50", 0.5) & near("p95", 0.95), F.lit(True)).alias("within"))


@query("""SELECT count(*) AS bronze, true AS within FROM topic WHERE date_trunc('hour', ingested_at) >= (SELECT date_trunc('hour', now - INTERVAL 12 HOUR) FROM run)""")
def funnel_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct ids of 12 hours from what each hour stored, and whether the estimate is within its error of the exact count."""
    run, path = Run(spark, sf_dir), folder(spark, "ids")
    sketches.store_ids(run.bronze, path)
    bound = incremental.lower_bound(run.now - timedelta(hours=12), "hour", since=run.now - timedelta(hours=12))
    found = sketches.distinct_ids(spark, path, bound)
    exact = run.bronze.where(F.date_trunc("hour", "ingested_at").cast("timestamp_ntz") >= F.lit(bound)).agg(F.countDistinct("meta_id").alias("exact"))
    within = F.abs(F.col("ids") - F.col("exact")) <= F.greatest(F.lit(1.0), sketches.ID_ERROR * F.col("exact"))
    return found.crossJoin(exact).select("bronze", within.alias("within"))


@query(f"WITH s AS (SELECT list_sort(list({_SECONDS})) AS l, median({_SECONDS}) AS p50 FROM alerts) SELECT p50, l[CAST(greatest(round_even(0.95 * len(l), 0) - 1, 0) AS INTEGER) + 1] AS p95, l[len(l)] AS max FROM s")
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latency_summary(Run(spark, sf_dir).alerts)


@query("""SELECT (SELECT count(*) % 2 = 1 FROM ev WHERE edit_type = 'log') AS r1_enabled, true AS r2_enabled, (SELECT count(*) % 2 = 1 FROM ev WHERE edit_type = 'new') AS r3_enabled, true AS r4_enabled,
(SELECT CAST(quantile_disc(length_old, 0.5) AS BIGINT) FROM ev) AS r2_min_bytes, (SELECT count(*) FROM silver WHERE edit_type = 'edit' AND editor_type <> 'bot' AND (byte_delta <= -(SELECT quantile_disc(length_old, 0.5) FROM ev) OR (length_old > 0 AND 10 * (length_old - length_new) > 2 * length_old))) AS edits""")
def rules_pivot_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that follow the data (the limit is the median length, two are on if there is an odd number of edits of their kind) as one row, beside the edits that R2
    finds with it."""
    run = Run(spark, sf_dir)
    e = feed.base_events(spark, sf_dir)
    odd = e.agg((F.count_if(F.col("edit_type") == "log") % 2 == 1).alias("R1"), (F.count_if(F.col("edit_type") == "new") % 2 == 1).alias("R3"))
    median = reports.values_at(e.select(F.col("length_old").alias("v")), {"least": lambda n: F.greatest(F.ceil(n * 0.5) - 1, F.lit(0))}).select("least")
    rules = run.rules.crossJoin(F.broadcast(odd)).crossJoin(F.broadcast(median))  # one row each
    on = F.when(F.col("rule_id") == "R1", F.col("R1")).when(F.col("rule_id") == "R3", F.col("R3")).otherwise(F.col("enabled"))
    rules = rules.withColumns({"enabled": on, "min_removed_bytes": F.when(F.col("rule_id") == "R2", F.col("least")).otherwise(F.col("min_removed_bytes"))}).select(*run.rules.columns)
    row = A.rule_row(rules)
    judged = run.silver.crossJoin(F.broadcast(row)).where(S.rule_r2(F.col("r2_min_bytes"), F.lit("0.2").cast("decimal(10,4)"))).agg(F.count("*").alias("edits"))
    return judged.crossJoin(row).select("r1_enabled", "r2_enabled", "r3_enabled", "r4_enabled", "r2_min_bytes", "edits")


_TORN = """torn AS (SELECT kafka_partition, kafka_offset, event_ts FROM (SELECT t.*, e.event_ts, unnest(range(CASE WHEN e.user_id % 11 = 3 THEN 0 WHEN e.user_id % 13 = 5 THEN 2 ELSE 1 END)) AS copy
  FROM topic t JOIN (SELECT 'ev-' || event_id AS meta_id, ts AS event_ts, user_id FROM events) e ON t.meta_id = e.meta_id))"""


def _torn(run: Run) -> DataFrame:
    """The raw layer without the records of some users, and with those of others twice."""
    users = run.spark.read.parquet(f"{run.sf_dir}/events.parquet").select(F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("meta_id"), "user_id")
    copies = F.when(F.col("user_id") % 11 == 3, 0).when(F.col("user_id") % 13 == 5, 2).otherwise(1)
    return run.bronze.join(users, "meta_id").withColumn("_n", F.explode(F.array_repeat(F.lit(1), copies))).drop("_n", "user_id")


@query(f"""WITH {_TORN} SELECT kafka_partition, min(kafka_offset) AS first, max(kafka_offset) AS last, count(*) AS rows, count(DISTINCT kafka_offset) AS distinct_offsets,
count(*) > count(DISTINCT kafka_offset) AS repeats, NOT (min(kafka_offset) = 0 AND count(DISTINCT kafka_offset) = max(kafka_offset) + 1) AS gap FROM torn GROUP BY 1""")
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a raw layer that lacks some records and has others twice."""
    return quality.offset_gaps(_torn(Run(spark, sf_dir)))


@query("SELECT count(*) AS duplicates FROM received WHERE kind = 'copy'")
def dup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicates(Run(spark, sf_dir).bronze)


@query("SELECT CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'failed' ELSE 'success' END AS status, count(*) FILTER (WHERE event_type IN ('view', 'click')) AS models_ok, count(*) FILTER (WHERE event_type IN ('signup', 'purchase')) AS tests_ok, count(*) FILTER (WHERE event_type = 'error') AS failures FROM events")
def model_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run results as a model runner would report them: one a row of events."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    is_model = F.col("event_type").isin("view", "click")
    results = e.select(
        F.concat(F.when(is_model, "model.").otherwise("test."), F.col("event_id").cast("string")).alias("unique_id"), F.when(F.col("event_type") == "error", "fail").when(is_model, "success").otherwise("pass").alias("status")
    )
    return ops.run_status(results)


@query("SELECT severity, count(*) AS alerts, max(event_ts) AS newest FROM allalerts GROUP BY 1")
def severity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.severity_summary(_union(Run(spark, sf_dir, stored=True)))


@query("SELECT window_start, wiki, edits, bot_edits, bytes_changed FROM minutes")
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute counts by another way: straight from the payloads, without typed rows or models."""
    f = lambda p: F.get_json_object("raw", f"$.{p}")
    r = Run(spark, sf_dir).topic.select(
        f("meta.id").alias("id"), f("meta.dt").alias("dt"), f("wiki").alias("wiki"), f("type").alias("type"), f("bot").alias("bot"), f("length.old").cast("long").alias("o"), f("length.new").cast("long").alias("n")
    )
    r = r.where("type in ('edit', 'new')").dropDuplicates(["id"]).withColumn("window_start", F.to_timestamp_ntz(F.concat(F.substring("dt", 1, 16), F.lit(":00"))))
    delta = F.when(F.col("type") == "new", F.col("n")).otherwise(F.abs(F.col("n") - F.col("o")))
    return r.groupBy("window_start", "wiki").agg(F.count("*").alias("edits"), F.count_if(F.col("bot") == "true").alias("bot_edits"), F.sum(delta).alias("bytes_changed"))


@query("SELECT least(count(*), 500) AS alerts, (SELECT least(count(*), 500) FROM digest) AS digest, (SELECT count(*) FROM merged) AS edits_per_min FROM allalerts")
def snapshot_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir, stored=True)
    size = lambda df, name: df.agg(F.count("*").alias(name))
    return size(reports.top_alerts(_union(run)), "alerts").crossJoin(size(reports.top_digest(run.digest), "digest")).crossJoin(size(full_outer_minutes(spark, sf_dir), "edits_per_min"))


# ---- order, limits, sets ----------------------------------------------------------------------------------------------


@query("SELECT meta_id, kafka_offset FROM topic WHERE kind = 'base'")
def first_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.first_copy(Run(spark, sf_dir).bronze).select("meta_id", "kafka_offset")


@query("SELECT meta_id, wiki FROM ev")
def dedup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.to_silver(Run(spark, sf_dir).topic).dropDuplicates(["meta_id"]).select("meta_id", "wiki")


def _union(run: Run) -> DataFrame:
    return reports.alerts_union(run.alerts, run.bursts, run.rules)


_UNION = "alert_id, rule_id, rule_name, severity, wiki, title, category, owner_team, edit_type, log_action, editor_type, byte_delta, edits_in_window, event_ts, detected_at, revision_old, revision_new, arrived_late"


@query(f"SELECT {_UNION} FROM allalerts")
def alerts_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(Run(spark, sf_dir, stored=True))


@query("SELECT alert_id, severity, event_ts FROM allalerts ORDER BY CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, event_ts DESC, alert_id LIMIT 500")
def alerts_top500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_alerts(_union(Run(spark, sf_dir, stored=True))).select("alert_id", "severity", "event_ts")


@query("SELECT digest_date, wiki, title, edits FROM digest ORDER BY digest_date DESC, edits DESC, wiki, title LIMIT 500")
def digest_top500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_digest(Run(spark, sf_dir, stored=True).digest).select("digest_date", "wiki", "title", "edits")


@query("SELECT title, category, hour, edits FROM pages ORDER BY hour DESC, edits DESC, title, category LIMIT 3000")
def activity_top3000(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_activity(page_activity(spark, sf_dir))


@query("SELECT hour FROM hours ORDER BY hour DESC LIMIT 200")
def tail_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.last_rows(recorded_hours(spark, sf_dir), "hour", 200)


@query(f"SELECT title, category, total_edits, avg_edits_per_recorded_hour, CAST(row_number() OVER (ORDER BY total_edits DESC, title, category) AS INTEGER) AS place FROM ({_AVERAGES})")
def pages_by_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pages_by_activity(left_watchlist_totals(spark, sf_dir))


@query("SELECT w.title, w.category, count(e.meta_id) AS edits FROM watch w LEFT JOIN ev e ON e.wiki = w.wiki AND e.title = w.title GROUP BY 1, 2")
def watchlist_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and category by title, with the events of each page."""
    run = Run(spark, sf_dir)
    n = feed.base_events(spark, sf_dir).groupBy("wiki", "title").agg(F.count("*").alias("n"))
    return run.watchlist.join(n, ["wiki", "title"], "left").select("title", "category", F.coalesce("n", F.lit(0)).alias("edits")).orderBy("title")


@query("SELECT alert_id, rule_id, severity, meta_id, wiki, title, category, owner_team, edit_type, log_action, editor_type, byte_delta, revision_old, revision_new, event_ts, ingested_at, is_late FROM alerts")
def rules_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    return A.find_alerts(run.silver, run.watchlist, run.rules)


@query("SELECT meta_id, rule_id FROM alerts")
def expected_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second implementation of the rules, with no alert known: every match."""
    run = Run(spark, sf_dir, stored=True)
    return A.reconcile(run.silver, run.watchlist, run.rules, run.alerts.limit(0))


@query("SELECT meta_id, rule_id, 'missing' AS side FROM alerts WHERE event_id % 11 = 0 AND event_id % 13 <> 0 UNION ALL SELECT meta_id, rule_id, 'unexpected' FROM alerts WHERE event_id % 13 = 0 AND event_id % 11 <> 0")
def set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = Run(spark, sf_dir).alerts.select("meta_id", "rule_id", F.substring("meta_id", 4, 20).cast("long").alias("i"))
    return reports.set_difference(a.where("i % 13 <> 0").drop("i"), a.where("i % 11 <> 0").drop("i"))




# ---- checks -----------------------------------------------------------------------------------------------------------


@query("SELECT meta_id, 2 AS n FROM ev WHERE event_id % 100 = 99")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_unique(Run(spark, sf_dir).bronze, "meta_id")


@query("SELECT meta_id FROM silver WHERE user_name IS NULL")
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.nulls(Run(spark, sf_dir).silver, "user_name").select("meta_id")


@query("SELECT editor_type AS value, count(*) AS n FROM silver WHERE editor_type = 'bot' GROUP BY 1")
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_accepted(Run(spark, sf_dir).silver, "editor_type", ("registered", "unregistered"))


@query("SELECT wiki, title, namespace, count(*) AS n FROM silver GROUP BY 1, 2, 3 HAVING count(*) > 1")
def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_unique(Run(spark, sf_dir).silver, "wiki", "title", "namespace")


@query("SELECT meta_id, rule_id FROM alerts WHERE event_id % 17 = 0")
def dq_reconcile_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of every seventeenth event are taken away: the check finds just those."""
    run = Run(spark, sf_dir, stored=True)
    return A.reconcile(run.silver, run.watchlist, run.rules, run.alerts.where(F.substring("meta_id", 4, 20).cast("long") % 17 != 0))


@query("SELECT alert_id FROM bursts WHERE edits = 2")
def dq_burst_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of bursts with two edits are made a minute too long: the check finds just those."""
    run = Run(spark, sf_dir)
    longer = F.when(F.col("edits") == 2, F.col("window_end") + F.expr("INTERVAL 1 MINUTE")).otherwise(F.col("window_end"))
    return quality.burst_window_errors(run.bursts.withColumn("window_end", longer), run.rules).select("alert_id")


@query("SELECT 'duplicate page' AS problem, count(*) AS n FROM (SELECT wiki, title FROM ev GROUP BY 1, 2 HAVING count(*) > 1) UNION ALL SELECT 'blank field', count(*) FROM silver WHERE user_name IS NULL UNION ALL SELECT 'unknown category', count(*) FROM ev WHERE edit_type <> 'new'")
def dq_watchlist_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed's checks on a large bad file: every event as a page."""
    s = Run(spark, sf_dir).silver
    return quality.watchlist_errors(s.select("wiki", "title", F.when(F.col("edit_type") == "new", "product").otherwise(F.col("edit_type")).alias("category"), F.col("user_name").alias("owner_team")))


@query("""SELECT problem, found FROM (SELECT 'rule missing or repeated' AS problem, (SELECT count(*) FROM range(1, 6) r WHERE (SELECT count(*) FROM events WHERE event_id % 6 + 1 = r.range) <> 1) AS found
UNION ALL SELECT 'unknown rule', count(*) FROM events WHERE event_id % 6 = 5 UNION ALL SELECT 'unknown severity', count(*) FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'enabled not set', count(*) FROM events WHERE user_id % 3 = 0 UNION ALL SELECT 'R2 without limits', count(*) FROM events WHERE event_id % 6 = 1 AND event_type <> 'view'
UNION ALL SELECT 'R5 without limits', count(*) FROM events WHERE event_id % 6 = 4 AND user_id % 8 = 7 UNION ALL SELECT 'R5 window does not divide an hour', count(*) FROM events WHERE event_id % 6 = 4 AND user_id % 8 IN (0, 7)) WHERE found > 0""")
def dq_rules_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules' checks on a large bad file: every event as a rule."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    rules = e.select(
        F.concat(F.lit("R"), (F.col("event_id") % 6 + 1).cast("string")).alias("rule_id"), F.when(F.col("event_type") == "error", "high").otherwise(F.col("event_type")).alias("severity"),
        F.when(F.col("event_type") == "view", 2000).cast("long").alias("min_removed_bytes"), F.lit("0.2").cast("decimal(10,4)").alias("min_removed_fraction"), F.lit(5).alias("min_edits"),
        F.when(F.col("user_id") % 8 != 7, F.element_at(F.array(*map(F.lit, (7, 1, 2, 3, 4, 5, 6, 10))), (F.col("user_id") % 8 + 1).cast("int"))).alias("window_minutes"),
        F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 2 == 0).alias("enabled"),
    )
    return quality.rules_errors(rules)


@query("""SELECT document, problem, CAST(found AS BIGINT) AS found FROM (
SELECT 'alerts' AS document, 'alerts[].severity: enum' AS problem, (SELECT count(*) FROM top WHERE severity = 'high') AS found UNION ALL SELECT 'alerts', 'alerts[].title: type', (SELECT count(*) FROM top WHERE title = 'Page 1')
UNION ALL SELECT 'alerts', 'digest[].title: type', (SELECT count(*) FROM (SELECT * FROM digest ORDER BY digest_date DESC, edits DESC, wiki, title LIMIT 500) WHERE title = 'Page 1')
UNION ALL SELECT 'alerts', 'alerts: maxItems', (SELECT CASE WHEN count(*) > 500 THEN 1 ELSE 0 END FROM allalerts)
UNION ALL SELECT 'baseline', 'bot_share_hourly[].bot_share: maximum', (SELECT count(*) FROM (SELECT * FROM bothours ORDER BY hour DESC LIMIT 200) WHERE bot_share < 1)
UNION ALL SELECT 'baseline', 'page_averages[].title: required', 5 UNION ALL SELECT 'baseline', 'page_averages[]: additionalProperties', 5
UNION ALL SELECT 'health', 'lag[].lag: required', (SELECT count(DISTINCT event_id % 3) FROM events) UNION ALL SELECT 'health', 'lag[]: additionalProperties', (SELECT count(DISTINCT event_id % 3) FROM events)
UNION ALL SELECT 'health', 'funnel.dlq: minimum', 1 UNION ALL SELECT 'meta', 'dbt.status: enum', 1 UNION ALL SELECT 'meta', 'snapshots.alerts: minimum', (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM allalerts)
) WHERE found > 0""".replace("FROM top", "FROM (SELECT * FROM allalerts ORDER BY CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, event_ts DESC, alert_id LIMIT 501) x"))
def dq_snapshot_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four documents with broken values, missing and unknown fields, wrong types, nested ones too, and a list over its cap."""
    run = Run(spark, sf_dir, stored=True)
    now = F.lit(run.now).cast("timestamp_ntz")
    union = stored_as(reports.top_alerts(_union(run), 501), "top")  # counted and exported
    meta = export.meta_document(spark, model_run_status(spark, sf_dir), {"alerts": {"alerts": union.count()}}, None, now)
    broken = {
        "alerts": (export.alerts_document(union, reports.top_digest(run.digest), now), [('"severity":"high"', '"severity":"urgent"'), ('"title":"Page 1"', '"title":1')]),
        "baseline": (_baseline(run), [('"bot_share":0.', '"bot_share":7.'), ('"title":(?="Page [0-9]","total_edits")', '"name":')]),
        "health": (_health(run), [('"lag":(?!\\[)', '"behind":'), ('"dlq":', '"dlq":-')]),
        "meta": (meta, [('"status":"(failed|success)"', '"status":"odd"'), ('"alerts":', '"alerts":-')]),
    }
    out = None
    for name, (doc, changes) in broken.items():
        path, text = folder(spark, name), F.col("value")
        doc.select("json").write.text(path)
        for old, new in changes:
            text = F.regexp_replace(text, old, F.lit(new))
        found = documents.violations(spark.read.text(path).select(text.alias("json")), name).select(F.lit(name).alias("document"), "problem", "found")
        out = found if out is None else out.unionByName(found)
    return out


@query(f"""WITH {_TORN}, o AS (SELECT kafka_partition, min(kafka_offset) AS a, max(kafka_offset) AS z, count(*) AS n, count(DISTINCT kafka_offset) AS k FROM torn GROUP BY 1),
h AS (SELECT kafka_partition, max(kafka_offset) + 1 AS high FROM topic GROUP BY 1), ids AS (SELECT event_id, user_id FROM events WHERE user_id % 11 <> 3)
SELECT "check", CAST(found AS BIGINT) AS found, found = 0 AS passed FROM (SELECT 'offset gaps' AS "check", (SELECT count(*) FROM o WHERE NOT (a = 0 AND k = z + 1)) AS found
UNION ALL SELECT 'repeated offsets', (SELECT count(*) FROM o WHERE n <> k) UNION ALL SELECT 'partitions behind', (SELECT count(*) FROM h LEFT JOIN o USING (kafka_partition) WHERE z IS NULL OR high - z - 1 > 0)
UNION ALL SELECT 'ids not in the typed layer', (SELECT count(*) FROM ids WHERE event_id % 50 = 0) UNION ALL SELECT 'repeated ids in the typed layer', (SELECT count(*) FROM ev WHERE event_id % 50 <> 0 AND event_id % 17 = 1))""")
def dq_bronze_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on layers that are broken on purpose: records missing and doubled in the raw one, ids missing and doubled in the typed one."""
    run = Run(spark, sf_dir)
    number = F.substring("meta_id", 4, 20).cast("long")
    highs = run.topic.groupBy("kafka_partition").agg((F.max("kafka_offset") + 1).alias("high"))
    typed = run.silver.where(number % 50 != 0)
    return quality.bronze_report(_torn(run), typed.unionByName(typed.where(number % 17 == 1)), highs)


@query("""WITH d AS (SELECT now - INTERVAL 7 DAY AS week, now - INTERVAL 12 HOUR AS half FROM run), w AS (SELECT * FROM silver, d WHERE event_ts >= week)
SELECT 'edits_per_minute' AS report, (SELECT count(*) FROM (SELECT DISTINCT date_trunc('minute', event_ts), wiki FROM w WHERE edit_type <> 'log')) AS rows, 1 AS tables, 0 AS free
UNION ALL SELECT 'bot_ratio_hourly', (SELECT count(*) FROM (SELECT DISTINCT date_trunc('hour', event_ts), wiki FROM w WHERE edit_type <> 'log')), 1, 0
UNION ALL SELECT 'page_activity', (SELECT count(*) FROM (SELECT DISTINCT title, category, date_trunc('hour', event_ts) FROM watched, d WHERE event_ts >= week AND edit_type <> 'log')), 1, 0
UNION ALL SELECT 'daily_digest', (SELECT count(*) FROM (SELECT DISTINCT CAST(event_ts AS DATE), wiki, title FROM watched, d WHERE event_ts >= week)), 3, 0
UNION ALL SELECT 'detection_latency', 1, 1, 0 UNION ALL SELECT 'severities', (SELECT count(DISTINCT severity) FROM alerts, d WHERE event_ts >= week), 1, 0
UNION ALL SELECT 'funnel', 1, 2, 0 UNION ALL SELECT 'freshness', 1, 2, 0 UNION ALL SELECT 'by no bound', (SELECT count(*) FROM silver), 1, 1 UNION ALL SELECT 'by a function', (SELECT count(*) FROM silver, d WHERE event_ts >= date_trunc('day', week)), 1, 1""")
def dq_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report over the stored layers: its rows, the tables that its plan reads, and those that nothing bounds. Two more are free on purpose: they must show."""
    run, root = Run(spark, sf_dir, stored=True), folder(spark, "warehouse")
    for layer, rows in (("bronze", run.bronze), ("dlq", run.dlq), ("silver", run.silver), ("alerts", run.alerts), ("bursts", run.bursts)):
        warehouse.store(rows, root, layer)
    house = warehouse.Warehouse(spark, root, run.now.replace(tzinfo=None), run.watchlist)
    week = (run.now - warehouse.WEEK).strftime("%Y%m%d")
    free = {
        "by no bound": lambda w: spark.read.parquet(f"{root}/silver").select("meta_id"),
        "by a function": lambda w: spark.read.parquet(f"{root}/silver").where(F.date_format("event_ts", "yyyyMMdd") >= week).select("meta_id"),
    }
    chosen, out = warehouse.REPORTS | free, None
    for name, found in warehouse.audit(house, chosen).items():
        counts = {"tables": F.lit(len({s.table for s in found})), "free": F.lit(len({s.table for s in found if not s.bounded_by}))}
        own = chosen[name](house).agg(F.lit(name).alias("report"), F.count("*").alias("rows")).withColumns(counts)
        out = own if out is None else out.unionByName(own)
    return out


@query("SELECT alert_id, rule_id FROM alerts WHERE event_id % 19 = 0")
def dq_alert_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported late flags of every nineteenth event are turned: the check finds just those."""
    run = Run(spark, sf_dir, stored=True)
    wrong = run.alerts.where(F.substring("meta_id", 4, 20).cast("long") % 19 == 0).select(F.col("alert_id").alias("w"))
    union = _union(run).join(wrong, F.col("alert_id") == F.col("w"), "left")
    exported = union.withColumn("arrived_late", F.when(F.col("w").isNotNull(), ~F.col("arrived_late")).otherwise(F.col("arrived_late"))).drop("w")
    return quality.alert_link_errors(exported, run.alerts)


# ---- exports ----------------------------------------------------------------------------------------------------------


def _alerts(run: Run) -> DataFrame:
    return export.alerts_document(reports.top_alerts(_union(run)), reports.top_digest(run.digest), F.lit(run.now).cast("timestamp_ntz"))


@query("SELECT least(count(*), 500) AS alerts, (SELECT least(count(*), 500) FROM digest) AS digest, 7 AS window_days, 1 AS schema_version, (SELECT now FROM run) AS generated_at FROM allalerts")
def export_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts document, written after its checks and read again."""
    path = folder(spark, "alerts")
    export.publish(_alerts(Run(spark, sf_dir, stored=True)), "alerts", path)
    v = spark.read.text(path).select(F.from_json("value", "alerts array<struct<alert_id: string>>, digest array<struct<wiki: string>>, window_days int, schema_version int, generated_at string").alias("v"))
    return v.select(F.size("v.alerts").cast("long").alias("alerts"), F.size("v.digest").cast("long").alias("digest"), "v.window_days", "v.schema_version", S.parse_utc(F.col("v.generated_at")).alias("generated_at"))


def _baseline(run: Run) -> DataFrame:
    activity, hours = reports.page_activity(run.silver, run.watchlist), reports.recorded_hours(run.minutes)
    iso = lambda df, c: df.withColumn(c, S.iso_utc(F.col(c)))
    last_hours = reports.last_rows(hours, "hour", 200)
    parts = {
        "edits_per_min": export.as_array(iso(reports.merged_minutes(run.minutes, run.realtime), "minute"), ["minute", "final_edits", "realtime_edits"], ["minute"], "edits_per_min"),
        "bot_share_hourly": export.as_array(iso(reports.last_rows(reports.bot_share(run.hourly), "hour", 200), "hour"), ["hour", "edits", "bot_edits", "bot_share"], ["hour"], "bot_share_hourly"),
        "page_activity": export.as_array(reports.top_activity(activity).withColumns({"_h": -F.unix_timestamp(F.col("hour").cast("timestamp")), "hour": S.iso_utc(F.col("hour"))}), ["title", "category", "hour", "edits"], ["_h", (-F.col("edits")).alias("e"), "title", "category"], "page_activity"),
        "page_averages": export.as_array(reports.page_averages(run.watchlist, activity, last_hours), ["title", "category", "total_edits", "avg_edits_per_recorded_hour"], ["title", "category"], "page_averages"),
        "recorded_hours": iso(last_hours, "hour").agg(F.array_sort(F.collect_list("hour")).alias("recorded_hours")),
    }
    return export.document(parts, F.lit(run.now).cast("timestamp_ntz"))


@query("SELECT (SELECT count(*) FROM merged) AS edits_per_min, (SELECT least(count(*), 200) FROM hours) AS recorded_hours, (SELECT least(count(*), 3000) FROM pages) AS page_activity, (SELECT count(*) FROM watch) AS page_averages")
def export_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline document, written after its checks and read again."""
    path = folder(spark, "baseline")
    export.publish(_baseline(Run(spark, sf_dir, stored=True)), "baseline", path)
    shape = "edits_per_min array<struct<minute: string>>, recorded_hours array<string>, page_activity array<struct<title: string>>, page_averages array<struct<title: string>>"
    v = spark.read.text(path).select(F.from_json("value", shape).alias("v"))
    return v.select(*[F.size(f"v.{c}").cast("long").alias(c) for c in ("edits_per_min", "recorded_hours", "page_activity", "page_averages")])


def _health(run: Run) -> DataFrame:
    one = lambda df, name: df.select(F.struct(*[F.col(c) for c in sorted(df.columns)]).alias(name))
    fresh = reports.freshness(run.bronze, run.silver, run.realtime)
    fresh = fresh.select(*[S.iso_utc(F.col(c)).alias(c) for c in fresh.columns])
    recent = _recent(run.spark, run.sf_dir)
    parts = {
        "freshness": one(fresh, "freshness"),
        "funnel": one(reports.funnel(run.bronze, run.dlq).withColumn("received", F.col("bronze") + F.col("dlq")), "funnel"),
        "detection_seconds": one(reports.detection_latency(run.alerts), "detection_seconds"),
        "streaming": export.as_array(ops.streaming_stats(recent), ["query", "batches", "input_rows_per_second", "batch_duration_ms_p50", "batch_duration_ms_max"], ["query"], "streaming"),
        "lag": export.as_array(_lag(run.spark, run.sf_dir, recent).withColumnRenamed("kafka_partition", "partition"), ["partition", "latest_offset", "processed_offset", "lag"], ["partition"], "lag"),
    }
    return export.document(parts, F.lit(run.now).cast("timestamp_ntz"))


@query("""SELECT (SELECT count(*) FROM topic) + (SELECT count(*) FROM received WHERE kind IN ('bad', 'broken')) AS received, (SELECT count(*) FROM topic) AS bronze, (SELECT count(*) FROM ev) AS silver_unique,
 (SELECT count(*) FROM alerts WHERE ingested_at < event_ts + INTERVAL 10 MINUTE) AS samples, (SELECT count(DISTINCT event_id % 3) FROM events) AS lag_rows""")
def export_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health document, written after its checks and read again."""
    path = folder(spark, "health")
    export.publish(_health(Run(spark, sf_dir, stored=True)), "health", path)
    shape = "funnel struct<received: bigint, bronze: bigint, silver_unique: bigint>, detection_seconds struct<samples: bigint>, lag array<struct<lag: bigint>>"
    v = spark.read.text(path).select(F.from_json("value", shape).alias("v"))
    return v.select("v.funnel.received", "v.funnel.bronze", "v.funnel.silver_unique", "v.detection_seconds.samples", F.size("v.lag").cast("long").alias("lag_rows"))


_META = "dbt struct<status: string, failures: bigint>, snapshots struct<alerts: bigint, digest: bigint, edits_per_min: bigint, page_activity: bigint>, exports struct<alerts: struct<status: string, failed_query: string>, baseline: struct<status: string, failed_query: string>>"


def _export_run(run: Run, builders: dict) -> tuple[bool, dict[str, str], DataFrame]:
    """Whether the export raised, the paths, and the document about the run, read again."""
    paths, raised = {name: folder(run.spark, name) for name in ("alerts", "baseline", "meta")}, False
    try:
        export.export_run(run.spark, builders, paths, model_run_status(run.spark, run.sf_dir), F.lit(run.now).cast("timestamp_ntz"))
    except export.ExportFailed:
        raised = True
    return raised, paths, run.spark.read.text(paths["meta"]).select(F.from_json("value", _META).alias("m"))


@query("""SELECT export, status, failed_query, "rows", true AS raised, written FROM (VALUES ('alerts', 'ok', CAST(NULL AS VARCHAR), (SELECT least(count(*), 500) FROM allalerts), true), ('baseline', 'failed', 'baseline', CAST(NULL AS BIGINT), false)) t(export, status, failed_query, "rows", written)""")
def export_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document can't be built: the other is written, the run's document tells of both, and the export raises after that."""
    run = Run(spark, sf_dir, stored=True)

    def broken() -> DataFrame:
        raise RuntimeError("this document can't be built")

    raised, paths, meta = _export_run(run, {"alerts": lambda: _alerts(run), "baseline": broken})
    row = lambda name, rows: F.struct(F.lit(name).alias("export"), F.col(f"m.exports.{name}.status").alias("status"), F.col(f"m.exports.{name}.failed_query").alias("failed_query"), F.col(f"m.snapshots.{rows}").alias("rows"), F.lit(merge.table_exists(spark, paths[name])).alias("written"))
    return meta.select(F.explode(F.array(row("alerts", "alerts"), row("baseline", "page_activity"))).alias("e")).select("e.*", F.lit(raised).alias("raised"))


@query("""SELECT (SELECT CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'failed' ELSE 'success' END FROM events) AS status, (SELECT count(*) FROM events WHERE event_type = 'error') AS failures,
 CAST(NULL AS BIGINT) AS alerts, CAST(NULL AS BIGINT) AS digest, (SELECT count(*) FROM merged) AS edits_per_min, (SELECT least(count(*), 3000) FROM pages) AS page_activity, 'failed' AS alerts_export, CAST(NULL AS VARCHAR) AS failed_query, true AS raised""")
def export_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's document beside one that breaks its contract: that has no counts, no query is to blame, and the export raises."""
    run = Run(spark, sf_dir, stored=True)
    odd = lambda: _alerts(run).withColumn("json", F.replace("json", F.lit('"window_days":7'), F.lit('"window_days":8')))
    raised, _, meta = _export_run(run, {"alerts": odd, "baseline": lambda: _baseline(run)})
    counts = [f"m.snapshots.{c}" for c in ("alerts", "digest", "edits_per_min", "page_activity")]
    return meta.select("m.dbt.status", "m.dbt.failures", *counts, F.col("m.exports.alerts.status").alias("alerts_export"), F.col("m.exports.alerts.failed_query").alias("failed_query"), F.lit(raised).alias("raised"))


@query("""SELECT kind, count(*) AS n FROM (SELECT kind FROM received UNION ALL SELECT 'late copy' FROM ev WHERE event_id % 250 = 0 UNION ALL SELECT 'flush' FROM ev WHERE event_id = 0) GROUP BY 1""")
def inject_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with more faults: copies that come ten minutes before the start, and a row that closes all windows."""
    rows = Run(spark, sf_dir).received
    late = rows.where("kind = 'base' and event_id % 250 = 0").withColumns({"kind": F.lit("late copy"), "ingested_at": F.col("ingested_at") - F.expr("INTERVAL 10 MINUTE")})
    flush = rows.where("kind = 'base' and event_id = 0").withColumns({"kind": F.lit("flush"), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 60 DAY")})
    return rows.unionByName(late).unionByName(flush).groupBy("kind").agg(F.count("*").alias("n"))
