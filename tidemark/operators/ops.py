"""Pipeline health: progress records, lag, run status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def recent_progress(log: DataFrame, session: str, now: str, minutes: int = 60) -> DataFrame:
    """Records of the session in the last hour. The log has a partition column dt: only the days that the hour touches are read."""
    end = F.lit(now).cast("timestamp_ntz")
    start = end - F.expr(f"INTERVAL {minutes} MINUTE")
    at = S.parse_utc(F.col("timestamp"))
    days = log.where((F.col("dt") >= F.to_date(start)) & (F.col("dt") <= F.to_date(end)))
    return days.where((F.col("session_id") == session) & at.between(start, end))


def streaming_stats(records: DataFrame) -> DataFrame:
    """For each query: batches, its last input rate that isn't 0, median and greatest trigger time."""
    r = records.withColumn("query", F.coalesce(F.when(F.col("query") != "", F.col("query")), F.lit("unknown")))
    rate = F.when(F.col("input_rows_per_second") > 0, F.struct("timestamp", "batch_id", "input_rows_per_second"))
    return r.groupBy("query").agg(
        F.count("*").alias("batches"),
        F.bround(F.max(rate).getField("input_rows_per_second"), 2).alias("input_rows_per_second"),
        F.median("trigger_ms").alias("batch_duration_ms_p50"),
        F.max("trigger_ms").alias("batch_duration_ms_max"),
    )


def processed_offsets(records: DataFrame, query: str, topic: str) -> DataFrame:
    """kafka_partition, processed_offset: end offsets of the query's newest batch that has any."""
    r = records.where(F.col("query") == query).withColumn("source", F.explode("sources"))
    ends = r.withColumn("ends", F.from_json("source.end_offset", "map<string, map<string, bigint>>").getItem(topic)).where("ends is not null")
    newest = ends.agg(F.max_by("ends", F.struct("timestamp", "batch_id")).alias("ends"))
    return newest.select(F.explode("ends").alias("p", "processed_offset")).select(F.col("p").cast("int").alias("kafka_partition"), "processed_offset")


def lag(highs: DataFrame, processed: DataFrame) -> DataFrame:
    """Latest less processed offset of each partition, 0 at least; null if nothing was processed."""
    out = highs.join(processed, "kafka_partition", "left")
    return out.select("kafka_partition", F.col("high").alias("latest_offset"), "processed_offset", F.when(F.col("processed_offset").isNotNull(), F.greatest(F.col("high") - F.col("processed_offset"), F.lit(0))).alias("lag"))


def lag_total(rows: DataFrame) -> DataFrame:
    """Null if no partition's lag is known."""
    return rows.agg(F.sum("lag").alias("lag"))


def run_status(results: DataFrame) -> DataFrame:
    """results(unique_id, status): counts of good models, good tests and failures; unknown if there are none."""
    is_model = F.col("unique_id").startswith("model.")
    failed = F.col("status").isin("error", "fail", "runtime error")
    out = results.agg(
        F.count("*").alias("_n"), F.count_if(~failed & is_model & (F.col("status") == "success")).alias("models_ok"), F.count_if(~failed & ~is_model & (F.col("status") == "pass")).alias("tests_ok"), F.count_if(failed).alias("failures")
    )
    status = F.when(F.col("_n") == 0, "unknown").when(F.col("failures") > 0, "failed").otherwise("success")
    return out.select(status.alias("status"), "models_ok", "tests_ok", "failures")


def status_flags(fresh: DataFrame, detection: DataFrame, now: F.Column) -> DataFrame:
    """Whether layers are fresh (10 minutes), the pipeline is offline (15 minutes) and detection is within 120 s."""
    both = fresh.crossJoin(detection)
    return both.select(
        *[S.flag_age(F.col(layer), now, 10).alias(f"{layer}_fresh") for layer in ("bronze", "silver", "gold")],
        (~S.flag_age(F.col("bronze"), now, 15)).alias("offline"),
        F.coalesce(F.col("p95") <= 120, F.lit(False)).alias("detection_within_target"),
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count("*").alias("events"))
