"""Sketches that each hour stores once: quantiles of latencies and distinct ids of any span of hours are merges of small rows."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import from_hour
from tidemark.operators.merge import HOUR, HOUR_FORMAT
from tidemark.plans.pruning import bounded

#: Latencies are counted in bins whose ends grow by this ratio; the middle of a bin is off by half of it at most.
RATIO = 1.01
ERROR = 0.0051
_ZERO = -(1 << 31)
#: HyperLogLog with 4,096 registers; an estimate is within four standard errors of 1.63 % with a chance of 0.9999.
LOG2_REGISTERS, ID_ERROR = 12, 0.065


def latency_bin(seconds: Column) -> Column:
    """The bin's number; 0 and less have a bin of their own."""
    return F.when(seconds > 0, F.floor(F.log(seconds) / math.log(RATIO)).cast("long")).otherwise(F.lit(_ZERO))


def _write(rows: DataFrame, path: str) -> None:
    """One file for each hour; hours that come again are replaced, so a run that is repeated changes nothing."""
    rows.repartition(HOUR).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(HOUR).parquet(path)


def store_latencies(alerts: DataFrame, path: str) -> None:
    """For each hour of events (whole hours), how many alerts had a latency in each bin."""
    seconds = F.timestamp_diff("MILLISECOND", F.col("event_ts"), F.col("detected_at")) / 1000
    rows = alerts.select(F.date_format("event_ts", HOUR_FORMAT).alias(HOUR), latency_bin(seconds).alias("bin")).where(F.col(HOUR).isNotNull() & F.col("bin").isNotNull())
    _write(rows.groupBy(HOUR, "bin").agg(F.count("*").alias("n")), path)


def latency_percentiles(spark: SparkSession, path: str, bound: datetime, ranks: dict[str, float]) -> DataFrame:
    """samples, and a column for each rank: seconds, within ERROR of the value at place ceil(rank * samples). Reads the bins of the hours
    from the bound on, never an alert; counts merge by addition, so the result is the same on every run."""
    stored = bounded(spark.read.parquet(path).where(from_hour(bound)), {"latencies": (path, HOUR)})
    bins = stored.groupBy("bin").agg(F.sum("n").alias("n"))  # a few thousand rows at most: bins, not alerts
    one = bins.agg(F.sum("n").alias("samples"), F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"))
    # running sums over the sorted bins: the first whose sum reaches the rank
    def at(rank: float) -> Column:
        need = F.ceil(F.col("samples") * rank)
        start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("long").alias("bin"))
        step = lambda a, b: F.struct((a["upto"] + b["n"]).alias("upto"), F.coalesce(a["bin"], F.when(a["upto"] + b["n"] >= need, b["bin"])).alias("bin"))
        found = F.aggregate("bins", start, step)["bin"]
        return F.when(found == _ZERO, F.lit(0.0)).otherwise(F.round(F.pow(F.lit(RATIO), found + 0.5), 3))

    return one.select(F.coalesce("samples", F.lit(0)).alias("samples"), *(at(rank).alias(name) for name, rank in ranks.items()))


def store_ids(bronze: DataFrame, path: str) -> None:
    """For each hour of ingestion, its rows and a sketch of their ids."""
    rows = bronze.withColumn(HOUR, F.date_format("ingested_at", HOUR_FORMAT)).where(F.col(HOUR).isNotNull())
    _write(rows.groupBy(HOUR).agg(F.count("*").alias("rows"), F.hll_sketch_agg("meta_id", F.lit(LOG2_REGISTERS)).alias("ids")), path)


def distinct_ids(spark: SparkSession, path: str, bound: datetime) -> DataFrame:
    """bronze (rows) and ids (estimated, within ID_ERROR) of the hours from the bound on: one row from a row for each hour."""
    stored = bounded(spark.read.parquet(path).where(from_hour(bound)), {"ids": (path, HOUR)})
    merged = stored.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("bronze"), F.hll_union_agg("ids").alias("ids"))
    return merged.select("bronze", F.coalesce(F.hll_sketch_estimate("ids"), F.lit(0)).alias("ids"))
