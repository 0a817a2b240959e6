"""Scans with explicit schemas, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas


def event_stream(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None, archive: str | None = None) -> DataFrame:
    """Unbounded scan of decoded records in files. A micro-batch takes at most `max_files` files, or files of `max_bytes` together
    (one file at least, whatever its size). Files go to `archive` after the batch that read them is committed."""
    if max_files and max_bytes:
        raise ValueError("a batch is bounded by files or by bytes")
    options = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes, "sourceArchiveDir": archive, "cleanSource": "archive" if archive else None}
    return spark.readStream.schema(schemas.RECORD).options(**{k: v for k, v in options.items() if v is not None}).parquet(path)


def topic_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int = 200_000) -> DataFrame:
    """The same from a broker, where Spark's Kafka source is installed: from the earliest offset, failing on lost data."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": str(max_offsets)}
    return spark.readStream.format("kafka").options(**options).load()


def seed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a schema; a malformed row fails the read."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """raw: the lines (plain or gzip) that are JSON objects; blank and other lines are skipped."""
    lines = spark.read.text(path).select(F.col("value").alias("raw"))
    return lines.where(F.trim("raw") != "").where(F.coalesce(F.schema_of_variant(F.try_parse_json("raw")).startswith("OBJECT"), F.lit(False)))


def progress_log(spark: SparkSession, path: str) -> DataFrame:
    """Progress records with the partition column dt."""
    return spark.read.schema(schemas.PROGRESS + ", dt date").json(path)
