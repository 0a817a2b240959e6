"""Layout of partitioned tables: creation, new columns, compaction of closed days."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.merge import replace_partitions, table_exists

MIN_FILES = 5
TARGET_BYTES = 128 << 20


def create_table(spark: SparkSession, name: str, ddl: str, partition: str | None = None) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet" + (f" PARTITIONED BY ({partition})" if partition else ""))


def add_missing_columns(spark: SparkSession, name: str, columns: dict[str, str]) -> list[str]:
    """Adds the columns that the table lacks (old rows read null); returns their names."""
    missing = [c for c in columns if c not in spark.table(name).columns]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{c} {columns[c]}' for c in missing)})")
    return missing


def replace_table(df: DataFrame, name: str, stamp: str) -> int:
    """Replaces a table in one commit, with loaded_at. Reference data goes through sources.seeds, which checks it first."""
    df.withColumn("loaded_at", F.lit(stamp).cast("timestamp_ntz")).write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name).count()


def load_if_empty(df: DataFrame, name: str, stamp: str) -> int:
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and not spark.table(name).limit(1).isEmpty():
        return 0
    return replace_table(df, name, stamp)


def listed_files(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """partition (its label), file, bytes of each data file of the table: from the listing alone, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    label = F.url_decode(F.regexp_extract("path", rf"/{partition}=([^/]+)/[^/]+$", 1))
    return files.select(label.alias("partition"), F.col("path").alias("file"), F.col("length").alias("bytes"))


def compaction_plan(files: DataFrame, now: datetime, target: int = TARGET_BYTES) -> DataFrame:
    """partition, file, bytes, part: the files of closed partitions (before today, UTC) that have MIN_FILES or more, put together in the
    order of their names into parts of about `target` bytes.

    What a partition holds is its own list of files; partitions are planned apart from each other.
    """
    closed = files.where((F.col("partition") != "") & (F.col("partition") < now.strftime("%Y-%m-%d")))
    before = Window.partitionBy("partition").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    many = closed.withColumns({"_files": F.count("*").over(Window.partitionBy("partition")), "_before": F.coalesce(F.sum("bytes").over(before), F.lit(0))})
    return many.where(F.col("_files") >= MIN_FILES).select("partition", "file", "bytes", F.floor(F.col("_before") / target).cast("int").alias("part"))


def compact(spark: SparkSession, path: str, partition: str, now: datetime, target: int = TARGET_BYTES) -> int:
    """Rewrites the closed partitions with many small files, all in one job, each part of the plan to one file; returns how many.

    Only files of the plan are read. No row is lost: everything is staged in full, apart from other runs, before a partition is
    replaced; today's partition and those of few files aren't touched. Rows meet their part by the file they come from.
    """
    if not table_exists(spark, path):
        return 0
    plan = compaction_plan(listed_files(spark, path, partition), now, target)
    labels = [r[0] for r in plan.select("partition").distinct().collect()]  # as many as partitions that need it
    if not labels:
        return 0
    rows = spark.read.parquet(path)
    columns = rows.columns
    chosen = rows.where(F.col(partition).cast("string").isin(labels)).withColumn("_file", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"))
    parts = plan.select(F.regexp_replace("file", "^file:/+", "file:/").alias("_file"), F.col("part").alias("_part"))
    placed = chosen.join(parts, "_file", "left").repartition(F.col(partition), F.coalesce("_part", F.lit(0))).select(*columns)
    replace_partitions(placed, path, partition)
    return len(labels)
