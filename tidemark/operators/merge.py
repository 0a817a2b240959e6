"""Tables in partitions by hour or day that are added to and corrected: appends of what is new, upserts. Both may be repeated."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.layers import first_copy

#: The partition column of tables by hour, and how the hour is written there.
HOUR, HOUR_FORMAT = "event_hour", "yyyy-MM-dd-HH"
#: A partition of a write gets a file for each so many rows.
ROWS_A_FILE = 1_000_000


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    at, files = _file_system(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this run made."""
    at, files = _file_system(spark, path)
    files.delete(at, True)


def by_hour(rows: DataFrame, at: str = "event_ts") -> DataFrame:
    """rows with the partition column; rows without a time have no hour, and no place in the table."""
    return rows.where(F.col(at).isNotNull()).withColumn(HOUR, F.date_format(at, HOUR_FORMAT))


def rows_of(batch: DataFrame, partition: str = HOUR) -> dict[str, int]:
    """Rows of each partition that the batch falls in, in order: as many numbers as partitions, never rows."""
    return {label: n for label, n in sorted(tuple(r) for r in batch.groupBy(partition).agg(F.count("*")).collect())}


def only(partitions: Iterable[str], partition: str = HOUR) -> Column:
    """A filter of literals on the partition column: the scan lists and reads no other partition."""
    labels = list(partitions)
    return F.col(partition).isin(*labels) if labels else F.lit(False)


def laid_out(rows: DataFrame, sizes: dict[str, int], key: str, partition: str = HOUR) -> DataFrame:
    """rows dealt so that a write makes one file for each partition, or one for every ROWS_A_FILE rows of a large one."""
    large = {label: -(-n // ROWS_A_FILE) for label, n in sizes.items() if n > ROWS_A_FILE}
    files = F.coalesce(F.create_map(*(F.lit(x) for pair in large.items() for x in pair))[F.col(partition)], F.lit(1)) if large else F.lit(1)
    return rows.repartition(partition, F.pmod(F.xxhash64(key), files)) if large else rows.repartition(partition)


def missing(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows whose key the table lacks."""
    return rows.join(table.select(key), key, "left_anti")


@dataclass(frozen=True)
class Append:
    """A planned append: the rows that the table lacks, and how many keys came in each hour."""

    fresh: DataFrame
    sizes: dict[str, int]
    key: str
    path: str

    def commit(self) -> int:
        """Writes the rows; returns how many keys came. Of two writers that plan at the same time, each may add a key that the other
        adds, as a plan and its commit are two steps: a table has one writer, which the stream's checkpoint makes sure of."""
        if self.sizes:
            laid_out(self.fresh, self.sizes, self.key).write.mode("append").partitionBy(HOUR).parquet(self.path)
        return sum(self.sizes.values())


def plan_append(batch: DataFrame, path: str, key: str) -> Append:
    """What of a batch by hours, with unique keys, the table lacks. Its hours are counted first: they prune the table and size the files."""
    sizes = rows_of(batch)
    if not sizes or not table_exists(batch.sparkSession, path):
        return Append(batch, sizes, key, path)
    known = batch.sparkSession.read.schema(batch.select(key, HOUR).schema).parquet(path)
    return Append(missing(batch, known.where(only(sizes)), key), sizes, key, path)


def append_new(rows: DataFrame, path: str, key: str, order: tuple[str, ...] | None = None, **stamps: Column) -> int:
    """Appends the rows whose key isn't in the table by hours at `path`, with the stamps as more columns; returns how many keys came.

    Of several rows with one key the first in `order` is taken, any one if that is None; an empty order says that keys are
    unique. Only the batch's hours of the table are read, so a batch that is repeated adds nothing; a key that comes again
    with another hour is another row. The batch is held for the two passes over it, its hours and its rows.
    """
    unique = rows.dropDuplicates([key]) if order is None else first_copy(rows, key, order) if order else rows
    with held(by_hour(unique).withColumns(stamps)) as batch:
        return plan_append(batch, path, key).commit()


@contextmanager
def held(rows: DataFrame):
    """rows, computed once while the block runs."""
    kept = rows.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def corrected(table: DataFrame, fresh: DataFrame, keys: list[str], first_seen: tuple[str, ...] = ()) -> DataFrame:
    """The table with fresh rows in place of those with the same keys; of the columns first_seen the table's own values stay."""
    known = table.select(*keys, F.struct(*first_seen).alias("_known")) if first_seen else None
    merged = fresh if known is None else fresh.join(known, keys, "left").withColumns({c: F.coalesce(F.col(f"_known.{c}"), F.col(c)) for c in first_seen})
    return table.join(fresh.select(*keys), keys, "left_anti").unionByName(merged.select(*table.columns))


def replace_partitions(rows: DataFrame, path: str, partition: str) -> None:
    """Puts rows in place of the partitions they fall in. They may be computed from the table: they are staged in full first, in a
    folder of this call alone, which goes afterwards."""
    spark = rows.sparkSession
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    try:
        again = spark.read.schema(rows.schema).parquet(staged)
        again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    finally:
        remove(spark, staged)


def upsert(fresh: DataFrame, path: str, keys: list[str], partition: str, first_seen: tuple[str, ...] = ()) -> None:
    """Upserts into the table at `path`; only partitions that fresh rows fall in are read and rewritten."""
    spark = fresh.sparkSession
    sizes = rows_of(fresh, partition)
    if table_exists(spark, path):
        table = spark.read.schema(fresh.schema).parquet(path).where(only(sizes, partition))
        replace_partitions(laid_out(corrected(table, fresh, keys, first_seen), sizes, keys[0], partition), path, partition)
    else:
        laid_out(fresh, sizes, keys[0], partition).write.partitionBy(partition).parquet(path)
