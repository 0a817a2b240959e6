"""Reference data from seed files: checked, versioned, and put in place of the old version all at once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.quality import rules_errors, watchlist_errors
from tidemark.sources import readers

#: A folder of entries <number>-<version>; the greatest is the version that holds.
LOG = "versions"


class SeedError(ValueError):
    """A seed breaks its contract; nothing was loaded."""


@dataclass(frozen=True)
class Reference:
    """One version of the reference tables; its folders are never changed."""

    version: str
    watchlist: DataFrame
    rules: DataFrame


def errors(watchlist: DataFrame, rules: DataFrame) -> list[str]:
    """What is wrong with the two seeds: a line for each kind of problem, counted by Spark."""
    found = [(f"watchlist: {r[0]}", r[1]) for r in watchlist_errors(watchlist).collect()]
    found += [(f"alert_rules: {r[0]}", r[1]) for r in rules_errors(rules).collect()]
    return [f"{problem} ({n})" for problem, n in sorted(found)]


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return hadoop, at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str) -> str | None:
    """The version that holds now, None before the first load: that of the last entry in the log of versions."""
    _, at, files = _files(spark, f"{root}/{LOG}")
    if not files.exists(at):
        return None
    names = [f.getPath().getName() for f in files.listStatus(at)]
    return max((n for n in names if not n.startswith((".", "_"))), default="-").partition("-")[2] or None


def _point_to(spark: SparkSession, root: str, version: str) -> None:
    """One new, empty entry in the log, whose name says all: it is there or not, and no reader sees half of it."""
    hadoop, at, files = _files(spark, f"{root}/{LOG}")
    files.mkdirs(at)
    last = max((int(f.getPath().getName().partition("-")[0]) for f in files.listStatus(at) if f.getPath().getName()[:1].isdigit()), default=0)
    if not files.createNewFile(hadoop.Path(f"{root}/{LOG}/{last + 1:012d}-{version}")):
        raise SeedError(f"version {version} is there already")


def load(spark: SparkSession, seeds: str, root: str, stamp: str) -> dict[str, int]:
    """Loads <seeds>/watchlist.csv and <seeds>/alert_rules.csv as a new version under root; returns the rows of each.

    Both are read by their schemas and checked before anything is written; then both tables are written into a folder of this
    version alone, with loaded_at; then the log of versions gets its entry. A malformed row, a broken rule or a failed write leaves the old version
    as it was, and a reader has either version in full.
    """
    found = {"watchlist": readers.seed_csv(spark, f"{seeds}/watchlist.csv", schemas.WATCHLIST), "alert_rules": readers.seed_csv(spark, f"{seeds}/alert_rules.csv", schemas.RULES)}
    if wrong := errors(found["watchlist"], found["alert_rules"]):
        raise SeedError("; ".join(wrong))
    version = uuid.uuid4().hex
    for name, rows in found.items():
        rows.withColumn("loaded_at", F.lit(stamp).cast("timestamp_ntz")).write.parquet(f"{root}/{version}/{name}")
    _point_to(spark, root, version)
    held = reference(spark, root, version)
    return {"watchlist": held.watchlist.count(), "alert_rules": held.rules.count()}


def load_if_empty(spark: SparkSession, seeds: str, root: str, stamp: str) -> dict[str, int] | None:
    """Loads the seeds unless a version is there; None if one is."""
    return load(spark, seeds, root, stamp) if current(spark, root) is None else None


def reference(spark: SparkSession, root: str, version: str | None = None) -> Reference:
    """The tables of one version, the current one if none is named. What is read from it later is still that version."""
    version = version or current(spark, root)
    if version is None:
        raise SeedError(f"no version under {root}")
    table = lambda name, schema: spark.read.schema(f"{schema}, loaded_at timestamp_ntz").parquet(f"{root}/{version}/{name}")
    return Reference(version, table("watchlist", schemas.WATCHLIST), table("alert_rules", schemas.RULES))
