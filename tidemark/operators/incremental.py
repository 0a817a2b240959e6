"""Models that are rebuilt for their last hours alone: bounds are literals on the partitions of both the source and the model."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import HOUR, corrected, laid_out, replace_partitions, rows_of, table_exists
from tidemark.plans.pruning import bounded

#: How far back a run looks, and the first one, which has no model yet.
LOOKBACK, FIRST_LOOKBACK = timedelta(hours=6), timedelta(days=7)
DAY = "day"
_HOUR_TEXT, _DAY_TEXT = "%Y-%m-%d-%H", "%Y-%m-%d"


def lower_bound(run_time: datetime, grain: str, first: bool = False, since: datetime | None = None) -> datetime:
    """Where a run begins: its time less the lookback, or `since`, at the start of that hour or day, so that what is computed is whole."""
    at = since or run_time - (FIRST_LOOKBACK if first else LOOKBACK)
    return at.replace(minute=0, second=0, microsecond=0, **({"hour": 0} if grain == DAY else {}))


def from_hour(bound: datetime, column: str = HOUR) -> Column:
    """Partitions by hour from the bound on, as a comparison with a literal."""
    return F.col(column) >= F.lit(bound.strftime(_HOUR_TEXT))


def from_day(bound: datetime, column: str = DAY) -> Column:
    return F.col(column) >= F.lit(bound.strftime(_DAY_TEXT))


@dataclass(frozen=True)
class Model:
    """What is computed from typed rows, by its keys. `at` is the time by whose day the model is stored; `grain` is hour or day; what a
    row held in `preserved` columns when it first came stays."""

    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    at: str
    grain: str = "hour"
    preserved: tuple[str, ...] = ()


@dataclass(frozen=True)
class Refresh:
    """A run that is planned: the rows that take the place of the model's last days, and the first of those."""

    rows: DataFrame
    bound: datetime
    path: str
    exists: bool

    def commit(self) -> None:
        """Replaces the days that the rows fall in, all of which are staged first; other days aren't touched."""
        sizes = rows_of(self.rows, DAY)
        if not sizes:
            return
        placed = laid_out(self.rows, sizes, self.rows.columns[0], DAY)
        if self.exists:
            replace_partitions(placed, self.path, DAY)
        else:
            placed.write.partitionBy(DAY).parquet(self.path)


def refresh(spark: SparkSession, model: Model, source: str, path: str, run_time: datetime, since: datetime | None = None, **stamps: Column) -> Refresh:
    """Plans a run of the model over the typed layer at `source`, which lies by hours, into the model at `path`, which lies by days.

    The source is read from the bound's hour on, the model from its day on: the plan is checked, and a run whose scans aren't bounded
    by literals fails before it reads a row. Rows whose keys are known are replaced but for the preserved columns, others are
    added, rows that are no longer computed stay. A run that is repeated changes nothing.
    """
    exists = table_exists(spark, path)
    bound = lower_bound(run_time, model.grain, not exists, since)
    tables = {"source": (source, HOUR)}
    typed = spark.read.parquet(source).where(from_hour(bound))
    # the label as text, as it is read back
    fresh = model.build(typed.drop(HOUR)).withColumns(stamps).withColumn(DAY, F.date_format(model.at, "yyyy-MM-dd"))
    rows = fresh
    if exists:
        tables["model"] = (path, DAY)
        known = spark.read.schema(fresh.schema).parquet(path).where(from_day(bound))
        rows = corrected(known, fresh, list(model.keys), model.preserved)
    return Refresh(bounded(rows, tables), bound, path, exists)
