"""Checks of physical plans: which scans of partitioned tables are bounded."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame


def scans(df: DataFrame) -> list[dict[str, str]]:
    """Location, partition filters, pushed filters and read columns of each file scan in the plan."""
    text = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = []
    for block in re.split(r"\n\n", text):
        if re.match(r"\(\d+\) Scan parquet", block.strip()):
            found.append({k: (m[1] if (m := re.search(rf"^{k}: (.*)$", block, re.M)) else "") for k in ("Location", "PartitionFilters", "PushedFilters", "ReadSchema")})
    return found


def unpruned(df: DataFrame, column: str) -> list[str]:
    """Locations of scans without a bound on the partition column."""
    return [s["Location"] for s in scans(df) if not bounds(s["PartitionFilters"], column)]


def bounds(filters: str, column: str) -> list[str]:
    """What bounds a partition column in a scan's partition filters: `literal` comparisons with constants, `dynamic` pruning by what
    another side of a join holds. That the column isn't null or isn't some value is no bound, nor is a function of it."""
    name = rf"{re.escape(column)}#\d+L?"
    found = []
    if re.search(rf"dynamicpruning(expression)?\(.*{name} IN", filters):
        found.append("dynamic")
    plain = re.sub(r"dynamicpruning(expression)?\([^\]]*|NOT \([^()]*\)|NOT \S+ IN \([^()]*\)", "", filters)
    if re.search(rf"\({name} (=|<=>|>=|>|<=|<) (?![\w.]*#)[^)]+\)|{name} (IN|INSET) \(?(?!\(?subquery)|cast\({name} as date\) (=|>=|>|<=|<) ", plain):
        found.append("literal")
    return found


@dataclass(frozen=True)
class Scan:
    """A scan of a partitioned table in a plan, and how it is bounded (empty: it lists and reads every partition)."""

    table: str
    bounded_by: tuple[str, ...]


class UnboundedScan(AssertionError):
    """A plan reads a partitioned table as a whole."""


def visit(df: DataFrame, tables: dict[str, tuple[str, str]]) -> list[Scan]:
    """Every scan in the plan of one of the tables (name: folder, partition column)."""
    found = []
    for scan in scans(df):
        for name, (path, column) in tables.items():
            if re.search(rf"{re.escape(path.partition('://')[2] or path).rstrip('/')}(?=[/\],]|$)", scan["Location"]):
                found.append(Scan(name, tuple(bounds(scan["PartitionFilters"], column))))
    return found


def bounded(df: DataFrame, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """df itself; raises UnboundedScan if its plan has a free scan of one of the tables, or none of any."""
    found = visit(df, tables)
    free = sorted({s.table for s in found if not s.bounded_by})
    if free or not found:
        raise UnboundedScan(f"free scans of {', '.join(free)}" if free else "no table is read")
    return df
