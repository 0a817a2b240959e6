"""Registered queries: each with the Spark job and, where SQL can express it, the equal DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a job(spark, sf_dir) under its name; `sql` is a SELECT over the views of catalog.oracle."""

    def add(job):
        key = name or job.__name__
        QUERIES[key] = job
        if sql:
            from tidemark.catalog.oracle import complete

            ORACLES[key] = complete(sql)
        return job

    return add
