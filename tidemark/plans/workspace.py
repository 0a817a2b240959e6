"""Folders for the intermediate tables of queries that write before they read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share; if that is unset, a local one in local mode only."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="tidemark-"))
        root = f"file://{_own[0]}"
    return f"{root.rstrip('/')}/work/{name}-{uuid.uuid4().hex}"
