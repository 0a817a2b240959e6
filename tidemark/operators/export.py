"""Capped, checked JSON documents, each written on its own, and the document about them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.documents import MAX_BYTES, VERSION, violations
from tidemark.operators.merge import remove
from tidemark.operators.reports import severity_rank

ALERT_FIELDS = [
    "alert_id", "arrived_late", "byte_delta", "category", "detected_at", "edit_type", "editor_type", "edits_in_window", "event_ts", "log_action", "owner_team",
    "revision_new", "revision_old", "rule_id", "rule_name", "severity", "title", "wiki",
]
#: The lists of each document whose lengths the document about the run gives.
COUNTED = {"alerts": ("alerts", "digest"), "baseline": ("edits_per_min", "bot_share_hourly", "page_activity")}


class ExportFailed(Exception):
    """Some documents weren't written; the document about the run was, and names them."""


class BrokenContract(ValueError):
    """A document that must not be written: its first problems, never its values."""


def as_array(rows: DataFrame, fields: list[str], order: list, name: str) -> DataFrame:
    """One row with an array of structs in the given order, fields sorted by name. Only for capped rows."""
    key = F.struct(*order).alias("_o")
    item = F.struct(*[F.col(f) for f in sorted(fields)]).alias("_r")
    return rows.select(key, item).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_r"))), lambda x: x["_r"]).alias(name))


def document(parts: dict[str, DataFrame], now: Column, **fixed) -> DataFrame:
    """name -> one-row frames, as one JSON text with sorted keys (so a repeated run gives the same bytes); its size in bytes."""
    out = None
    for part in parts.values():
        out = part if out is None else out.crossJoin(part)  # one row each
    names = {**{k: F.lit(v) for k, v in fixed.items()}, "generated_at": S.iso_utc(now), "schema_version": F.lit(VERSION), **{k: F.col(k) for k in parts}}
    text = F.to_json(F.struct(*[names[k].alias(k) for k in sorted(names)]), {"ignoreNullFields": "false"})
    return out.select(text.alias("json")).withColumn("bytes", F.octet_length("json").cast("long"))


def alerts_document(top: DataFrame, digest: DataFrame, now: Column) -> DataFrame:
    """top: alerts with detected_at; both are capped by their makers."""
    iso = {c: S.iso_utc(F.col(c)) for c in ("event_ts", "detected_at")}
    # newest first within a severity: the negated time sorts so, to the microsecond, before the texts of whole seconds take its place
    rows = top.withColumns({"_rank": severity_rank(), "_age": -F.unix_micros(F.col("event_ts").cast("timestamp"))}).withColumns(iso)
    d = digest.withColumns({"_age": -F.unix_date("digest_date"), "digest_date": F.date_format("digest_date", "yyyy-MM-dd")})
    fields = [c for c in digest.columns if c != "owner_team"]
    return document({"alerts": as_array(rows, ALERT_FIELDS, ["_rank", "_age", "alert_id"], "alerts"), "digest": as_array(d, fields, ["_age", (-F.col("edits")).alias("e"), "wiki", "title"], "digest")}, now, window_days=7)


def publish(doc: DataFrame, name: str, path: str) -> dict[str, int]:
    """Writes the document if its contract and its size allow, and returns the lengths of its COUNTED lists.

    The text is made once and staged; it is read again for the checks, so what is checked is what is written. If a check
    fails, the last good copy stays.
    """
    spark = doc.sparkSession
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    doc.select("json").coalesce(1).write.text(staged)  # one row
    try:
        text = spark.read.text(staged).withColumnRenamed("value", "json")
        if problems := violations(text, name).orderBy("problem").take(5):
            raise BrokenContract(f"{name}: " + ", ".join(r["problem"] for r in problems))
        lengths = {c: F.json_array_length(F.get_json_object("json", f"$.{c}")).alias(c) for c in COUNTED.get(name, ())}
        found = text.select(F.octet_length("json").alias("_bytes"), *lengths.values()).collect()  # numbers of one document
        if len(found) != 1 or found[0]["_bytes"] > MAX_BYTES:
            raise BrokenContract(f"{name}: {len(found)} documents, or over {MAX_BYTES} bytes")
        text.coalesce(1).write.mode("overwrite").text(path)
        return {c: found[0][c] for c in lengths}
    finally:
        remove(spark, staged)


def meta_document(spark: SparkSession, run: DataFrame, lengths: dict[str, dict[str, int]], exports: dict[str, dict] | None, now: Column) -> DataFrame:
    """The document about a run: run (one row: status, models_ok, tests_ok, failures, finished_at if known), how many rows each list
    has (null for a document that wasn't written) and, if given, how each export went."""
    counts = {c: lengths.get(doc, {}).get(c) for doc, lists in COUNTED.items() for c in lists}
    long = lambda v: F.lit(v).cast("long")
    finished = S.iso_utc(F.col("finished_at")) if "finished_at" in run.columns else F.lit(None).cast("string")
    parts = {
        "dbt": run.select(F.struct("failures", finished.alias("finished_at"), "models_ok", "status", "tests_ok").alias("dbt")),
        "snapshots": spark.range(1).select(F.struct(*(long(n).alias(c) for c, n in sorted(counts.items()))).alias("snapshots")),
    }
    if exports is not None:
        one = lambda e: F.struct(F.lit(e["failed_query"]).cast("string").alias("failed_query"), F.lit(e["status"]).alias("status"))
        parts["exports"] = spark.range(1).select(F.struct(*(one(e).alias(name) for name, e in sorted(exports.items()))).alias("exports"))
    return document(parts, now)


def export_run(spark: SparkSession, builders: dict[str, Callable[[], DataFrame]], paths: dict[str, str], run: DataFrame, now: Column) -> dict[str, dict[str, int]]:
    """Publishes each document on its own, then the one about the run in any case; raises ExportFailed after that if any failed.

    A failure is recorded with the name of the query that failed, which is the document's, or without one where the
    document itself is at fault; never with a message, which may hold paths or values.
    """
    lengths, exports = {}, {}
    for name, build in builders.items():
        try:
            lengths[name] = publish(build(), name, paths[name])
            exports[name] = {"status": "ok", "failed_query": None}
        except BrokenContract:
            exports[name] = {"status": "failed", "failed_query": None}
        except Exception:  # the others are still written
            exports[name] = {"status": "failed", "failed_query": name}
    publish(meta_document(spark, run, lengths, exports, now), "meta", paths["meta"])
    if failed := sorted(name for name, e in exports.items() if e["status"] == "failed"):
        raise ExportFailed(", ".join(failed))
    return lengths


def snapshot_status(texts: DataFrame, column: str = "json") -> DataFrame:
    """ok, or why a stored document can't be shown: unavailable, unreadable, version, invalid. The version is tested first."""
    v = F.try_parse_json(column)
    kind = F.schema_of_variant("_v")
    version = F.try_variant_get("_v", "$.schema_version", "string")
    status = (
        F.when(F.col(column).isNull(), "unavailable")
        .when(F.col("_v").isNull(), "unreadable")
        .when(~kind.startswith("OBJECT"), "invalid")
        .when(F.coalesce(version != str(VERSION), F.lit(True)), "version")
        .when(F.try_variant_get("_v", "$.generated_at", "string").isNull(), "invalid")
        .otherwise("ok")
    )
    return texts.withColumn("_v", v).withColumn("status", status).drop("_v")
