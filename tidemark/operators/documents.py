"""Contracts of the exported documents, and the check of a document's text against its contract."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S

VERSION = 1
MAX_BYTES = 1_000_000

#: fixed values: what each document holds. For each place ("" is the document, [] the items of a list) its fields as field:kind;
#: a field with ? may be absent, a kind with ? may be null. No other field may occur. Lists of plain values have a kind alone.
CONTRACTS: dict[str, dict[str, str]] = {
    "alerts": {
        "": "schema_version:version generated_at:time window_days:week alerts:list500 digest:list500",
        "alerts[]": "alert_id:sha256 rule_id:rule rule_name:text severity:severity wiki:text title:text category:category owner_team:text edit_type:text? log_action:text? editor_type:editor? "
        "byte_delta:integer? edits_in_window:integer? event_ts:time detected_at:time revision_old?:integer? revision_new?:integer? arrived_late?:flag?",
        "digest[]": "digest_date:date wiki:text title:text category:category edits:count log_events:count net_bytes:integer registered_edits:count unregistered_edits:count bot_edits:count "
        "r1_alerts:count r2_alerts:count r3_alerts:count r4_alerts:count r5_alerts:count",
    },
    "baseline": {
        "": "schema_version:version generated_at:time edits_per_min:list400 bot_share_hourly:list200 recorded_hours:list200 page_activity:list3000 page_averages:list100",
        "edits_per_min[]": "minute:time realtime_edits:integer? final_edits:integer?",
        "bot_share_hourly[]": "hour:time edits:count bot_edits:count bot_share:share",
        "recorded_hours[]": "time",
        "page_activity[]": "title:text category:category hour:time edits:count",
        "page_averages[]": "title:text category:category total_edits:count avg_edits_per_recorded_hour:amount",
    },
    "health": {
        "": "schema_version:version generated_at:time freshness:object funnel:object streaming:list20 detection_seconds:object lag:list32",
        "freshness": "bronze:time? silver:time? gold:time?",
        "funnel": "received:count bronze:count silver_unique:count dlq:count",
        "streaming[]": "query:text batches:count input_rows_per_second:number? batch_duration_ms_p50:number? batch_duration_ms_max:number?",
        "detection_seconds": "samples:count p50:number? p95:number?",
        "lag[]": "partition:count latest_offset:count processed_offset:integer? lag:integer?",
    },
    "meta": {
        "": "schema_version:version generated_at:time dbt:object snapshots:object exports?:object",
        "dbt": "status:run_status finished_at:time? models_ok:count tests_ok:count failures:count",
        "snapshots": "alerts:count? digest:count? edits_per_min:count? bot_share_hourly:count? page_activity:count?",
        "exports": "alerts:object baseline:object",
        "exports.alerts": "status:export_status failed_query:name?",
        "exports.baseline": "status:export_status failed_query:name?",
    },
}


class Kind(NamedTuple):
    """The types of a value as Spark names them, and what else must hold: rule -> test of the value as text."""

    types: str
    tests: dict[str, Callable[[Column], Column]] = {}


_INTEGER = r"(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,0\))"
_NUMBER = r"(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\d+\))"
_at_least_0 = {"minimum": lambda v: v.try_cast("double") >= 0}


def _one_of(*values: str) -> Kind:
    return Kind("STRING", {"enum": lambda v: v.isin(*values)})


def _like(pattern: str, rule: str = "pattern") -> Kind:
    return Kind("STRING", {rule: lambda v: v.rlike(pattern)})


def _just(value: int) -> Kind:
    return Kind(_INTEGER, {"const": lambda v: v == str(value)})


KINDS: dict[str, Kind] = {
    "text": Kind("STRING"), "integer": Kind(_INTEGER), "number": Kind(_NUMBER), "flag": Kind("BOOLEAN"), "object": Kind("OBJECT<.*>"),
    "count": Kind(_INTEGER, _at_least_0), "amount": Kind(_NUMBER, _at_least_0), "share": Kind(_NUMBER, _at_least_0 | {"maximum": lambda v: v.try_cast("double") <= 1}),
    "time": Kind("STRING", {"format": lambda v: v.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?Z$") & v.try_cast("timestamp").isNotNull()}),
    "date": Kind("STRING", {"format": lambda v: v.rlike(r"^\d{4}-\d\d-\d\d$") & v.try_cast("date").isNotNull()}),
    "sha256": _like("^[0-9a-f]{64}$"), "name": _like("^[a-z_]{1,64}$"), "version": _just(VERSION), "week": _just(7),
    "rule": _one_of(*S.RULE_IDS), "severity": _one_of(*S.SEVERITIES), "category": _one_of(*S.CATEGORIES), "editor": _one_of(*S.EDITOR_TYPES),
    "run_status": _one_of("success", "failed", "unknown"), "export_status": _one_of("ok", "failed"),
}


def _dotted(place: Column | str, field: Column) -> Column:
    at = F.lit(place) if isinstance(place, str) else place
    return F.concat(F.when(at != "", F.concat(at, F.lit("."))).otherwise(""), field)


def _lookup(pairs: dict) -> Column:
    """A literal map: text -> text, or text -> list of texts."""
    value = lambda v: F.lit(v) if isinstance(v, str) else F.array(*map(F.lit, v)).cast("array<string>")
    return F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), value(v))))


def _of_values() -> Column:
    """What a value breaks: over the columns name, kind and value (a variant)."""
    of, kind, name = F.schema_of_variant("value"), F.rtrim("kind", F.lit("?")), F.col("name")
    text = F.try_variant_get("value", "$", "string")
    is_list = kind.startswith("list")
    right = F.when(is_list, of.startswith("ARRAY<"))
    for types in sorted({k.types for k in KINDS.values()}):
        right = right.when(kind.isin(*(n for n, k in KINDS.items() if k.types == types)), of.rlike(f"^{types}$"))
    null = (of == "VOID") & F.col("kind").endswith("?")
    rules = [F.when(is_list & (F.size(F.try_variant_get("value", "$", "array<variant>")) > F.substring(kind, 5, 9).try_cast("int")), "maxItems")]
    rules += [F.when((kind == k) & right & ~F.coalesce(test(text), F.lit(False)), rule) for k, of_kind in KINDS.items() for rule, test in of_kind.tests.items()]
    found = F.array_compact(F.array(F.when(~right & ~null, "type"), *rules))
    return F.transform(found, lambda rule: F.concat(name, F.lit(": "), rule))


def violations(texts: DataFrame, name: str, column: str = "json") -> DataFrame:
    """problem, found: how often each rule of the document's contract is broken in the texts; no row if it holds.

    A text is parsed once into its objects (place, item); those into their fields; each field is judged by its kind. A value
    never shows in a problem.
    """
    objects = {place: fields for place, fields in CONTRACTS[name].items() if ":" in fields}
    plain = {place: kind for place, kind in CONTRACTS[name].items() if ":" not in kind}
    fields = {place: [part.split(":") for part in parts.split()] for place, parts in objects.items()}
    known = _lookup({place: [f.rstrip("?") for f, _ in parts] for place, parts in fields.items()})
    required = _lookup({place: [f for f, _ in parts if not f.endswith("?")] for place, parts in fields.items()})
    kinds = _lookup(plain | {f"{place}.{f.rstrip('?')}".lstrip("."): kind for place, parts in fields.items() for f, kind in parts})

    def items(place: str) -> Column:
        if place.endswith("[]"):
            found = F.coalesce(F.try_variant_get("doc", f"$.{place[:-2]}", "array<variant>"), F.array().cast("array<variant>"))
        else:
            found = F.array_compact(F.array(F.try_variant_get("doc", f"$.{place}".rstrip("."), "variant")))
        return F.transform(found, lambda item: F.struct(F.lit(place).alias("place"), item.alias("item")))

    docs = texts.select(F.try_parse_json(column).alias("doc"))
    every = docs.select(F.col("doc").isNull().alias("unread"), F.explode_outer(F.concat(*map(items, CONTRACTS[name]))).alias("i")).select("unread", "i.place", "i.item")
    opened = every.withColumn("fields", F.try_variant_get("item", "$", "map<string, variant>"))
    keys, place = F.coalesce(F.map_keys("fields"), F.array().cast("array<string>")), F.col("place")
    is_object = F.schema_of_variant("item").startswith("OBJECT<")
    other = F.array_except(keys, known[place])
    of_objects = F.concat(
        F.array_compact(F.array(F.when(F.col("unread"), "$: invalid_json"), F.when(((place == "") | place.endswith("[]")) & known[place].isNotNull() & ~is_object, F.concat(F.when(place != "", place).otherwise("$"), F.lit(": type"))))),
        F.when(is_object, F.transform(F.array_except(required[place], keys), lambda f: F.concat(_dotted(place, f), F.lit(": required")))).otherwise(F.array().cast("array<string>")),
        F.array_compact(F.array(F.when(is_object & (F.size(other) > 0), F.concat(F.when(place != "", place).otherwise("$"), F.lit(": additionalProperties"))))),
    )
    entry = F.struct(F.col("place").alias("name"), F.col("item").alias("value"))
    is_value = place.isin(*plain) if plain else F.lit(False)
    values = F.when(is_value, F.array(entry)).otherwise(F.transform(F.map_entries("fields"), lambda e: F.struct(_dotted(place, e["key"]).alias("name"), e["value"].alias("value"))))
    judged = opened.select(F.explode(values).alias("v")).select("v.*").withColumn("kind", kinds[F.col("name")]).where("kind is not null")
    # not only once: objects and their fields are two passes over one small text
    found = opened.select(F.explode(F.coalesce(of_objects, F.array().cast("array<string>"))).alias("problem")).unionByName(judged.select(F.explode(_of_values()).alias("problem")))
    return found.groupBy("problem").agg(F.count("*").alias("found"))
