"""The contract of incoming events: first violation, routing, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import EVENT_TYPES, contains_ip, once
from tidemark.operators.layers import payload_type

_WIKI = "^[a-z0-9_]+$"
_INTEGER = r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,0\))$"


#: Fields whose type is looked at; the text of the last few, too.
_FIELDS = (
    "meta", "meta.id", "meta.dt", "meta.domain", "meta.stream", "type", "namespace", "title", "wiki", "timestamp", "user", "bot", "length", "length.old", "length.new",
    "revision", "revision.old", "revision.new", "log_type", "log_action",
)
_TEXTS = ("type", "title", "wiki", "meta.id")
#: The types of fields as they are mostly written; those of other single fields are texts.
_WRITTEN = {"bot": "boolean"} | dict.fromkeys(("namespace", "timestamp", "length.old", "length.new", "revision.old", "revision.new"), "bigint")


def _object(*fields: str) -> str:
    """A pattern of an object's type as Spark names it: its fields in order, each `name: types`, `?` after those that may be absent."""
    return "OBJECT<" + "".join(f"((, )?{f.rstrip('?')})" + ("?" if f.endswith("?") else "") for f in fields) + ">"


def _changes(name: str) -> str:
    one = r"(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,0\)|VOID)"
    return f"{name}: {_object(f'new: {one}?', f'old: {one}?')}?"


#: The type of events that hold no fields but known ones, all of a right type. Names of other characters than letters, digits and _
#: are quoted in a type, so no name can feign one.
_USUAL = "^" + _object(
    "bot: BOOLEAN?", _changes("length"), "log_action: (STRING|VOID)?", "log_type: (STRING|VOID)?",
    f"meta: {_object('domain: STRING?', 'dt: STRING', 'id: STRING', 'stream: STRING?')}", f"namespace: {_INTEGER[1:-1]}", _changes("revision"),
    f"timestamp: {_INTEGER[1:-1]}?", "title: STRING", "type: STRING", "user: STRING?", "wiki: STRING",
) + "$"


def _usual() -> Column:
    """Whether an event is valid by the type of the whole alone, and its texts: most are. The others go through all checks."""
    texts = F.col("_t_type").isin(*EVENT_TYPES) & (F.col("_t_title") != "") & F.col("_t_wiki").rlike(_WIKI) & (F.col("_t_meta_id") != "")
    return F.coalesce(F.col("_k_").rlike(_USUAL) & texts, F.lit(False))


def _opened(df: DataFrame, raw: str) -> DataFrame:
    """df with _o, the payload's fields by name, if it is written as Spark would write them: in the order above, nothing else, nothing
    null, no blanks. A text that is what typed fields give when written holds fields of just these types, however it was read."""
    fields = {f: (f, _WRITTEN.get(f, "string")) for f in _FIELDS if not any(other.startswith(f"{f}.") for other in _FIELDS)}
    read = df.withColumn("_o", once(F.from_json(raw, payload_type(fields))))
    return read.withColumn("_o", once(F.when(F.to_json("_o", {"ignoreNullFields": "true"}) == F.col(raw), F.col("_o"))))


def _plain() -> Column:
    """Whether an event is valid by what `_opened` has read: no type is looked for."""
    texts = F.col("_o.type").isin(*EVENT_TYPES) & (F.col("_o.title") != "") & F.col("_o.wiki").rlike(_WIKI) & (F.col("_o.meta.id") != "")
    return F.coalesce(texts & F.col("_o.meta.dt").isNotNull() & F.col("_o.namespace").isNotNull(), F.lit(False))


def _name(path: str) -> str:
    return path.removeprefix("$.").replace(".", "_")


def first_violation(event: Column) -> Column:
    """Over a struct of the columns that with_reason finds: `path: rule`, invalid_json, not_an_object, or null for a valid event.

    Violations are ordered by the length of their path, then path, then rule; missing root fields are the root's own, in the
    schema's order. The value itself never shows. A whole number may be written 1.0; dates are not checked here.

    Tests of absent fields are null, which is no violation.
    """

    def _kind(path: str) -> Column:
        """The type of a field as Spark names it; null if the field is absent, VOID if it is a JSON null."""
        return event[f"_k_{_name(path)}"]

    def _text(path: str) -> Column:
        return event[f"_t_{_name(path)}"]

    def kind_is(path: str, *names: str) -> Column:
        return _kind(path).isin(*names) if len(names) > 1 else _kind(path) == names[0]

    def is_object(path: str) -> Column:
        return _kind(path).startswith("OBJECT")

    def whole(path: str) -> Column:
        return _kind(path).rlike(_INTEGER)

    def whole_or_null(path: str) -> tuple[Column, str]:
        return ~(whole(f"$.{path}") | kind_is(f"$.{path}", "VOID")), f"{path}: type"

    def text_type(path: str, *more: str) -> tuple[Column, str]:
        return ~kind_is(f"$.{path}", "STRING", *more), f"{path}: type"

    checks = [(_kind(f"$.{f}").isNull(), f"{f}: required") for f in ("meta", "type", "namespace", "title", "wiki")]
    checks += [
        (~kind_is("$.bot", "BOOLEAN"), "bot: type"),
        (~is_object("$.length"), "length: type"),
        text_type("log_action", "VOID"),
        text_type("log_type", "VOID"),
        (is_object("$.meta") & _kind("$.meta.id").isNull(), "meta.id: required"),
        (is_object("$.meta") & _kind("$.meta.dt").isNull(), "meta.dt: required"),
        (~is_object("$.meta"), "meta: type"),
        (~whole("$.namespace"), "namespace: type"),
        (~is_object("$.revision"), "revision: type"),
        (~whole("$.timestamp"), "timestamp: type"),
        (kind_is("$.title", "STRING") & (_text("$.title") == ""), "title: minLength"),
        text_type("title"),
        (~kind_is("$.type", "STRING") | ~_text("$.type").isin(*EVENT_TYPES), "type: enum"),
        text_type("user"),
        (kind_is("$.wiki", "STRING") & ~_text("$.wiki").rlike(_WIKI), "wiki: pattern"),
        text_type("wiki"),
        whole_or_null("length.new"),
        whole_or_null("length.old"),
        text_type("meta.domain"),
        text_type("meta.dt"),
        (kind_is("$.meta.id", "STRING") & (_text("$.meta.id") == ""), "meta.id: minLength"),
        text_type("meta.id"),
        text_type("meta.stream"),
        whole_or_null("revision.new"),
        whole_or_null("revision.old"),
    ]
    found = F.when(event["_k_"].isNull(), "invalid_json").when(~event["_k_"].startswith("OBJECT"), "not_an_object")
    for bad, name in checks:
        found = found.when(bad, name)
    return found


def with_reason(df: DataFrame, raw: str = "raw", into: str = "reason") -> DataFrame:
    """df with the first violation of each payload. What is written as usual is valid by its fields and texts. The rest is parsed once; what
    is usual of that is valid by its whole type, and the types of single fields are found, each once, for what is left alone: for the others
    the fields of a null are looked at, which takes no time. The JVM compiles no method of over 8,000 bytes, and Spark makes one of all this:
    so the checks of the rest are the body of a lambda, which isn't part of it.
    """
    return _judged(_opened(df, raw), raw, into)


def _judged(opened: DataFrame, raw: str = "raw", into: str = "reason") -> DataFrame:
    plain = opened.withColumn("_plain", _plain()).drop("_o")
    parsed = plain.withColumn("_v", F.when(~F.col("_plain"), F.try_parse_json(raw)))
    texts = {f"_t_{_name(f)}": F.try_variant_get("_v", f"$.{f}", "string") for f in _TEXTS}
    typed = parsed.withColumns({"_k_": F.schema_of_variant("_v")} | texts).withColumn("_usual", F.col("_plain") | _usual())
    typed = typed.withColumn("_v", F.when(~F.col("_usual"), F.col("_v")))
    kinds = {f"_k_{_name(f)}": F.schema_of_variant(F.try_variant_get("_v", f"$.{f}", "variant")) for f in _FIELDS}
    reason = F.when(~F.col("_usual"), F.transform(F.array(F.struct("_k_", *kinds, *texts)), first_violation)[0])
    return typed.withColumns(kinds).withColumn(into, once(reason)).drop("_v", "_k_", "_plain", "_usual", *kinds, *texts)


def is_canary(raw: Column) -> Column:
    """Whether the payload is an event of the canary domain; what can't be parsed is not."""
    return F.coalesce(F.get_json_object(raw, "$.meta.domain") == "canary", F.lit(False))


def routed(df: DataFrame) -> DataFrame:
    """df without canaries, with the reason of rejection (null for valid events). The domain of what is written as usual is read with it."""
    opened = _opened(df.withColumn("raw", once(F.col("raw"))), "raw")
    canary = F.when(F.col("_o").isNotNull(), F.coalesce(F.col("_o.meta.domain") == "canary", F.lit(False))).otherwise(is_canary(F.col("raw")))
    return _judged(opened.where(~canary))


def outcome(df: DataFrame) -> DataFrame:
    """df with outcome: canary, invalid, private (an IP in the payload) or kept, tested in this order."""
    found = with_reason(df)
    how = F.when(is_canary(F.col("raw")), "canary").when(F.col("reason").isNotNull(), "invalid").when(contains_ip(F.col("raw")), "private").otherwise("kept")
    return found.withColumn("outcome", how)


def dlq_envelope(df: DataFrame, rejected_at: str = "ingested_at") -> Column:
    return F.to_json(F.struct(F.col("reason").alias("error"), "raw", F.date_format(rejected_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("rejected_at")))
