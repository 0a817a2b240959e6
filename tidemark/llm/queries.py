"""The registered query of each corpus operator, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, quality
from tidemark.llm.common import bounded_batches, documents, key_crc32
from tidemark.llm.conversations import repair_conversations
from tidemark.llm.jaccard import near_duplicates
from tidemark.llm.lines import DIGEST_SQL, line_dedup_digest
from tidemark.llm.merkle import manifest
from tidemark.llm.mixing import mix_documents
from tidemark.llm.neighbours import near_vectors
from tidemark.llm.packing import pack_documents
from tidemark.llm.rans import token_digest
from tidemark.llm.rules import apply_rules
from tidemark.llm.sharding import documents_to_shards
from tidemark.llm.topk import top_k


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row with a null doc_id is not held out, and never learned from."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.coalesce(key_crc32("doc_id") % 5 == 0, F.lit(False))
    model = language.learn(docs, ~held_out & F.col("doc_id").isNotNull())
    return language.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(documents(spark, sf_dir))


def op3_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_to_shards(documents(spark, sf_dir), 24)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op5_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(documents(spark, sf_dir)).drop("source", "copies")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row with a null doc_id is not held out, and never learned from. Languages serve for the draw of unlabelled texts alone."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.coalesce(key_crc32("doc_id") % 4 == 2, F.lit(False))
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out & F.col("doc_id").isNotNull())
    out = quality.scored(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")
    return out.withColumn("predicted", (out.score >= 0.7).cast("int"))


def op7_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), end_id=2)


def op8_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), query_ids_divide_by=50, k=5)


def op9_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), capacity=4096, end_id=1)


def op10_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(documents(spark, sf_dir))


def op11_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return repair_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_line_dedup, op3_feistel_sharding, op4_jaccard_join, op5_cube_mixing, op6_quality_classifier, op7_rans_tokens, op8_norm_bucket_topk,
        op9_residual_packing, op10_adaptive_rules, op11_collision_counting, op12_merkle_manifest, op13_conversation_repair,
    )
}

def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: {byte}), 4294967295)"


def _repair_sql() -> str:
    """The search row by row, with the cost and the complete letters of each state (z: nothing yet, then the last initial)."""
    path = lambda state, cost, letter: f"{{'c': {state}.c + {cost}, 't': {state}.t || '{letter}'}}"
    only = lambda condition, path: f"CASE WHEN {condition} THEN {path} ELSE {{'c': 1000000000, 't': ''}} END"
    best = lambda *paths: f"list_min([{', '.join(paths)}])"
    none = "{'c': 1000000000, 't': ''}"
    stays = lambda state, letter, cost: path(state, f"{cost} + 3 * CAST(cut AS INTEGER)", letter)
    step = {
        "z": path("z", 4, "D"),
        "s": best(path("s", 4, "D"), only("NOT gone AND first = 's'", stays("z", "K", 0))),
        "u": best(path("u", 4, "D"), *(only("NOT gone AND first = 'u'", stays(p, "K", 0)) for p in "zsa"), *(only("NOT gone", stays(p, "R", 3)) for p in "zsa")),
        "a": best(path("a", 4, "D"), only("NOT gone AND first = 'a'", stays("u", "K", 0)), only("NOT gone", stays("u", "R", 3))),
    }
    moved = f"SELECT conv, place + 1 AS place, {', '.join(f'{e} AS {c}' for c, e in step.items())} FROM (SELECT p.*, r.first, r.gone, r.cut FROM paths p JOIN rows_ r ON r.conv = p.conv AND r.place = p.place + 1)"
    user = best("u", *(path(p, 3, "I") for p in "zsa"))
    inserted = lambda rows: f"SELECT conv, place, z, s, u2 AS u, {best('a', path('u2', 3, 'I'))} AS a FROM (SELECT *, {user} AS u2 FROM ({rows}))"
    return rf"""
WITH RECURSIVE convs AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
given AS (SELECT conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32_sql("coalesce(CAST(c.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations c JOIN convs ON c.conv_id IS NOT DISTINCT FROM convs.conv_id),
hurt AS (SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM given WHERE kind <> 0),
rows_ AS (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND last NOT IN ('.', '!', '?') AS cut FROM (SELECT conv, role, text, turn, substr(role, 1, 1) AS first,
    row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS place, NOT regexp_matches(text, '[^ 	-
]') AS blank,
    regexp_matches(text, '[^ 	-
]') AND row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM hurt)),
paths AS ({inserted(f"SELECT conv, 0 AS place, {{'c': 0, 't': ''}} AS z, {none} AS s, {none} AS u, {none} AS a FROM convs")} UNION ALL {inserted(moved)}),
ends AS (SELECT p.conv, {best("z", "a")} AS found FROM paths p LEFT JOIN (SELECT conv, max(place) AS n FROM rows_ GROUP BY 1) r ON r.conv = p.conv WHERE p.place = coalesce(r.n, 0)),
edits AS (SELECT conv, k, substr(t, k, 1) AS edit FROM (SELECT conv, found.t AS t, unnest(range(1, length(found.t) + 1)) AS k FROM ends)),
counted AS (SELECT *, sum(CAST(edit <> 'I' AS INTEGER)) OVER w AS place, sum(CAST(edit <> 'D' AS INTEGER)) OVER w AS line FROM edits WINDOW w AS (PARTITION BY conv ORDER BY k)),
lines AS (SELECT e.conv, e.line, e.edit, r.role, CASE e.edit WHEN 'I' THEN '' ELSE r.text END AS text, first_value(e.edit = 'K' AND r.first = 's') OVER (PARTITION BY e.conv ORDER BY e.line) AS system
  FROM counted e LEFT JOIN rows_ r ON r.conv = e.conv AND r.place = e.place WHERE e.edit <> 'D'),
texts AS (SELECT conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN (line + CAST(system AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY line) AS repaired FROM lines GROUP BY 1),
counts AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
    count(*) FILTER (WHERE place > 1 AND before || first NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT *, lag(first) OVER (PARTITION BY conv ORDER BY place) AS before FROM rows_) GROUP BY 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(found.c AS BIGINT) AS cost, found.t AS audit,
  sha256(coalesce(repaired, '')) AS repaired_sha256
FROM convs LEFT JOIN counts USING (conv) JOIN ends USING (conv) LEFT JOIN texts USING (conv)
"""


def _merkle_sql() -> str:
    """The manifest level by level: nodes of all trees, siblings of all leaves, then folds."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    leaf = lambda n: f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', n, 'text')))})"
    crc = _crc32_sql("CAST(doc_id AS VARCHAR)")
    tree = lambda name, base: f"""{name} AS ({base} UNION ALL
  SELECT level + 1, tree, idx // 2, sha256(h || coalesce(after, '')), (n + 1) // 2 FROM (SELECT *, lead(h) OVER (PARTITION BY tree ORDER BY idx) AS after FROM {name} WHERE n > 1) WHERE idx % 2 = 0)"""  # noqa: E731
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, lang, {leaf("n_chars")} AS leaf, CASE WHEN n_chars IS NOT NULL AND {crc} % 7 = 0 THEN {leaf("(n_chars + 1)")} END AS changed FROM documents),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM documents)),
placed AS (SELECT d.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang),
{tree("nodes", "SELECT 0 AS level, tree, idx, leaf AS h, n FROM placed")},
subroots AS (SELECT tree, h AS subroot FROM nodes WHERE n = 1),
{tree("upper_nodes", "SELECT 0 AS level, 0 AS tree, tree AS idx, subroot AS h, (SELECT count(*) FROM subroots) AS n FROM subroots")},
steps AS (SELECT r, m.level AS depth, (p.idx >> m.level) % 2 = 1 AS is_right, s.h AS sibling FROM placed p JOIN (SELECT DISTINCT level, tree FROM nodes WHERE n > 1) m ON m.tree = p.tree
    LEFT JOIN nodes s ON s.tree = p.tree AND s.level = m.level AND s.idx = xor(p.idx >> m.level, 1)
  UNION ALL SELECT r, 1000 + m.level, (p.tree >> m.level) % 2 = 1, s.h FROM placed p CROSS JOIN (SELECT DISTINCT level FROM upper_nodes WHERE n > 1) m LEFT JOIN upper_nodes s ON s.level = m.level AND s.idx = xor(p.tree >> m.level, 1)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY depth) AS step FROM steps),
folds AS (SELECT r, 0 AS step, coalesce(changed, leaf) AS h FROM placed UNION ALL
  SELECT f.r, f.step + 1, sha256(CASE WHEN is_right THEN coalesce(sibling, '') || h ELSE h || coalesce(sibling, '') END) FROM folds f JOIN ordered o ON o.r = f.r AND o.step = f.step + 1),
folded AS (SELECT r, arg_max(h, step) AS folded_root FROM folds GROUP BY 1), proofs AS (SELECT r, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM ordered GROUP BY 1),
root AS (SELECT h AS root FROM upper_nodes WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (tree) CROSS JOIN root LEFT JOIN proofs USING (r) JOIN folded USING (r)
"""


ORACLES: dict[str, str] = {
    "op2_line_dedup": DIGEST_SQL,
    "op8_norm_bucket_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER () AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS score,
    row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) DESC, c.vec_id, c.r) AS rank
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM s WHERE rank <= 5
""",
    "op11_collision_counting": """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT r, r AS other FROM v UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.other),
least AS (SELECT reach.r, min(o.vec_id) AS component_id FROM reach JOIN v o ON o.r = reach.other GROUP BY 1)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.r) AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN least USING (r)
""",
    "op12_merkle_manifest": _merkle_sql(),
    "op13_conversation_repair": _repair_sql(),
}
