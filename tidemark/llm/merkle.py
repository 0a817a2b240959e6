"""A Merkle manifest of a dataset: partitions acquire their upper proofs by butterfly exchange."""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import key_crc32, numbered, saved

#: Nodes of a run, which become one; leaves of a partition are FANOUT ** LOCAL_LEVELS, aligned.
FANOUT, LOCAL_LEVELS = 2, 11
#: Every so many documents (by crc32 of doc_id) are tampered with in the check.
TAMPER = 7


def digest(*parts: str) -> str:
    """Lowercase hex sha256 of the parts, concatenated."""
    return sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))), 256)


def height(n: int, fanout: int = FANOUT) -> int:
    """Levels over n leaves: runs are hashed while there are two nodes or more."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def lift(nodes: list[str], levels: int, fanout: int = FANOUT) -> tuple[list[list[str]], list[str]]:
    """The nodes of each of the lower levels, lowest first, and those of the level above them. A run may be short, even of one node."""
    rows = []
    for _ in range(levels):
        rows.append(nodes)
        nodes = [digest(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return rows, nodes


def siblings(rows: list[list[str]], at: int, fanout: int = FANOUT) -> list[tuple[str, str]]:
    """What stands left and right of the leaf's ancestor in its run, level by level, each concatenated."""
    out = []
    for nodes in rows:
        first = at - at % fanout
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fanout])))
        at //= fanout
    return out


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    for left, right in proof:
        leaf = digest(left, leaf, right)
    return leaf


def butterfly(units: DataFrame, total: str, level: int, fanout: int = FANOUT) -> DataFrame:
    """units(tree, part, digest, <total>, ...) with `digest`, now that of the tree's root, and `lefts`, `rights`: what stands beside the
    unit's ancestors, level by level.

    A unit is an aligned partition of fanout ** level leaves whose subtree has the root `digest`; <total> is the number of the
    tree's leaves. In each round the units whose subtrees make up one run swap their roots, each with those at its own place in
    the others' subtrees, and each hashes the parent by itself: after the round all units of the larger subtree hold its
    root, and no root ever travels down. Where the last subtree has fewer units, these serve the others' places in turn.
    A round moves fanout - 1 digests for each unit and is written, so a lost executor repeats one round at most; there are as
    many rounds as levels over the units.
    """
    most = units.agg(F.max(total)).first()[0]
    state = units.withColumns({"lefts": F.array().cast("array<string>"), "rights": F.array().cast("array<string>")})
    if most is None:
        return state
    span = 1  # units of a subtree
    for at in range(level, height(int(most), fanout)):
        # a tree without a run left to hash stands still
        nodes = F.ceil(F.col(total) / float(fanout**at)).cast("long")
        units_in_tree = F.ceil(F.col(total) / float(fanout**level)).cast("long")
        own = F.floor(F.col("part") / span).cast("long")
        run = F.col("_own") - F.col("_own") % fanout
        state = state.withColumns({"_own": own, "_nodes": nodes, "_units": units_in_tree}).withColumn("_open", F.col("_nodes") > 1)
        asks = state.where("_open").select("tree", "part", "_units", "_nodes", F.explode(F.filter(F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda i: run + i), lambda s: (s != F.col("_own")) & (s < F.col("_nodes")))).alias("_sub"))
        # the sibling subtree's unit at the same place, or in turn where it has fewer
        there = F.least(F.lit(span), F.col("_units") - F.col("_sub") * span)
        asks = asks.select("tree", "part", "_sub", (F.col("_sub") * span + F.pmod(F.col("part"), F.lit(span)) % there).alias("_peer"))
        gives = state.select(F.col("tree").alias("_t"), F.col("part").alias("_peer"), F.col("digest").alias("_got"))
        swapped = asks.join(gives, (F.col("tree") == F.col("_t")) & (asks["_peer"] == gives["_peer"])).groupBy("tree", "part").agg(F.sort_array(F.collect_list(F.struct("_sub", "_got"))).alias("_swapped"))
        state = state.join(swapped, ["tree", "part"], "left")
        beside = lambda keep: F.array_join(F.transform(F.filter(F.coalesce("_swapped", F.array().cast("array<struct<_sub:bigint,_got:string>>")), keep), lambda x: x["_got"]), "")
        state = state.withColumns({"_left": beside(lambda x: x["_sub"] < F.col("_own")), "_right": beside(lambda x: x["_sub"] > F.col("_own"))})
        new = {
            "digest": F.when(F.col("_open"), F.sha2(F.concat("_left", "digest", "_right"), 256)).otherwise(F.col("digest")),
            "lefts": F.when(F.col("_open"), F.array_append("lefts", F.col("_left"))).otherwise(F.col("lefts")),
            "rights": F.when(F.col("_open"), F.array_append("rights", F.col("_right"))).otherwise(F.col("rights")),
        }
        state = saved(state.withColumns(new).drop("_own", "_nodes", "_units", "_open", "_swapped", "_left", "_right"), "merkle-round")
        span *= fanout
    return state


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs (doc_id, source, lang, n_chars, text).

    Leaves of a language ascend by doc_id, null first, rows that share one by their digest (equal rows are leaves of their own with
    their own proofs); languages ascend bytewise, null first. Every 2 nodes in turn become one, the last run may be short, even of one
    node, which is hashed alone; a single leaf is its own root. proof_sha256 digests the siblings from the leaf to the root. To check
    the proofs, each is folded again from its leaf; where 7 divides crc32(doc_id), from the leaf of the row with n_chars + 1
    (rows with a null doc_id or n_chars stay as they are). verified: the folded root is the root. An empty table gives an
    empty table, other columns don't matter. Texts are hashed where they are and never move.

    Steps: leaves get their places by a sort of (lang, doc_id, leaf); aligned partitions of 2,048 hash their subtrees; partitions
    swap roots by butterfly, and so do languages; each partition folds its leaves' proofs, of which it has every part.
    """
    tampered = (key_crc32("doc_id") % TAMPER == 0) & F.col("n_chars").isNotNull()
    leaf = lambda n_chars: leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    changed = F.when(tampered, leaf(F.try_add(F.col("n_chars").cast("decimal(38,0)"), F.lit(1))))
    leaves = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), changed.alias("changed"))
    leaves = saved(numbered(leaves, [F.col("lang").isNotNull(), "lang", F.col("doc_id").isNotNull(), "doc_id", "leaf"], "place"), "merkle-leaves")
    langs = saved(leaves.groupBy("lang").agg(F.min("place").alias("_first"), F.count("*").alias("_n")), "merkle-langs")
    langs = saved(numbered(langs, ["_first"], "tree"), "merkle-trees")
    # a row for each language: broadcast if its measured size allows, else Spark splits a hot language
    own = langs.select(F.col("lang").alias("_l"), "_first", F.col("_n").alias("n"), "tree")
    placed = leaves.join(own, F.col("lang").eqNullSafe(F.col("_l"))).withColumn("at", F.col("place") - F.col("_first"))
    width = FANOUT**LOCAL_LEVELS
    placed = saved(placed.select("tree", F.floor(F.col("at") / width).cast("long").alias("part"), "at", "n", "doc_id", "leaf", "changed"), "merkle-placed")

    def ordered(table: pa.Table) -> tuple[pa.Table, list[list[str]], str]:
        table = table.sort_by("at")
        n = table.column("n")[0].as_py()
        rows, top = lift(table.column("leaf").to_pylist(), min(LOCAL_LEVELS, height(n)))
        return table, rows, top[0]

    def hash_up(key, table):
        table, _, top = ordered(table)
        return pa.table({"tree": [key[0].as_py()], "part": [key[1].as_py()], "n": table.column("n")[:1], "digest": [top]})

    parts = saved(placed.select("tree", "part", "at", "n", "leaf").groupBy("tree", "part").applyInArrow(hash_up, "tree long, part long, n long, digest string"), "merkle-parts")
    parts = butterfly(parts, "n", LOCAL_LEVELS)
    # any partition of a language has its subroot; languages are the leaves of one tree
    trees = saved(parts.where("part = 0").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("part"), "digest"), "merkle-subroots")
    n_langs = trees.count()
    trees = butterfly(trees.withColumn("n", F.lit(n_langs).cast("long")), "n", 0)
    upper = trees.select(F.col("part").alias("tree"), F.col("digest").alias("root"), F.col("lefts").alias("lang_lefts"), F.col("rights").alias("lang_rights"))
    state = saved(parts.select("tree", "part", F.col("digest").alias("subroot"), "lefts", "rights").join(upper, "tree"), "merkle-proofs")

    def prove(key, table, proofs):
        table, rows, _ = ordered(table)
        up = proofs.to_pylist()[0]
        shared = [*zip(up["lefts"], up["rights"], strict=True), *zip(up["lang_lefts"], up["lang_rights"], strict=True)]
        above = "".join(left + right for left, right in shared)
        sums, folded = [], []
        for at, leaf_, changed_ in zip(*(table.column(c).to_pylist() for c in ("at", "leaf", "changed")), strict=True):
            proof = siblings(rows, at % width)
            sums.append(digest(*(left + right for left, right in proof), above))
            folded.append(fold(changed_ or leaf_, [*proof, *shared]))
        n = len(sums)
        return pa.table({
            "doc_id": table.column("doc_id"), "leaf": table.column("leaf"), "subroot": [up["subroot"]] * n, "root": [up["root"]] * n, "proof_sha256": sums, "folded_root": folded,
            "verified": [x == up["root"] for x in folded],
        })

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return placed.groupBy("tree", "part").cogroup(state.groupBy("tree", "part")).applyInArrow(prove, schema)
