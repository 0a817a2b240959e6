"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, mix, numbered

ROUNDS = 6


def _feistel(x: np.ndarray, a: int, b: int, seed: int) -> np.ndarray:
    """An unbalanced Feistel network over 0..a*b-1: halves are numbers modulo a and b, so the domain is close to N."""
    left, right = x // a, x % a  # left < b, right < a
    for k in range(ROUNDS):
        key = np.uint64((seed * 0x9E3779B97F4A7C15 + (k + 1) * 0xD1342543DE82EF95) % (1 << 64))
        if k % 2 == 0:
            left = (left + (mix(right.astype(np.uint64) ^ key) % np.uint64(b)).astype(np.int64)) % b
        else:
            right = (right + (mix(left.astype(np.uint64) ^ key) % np.uint64(a)).astype(np.int64)) % a
    return left * a + right


def permute(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The place of each row number in the shuffled order: a permutation of 0..n-1 that any worker can compute.

    Cycle walking: what falls on n or above is permuted again. The domain has fewer than n + 2 * sqrt(n) + 1 numbers,
    so few rows walk at all.
    """
    a = max(1, int(np.ceil(np.sqrt(n))))
    b = max(1, -(-n // a))
    out = _feistel(np.asarray(rows, np.int64), a, b, seed)
    while (outside := np.flatnonzero(out >= n)).size:
        out[outside] = _feistel(out[outside], a, b, seed)
    return out


def shard(df: DataFrame, order: list, shards: int = 24, seed: int = 1) -> DataFrame:
    """df with `shard` and `slot`: row counts of shards differ by one at most, slots of a shard run from 0 without gaps.

    The rows get global numbers in the given total order (rows that are equal in it are interchangeable), the
    permutation gives number p, and shard = p mod shards, slot = p div shards. The same rows, order and seed give the
    same result however they are partitioned. Nulls in `order` come first; an empty table gives an empty table; repeated
    rows get a place each; columns of df named shard or slot are replaced. One range shuffle of df.
    """
    rows = numbered(df.drop("shard", "slot"), order, "slot")
    n = rows.count()
    names = rows.columns

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = names.index("slot")
        p = permute(batch.column(at).to_numpy(), n, seed)
        kept = [(name, batch.column(i)) for i, name in enumerate(names) if i != at]
        return pa.RecordBatch.from_arrays([*(c for _, c in kept), pa.array((p % shards).astype(np.int32)), pa.array(p // shards)], names=[*(x for x, _ in kept), "shard", "slot"])

    schema = rows.drop("slot").withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).schema
    return map_batches(rows, place, schema)


def documents_to_shards(docs: DataFrame, shards: int = 24, seed: int = 1) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text and 8), text_crc32, law `rows`, shard, slot, grown_shard (null).

    Null texts have size 8 and the checksum of no bytes. Only numbers are shuffled, never texts. Rows are ordered by
    doc_id, then checksum and size; repeated rows are interchangeable.
    """
    small = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = shard(small, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
