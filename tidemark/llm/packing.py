"""Best-fit packing of token pieces into sequences: local best fit, then repeated tree merges of underfull bins."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, saved
from tidemark.llm.tokens import release, tokenizer

#: Items that one task packs at a time; bins with at most this many free places are final at once.
BLOCK_ITEMS = 20_000
FREE_TOKENS = 8


def cut_pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's ids followed by end_id, cut only where over capacity."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("row", "piece", "start", "length", "ids_crc32")}
        for row, ids in enumerate(tokenizer(path, "words").encode(batch.column(1), end_id)):
            data = ids.astype("<u4").tobytes()
            for piece, at in enumerate(range(0, len(ids), capacity)):
                part = data[4 * at : 4 * (at + capacity)]
                for k, v in (("row", row), ("piece", piece), ("start", at), ("length", len(part) // 4), ("ids_crc32", crc32(part))):
                    out[k].append(v)
        ids = batch.column(0).take(pa.array(out["row"], pa.int64()))
        return pa.RecordBatch.from_arrays([ids, pa.array(out["piece"], pa.int32()), *(pa.array(out[k], pa.int64()) for k in ("start", "length", "ids_crc32"))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select("doc_id", "text"), cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin of each item, and its offset there.

    Open bins are kept by their free space; a number with a bit for each space that occurs finds the tightest one.
    """
    at, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = bins = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        if fits := spaces >> n:
            space = n + (fits & -fits).bit_length() - 1
            own = free[space].pop()
            if not free[space]:
                spaces ^= 1 << space
        else:
            own, space, bins = bins, capacity, bins + 1
        at[i], offset[i] = own, capacity - space
        space -= n
        free[space].append(own)
        spaces |= 1 << space
    return at, offset


def _merge_bins(round_no: int, capacity: int):
    """Best fit of a block's underfull bins into the bins of this round."""

    def again(key, pdf):
        pdf = pdf.sort_values(["fill", "bin"], ascending=[False, True], ignore_index=True)
        at, offset = best_fit(pdf["fill"].to_numpy(), capacity)
        fill = np.bincount(at, weights=pdf["fill"].to_numpy()).astype(np.int64)
        return pd.DataFrame({"bin": pdf["bin"], "to": (round_no << 56) + (int(key[0]) << 32) + at, "shift": offset, "full": fill[at]})

    return again


def pack(items: DataFrame, capacity: int = 4096) -> DataFrame:
    """items(..., _pack_block, length) with sequence_id and offset: no sequence is over capacity, offsets have no gaps.

    Round 1 packs each block (20,000 items of a hash block) by best fit, which puts long items first. In each further round
    the open bins are the items. A bin is final if at most FREE_TOKENS places are free in it, or fewer than the smallest open
    bin takes, so bins that fit no other never move. The others are dealt to blocks of the same size by the rank of
    their fill, from both ends: the first block has the smallest and the largest, and the smallest fits the largest, so
    each round merges bins. No task takes more than about one block, however many bins stay open. A round is written.
    """
    columns = items.columns
    n = items.count()
    blocks = max(1, -(-n // BLOCK_ITEMS))
    kept = [c for c in columns if c != "_pack_block"]
    schema = items.select(*kept, *(F.lit(0).cast("long").alias(c) for c in ("_pack_bin", "offset", "_pack_fill"))).schema
    order = [c for c in kept if c != "length"]

    def first(key, pdf):
        release()
        pdf = pdf.sort_values(["length", *order], ascending=[False] + [True] * len(order), ignore_index=True, kind="stable")
        at, offset = best_fit(pdf["length"].to_numpy(), capacity)
        fill = np.bincount(at, weights=pdf["length"].to_numpy()).astype(np.int64)
        return pdf[kept].assign(_pack_bin=(int(key[0]) << 32) + at, offset=offset, _pack_fill=fill[at])

    placed = saved(items.withColumn("_pack_block", F.pmod("_pack_block", F.lit(blocks))).groupBy("_pack_block").applyInPandas(first, schema), "pack-round1")
    final = placed.where(F.col("_pack_fill") >= capacity - FREE_TOKENS)
    open_bins = placed.where(F.col("_pack_fill") < capacity - FREE_TOKENS).groupBy("_pack_bin").agg(F.first("_pack_fill").alias("fill"))
    open_bins = open_bins.select(F.col("_pack_bin").alias("bin0"), F.col("_pack_bin").alias("bin"), F.lit(0).cast("long").alias("base"), "fill")
    round_no, whole, before = 1, None, None
    while True:
        # bins of one block of this round are the items of the next; bin0 is a bin of round 1 and base its place in `bin`
        open_bins = saved(open_bins, "pack-open")
        items_now = open_bins.groupBy("bin").agg(F.first("fill").alias("fill"))
        levels = sorted(tuple(r) for r in items_now.groupBy("fill").count().collect())  # a row for each fill: at most `capacity`
        least = max(FREE_TOKENS + 1, levels[0][0]) if levels else 0
        deal, n = [], 0
        for fill, count in levels:
            if fill <= capacity - least:
                deal.append((fill, n, count))
                n += count
        last = n < 2 or sum(c for _, c in levels) == before
        ended = (open_bins if last else open_bins.where(F.col("fill") > capacity - least)).select("bin0", "bin", "base")
        whole = ended if whole is None else whole.unionByName(ended)
        if last:
            break
        before, round_no, blocks = n, round_no + 1, -(-n // BLOCK_ITEMS)
        ranks = F.broadcast(items.sparkSession.createDataFrame(deal, "fill long, _pack_below long, _pack_same long"))
        rank = (F.col("_pack_below") + F.col("_pack_same") * (F.pmod(F.xxhash64("bin"), F.lit(1 << 30)) / (1 << 30))) / n
        block = F.least(F.floor(2 * blocks * F.least(rank, 1 - rank)), F.lit(blocks - 1)).cast("long")
        moves = items_now.join(ranks, "fill").select("bin", "fill", block.alias("_pack_block")).groupBy("_pack_block").applyInPandas(_merge_bins(round_no, capacity), "bin long, to long, shift long, full long")
        open_bins = open_bins.join(moves, "bin").select("bin0", F.col("to").alias("bin"), (F.col("base") + F.col("shift")).alias("base"), F.col("full").alias("fill"))
    rest = placed.where(F.col("_pack_fill") < capacity - FREE_TOKENS).join(whole.select(F.col("bin0").alias("_pack_bin"), F.col("bin").alias("_pack_to"), F.col("base").alias("_pack_base")), "_pack_bin")
    out = final.select(*kept, F.col("_pack_bin").alias("sequence_id"), "offset")
    return out.unionByName(rest.select(*kept, F.col("_pack_to").alias("sequence_id"), (F.col("offset") + F.col("_pack_base")).alias("offset")))


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    Null text counts as empty: its one piece is the end id. Only documents over capacity are cut. Repeated rows and
    rows with a null doc_id are packed as documents of their own; an empty table gives an empty table. Tokens are made once and only lengths move.
    """
    pieces = saved(cut_pieces(docs, path, capacity, end_id), "pack-pieces")
    # by the place in the written table, so that repeated rows and null ids spread
    packed = pack(pieces.withColumn("_pack_block", F.xxhash64(F.monotonically_increasing_id())), capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
