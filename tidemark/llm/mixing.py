"""Mixing sources to target weights by the cube method (balanced sampling)."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, saved, word_count

EPS = 1e-9
#: Rows of one source that a task takes at a time, and open rows that one task merges.
BLOCK_ROWS = 5_000
#: Units of all sizes that fly only in the landing, which looks at all choices of them and of the 2 that a flight leaves.
HELD = 12
#: Sources that one task sorts, about.
SOURCES_A_TASK = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """source, source_size, source_docs, target of each source of sizes(source, size).

    Sources by code point, null last, take the weights in turn and share the total size by weight. A target stops at
    `most` times its source's size; the excess is reshared by weight among the others until none is above. Each round
    is one aggregate over one row for each source; sources without any size get a target of 0.
    """
    totals = saved(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs")), "mix-totals")
    tasks = min(int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + totals.count() // SOURCES_A_TASK)
    ranked = numbered(totals, [F.col("source").isNull(), "source"], "_mix_rank", tasks)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = saved(ranked.select("source", "source_size", "source_docs", F.element_at(cycle, (F.col("_mix_rank") % len(weights) + 1).cast("int")).alias("weight")), "mix-sources")
    cap = F.lit(float(most)) * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # the share of one unit of weight only rises, as capped sources leave; ends when none is newly capped
        capped = (F.col("weight") * level >= cap) if level else F.col("source_size") == 0
        taken, weight = ranked.agg(F.sum(F.when(capped, cap).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        if not weight:
            break
        new = (total - taken) / weight
        if new <= level * (1 + 1e-15):
            break
        level = new
    return ranked.withColumn("target", F.least(F.col("weight") * level, cap)).drop("weight")


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, held: np.ndarray | None = None) -> np.ndarray:
    """Moves inclusion probabilities along the null space of (document total, size total) until at most 2 are fractional.

    Units marked in `held` stay as they are, for the landing.

    Three open units at a time: u = (s2 - s3, s3 - s1, s1 - s2) keeps both totals. The step to either border is taken
    with the probability that keeps each unit's expectation.
    """
    p = [float(x) for x in p]
    s = [float(x) for x in size]
    dice = rng.random(len(p) + 1).tolist()
    hand: list[int] = []
    for i, x in enumerate(p):
        if x < EPS or x > 1 - EPS:
            p[i] = float(round(x))
            continue
        if held is not None and held[i]:
            continue
        hand.append(i)
        if len(hand) < 3:
            continue
        a, b, c = hand
        if s[a] == s[b] == s[c]:
            u = (1.0, -1.0, 0.0)
        else:
            u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
            top = max(abs(u[0]), abs(u[1]), abs(u[2]))
            u = (u[0] / top, u[1] / top, u[2] / top)
        up = down = 1e300
        for j, d in zip(hand, u, strict=True):
            if d > 0:
                up, down = min(up, (1 - p[j]) / d), min(down, p[j] / d)
            elif d < 0:
                up, down = min(up, p[j] / -d), min(down, (1 - p[j]) / -d)
        step = up if dice[i] * (up + down) < down else -down
        for j, d in zip(hand, u, strict=True):
            x = p[j] + step * d
            p[j] = 0.0 if x < EPS else 1.0 if x > 1 - EPS else x
        hand = [j for j in hand if 0.0 < p[j] < 1.0]
    return np.array(p)


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rounds the last open units to the choice whose size and document totals are nearest to those they stand for."""
    p = np.array(p, float)
    open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    p[(p <= EPS) | (p >= 1 - EPS)] = np.round(p[(p <= EPS) | (p >= 1 - EPS)])
    if open_.size:
        choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
        docs_off = np.abs(choices.sum(1) - p[open_].sum())
        size_off = np.abs(choices @ size[open_] - float(p[open_] @ size[open_]))
        p[open_] = choices[np.argmin(size_off + 0.02 * docs_off * max(1.0, size[open_].mean()))]
    return p


def _dice(source, block: int, seed: int) -> np.random.Generator:
    return np.random.default_rng([seed, zlib.crc32(str(source).encode()), source is None, block])


def _flight_of_block(last: bool, base: int):
    """The flight of the rows of one (source, block), with the landing in the last round."""

    def fly(key, pdf):
        source, block = None if pd.isna(key[0]) else key[0], int(key[1])
        pdf = pdf.sort_values(["doc_id", "size"], kind="stable", ignore_index=True)
        # by size, and units of all sizes are held back, so that the landing can meet almost any total
        pdf = pdf.iloc[_dice(source, block, base).permutation(len(pdf))].sort_values("size", ascending=False, kind="stable", ignore_index=True)
        size = pdf["size"].to_numpy(float)
        p = pdf["p"].to_numpy(float)
        open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
        held = np.zeros(len(p), bool)
        held[open_[np.linspace(0, len(open_) - 1, min(HELD, len(open_))).astype(int)]] = True
        p = flight(p, size, _dice(source, block, base + 1), held)
        pdf["p"] = landing(p, size) if last else p
        return pdf

    return fly


def cube_sample(units: DataFrame, seed: int = 1, spread: tuple[str, ...] = ()) -> DataFrame:
    """units(source, doc_id, size, p, ...) with `taken01`, 0 or 1: a sample balanced on both totals of each source. `spread` are
    columns that tell units apart that are equal in doc_id and size.

    Blocks of a source (by the hash of doc_id, size and number among equals, so that reruns agree) fly alone and leave HELD + 2 open units each at most; the open
    units of many blocks meet and fly again, until one block of each source is left, and its last units land. Each
    round is written, so a lost executor repeats one round at most. Work shrinks by the block size in each round.
    """
    columns = [c for c in units.columns if c not in ("p", "_cube_block", "taken01")]
    schema = units.select(*columns, F.lit(0.0).alias("p"), F.lit(0).cast("long").alias("_cube_block")).schema
    rows = units.count()
    blocks = max(1, -(-rows // BLOCK_ROWS))
    # equal units, which are interchangeable, are told apart by their number, so that a hot one spreads; numbers come in runs, which
    # are dealt out before they are made one by one
    copies = units.groupBy(*columns, "p").agg(F.count("*").alias("_cube_copies")).withColumn("_cube_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_cube_copies") - 1) / BLOCK_ROWS))))
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = copies.repartition(parts, F.xxhash64(*columns, "_cube_run"))
    last_one = F.least(F.col("_cube_copies"), (F.col("_cube_run") + 1) * BLOCK_ROWS)
    copies = copies.withColumn("_cube_copy", F.explode(F.sequence(F.col("_cube_run") * BLOCK_ROWS + 1, last_one)))
    open_ = copies.select(*columns, "p", F.pmod(F.xxhash64("doc_id", "size", *spread, "_cube_copy"), F.lit(blocks)).alias("_cube_block"))
    done = None
    while True:
        last = blocks == 1
        fly = _flight_of_block(last, seed * 1_000_003 + blocks)
        flown = saved(open_.groupBy("source", "_cube_block").applyInPandas(fly, schema), "mix-flight")
        decided = flown.where("p = 0 or p = 1")
        done = decided if done is None else done.unionByName(decided)
        if last:
            break
        blocks = -(-blocks * (HELD + 2) // BLOCK_ROWS)
        open_ = flown.where("p > 0 and p < 1").withColumn("_cube_block", F.pmod(F.col("_cube_block"), F.lit(blocks)))
    return done.select(*columns, F.col("p").cast("int").alias("taken01"))


def mix_documents(docs: DataFrame, seed: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies of every document: the mix takes it `copies` times, 0 to 3.

    A document of a source is expected target / source_size times: the whole part is taken for sure, the rest is its
    inclusion probability for the cube method. So each source's taken words differ from its target by a part of one
    document at most, and reruns agree. Null texts and texts without words have size 0; null doc_ids are documents as any
    others; an empty table gives an empty table; repeated rows are units of their own, and a row that makes up a large
    part of the table spreads over all blocks. Only numbers are shuffled, and the columns `keep`, which come along and tell rows
    apart: rows of one doc_id and size go to blocks by them.
    """
    sizes = saved(docs.select("doc_id", *keep, "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = saved(source_targets(sizes), "mix-targets")
    # targets has a row for each source; Spark broadcasts it only if its measured size allows, else the join is skew-split
    units = sizes.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select("d.doc_id", *(f"d.{c}" for c in keep), "d.source", "d.size", "t.source_size", "t.target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = units.withColumn("whole", F.floor(rate + EPS).cast("long")).withColumn("p", F.greatest(F.lit(0.0), rate - F.col("whole")))
    sampled = cube_sample(units, seed, keep)
    copies = F.col("whole") + F.col("taken01")
    return sampled.select("doc_id", *keep, "source", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"))
