"""Near-duplicate embeddings by collision counting on one-dimensional projections, then verified by their cosine."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, saved
from tidemark.llm.jaccard import components

#: Two vectors of one label link from this cosine on.
COSINE = 0.93
#: Projections on random normal directions on which collisions are counted; half a window, in standard deviations of the difference
#: of two vectors whose cosine is just COSINE.
PROJECTIONS, WINDOW = 24, 2.5
#: The pass count is the greatest one that a pair at COSINE, the hardest of those that link, reaches with this probability.
RECALL = 0.9995
#: Projections that order the vectors and deal them into blocks. Their windows are so wide (in the same unit) that a pair at COSINE is
#: outside with a chance of 6e-6 each.
LEADING, LEADING_WINDOW = 2, 4.5
#: Vectors of a block, and bytes of a block's components; blocks of a tile. Two tiles meet in a task.
BLOCK_ROWS, BLOCK_BYTES, TILE = 512, 4 << 20, 4
_SEED = 11
_ROW = "hash long, dim int, lead array<double>, c long, weight long, proj binary, unit binary"
_BLOCK = "block long, first long, dim1 int, low1 double, high1 double, last long, dim2 int, low2 double, high2 double, n int, hashes binary, dims binary, cs binary, weights binary, leads binary, projs binary, units binary"
_FOUND = "a long, b long, n long"


def deviation(cosine: float = COSINE) -> float:
    """Standard deviation of the projected difference of two unit vectors with that cosine, on a standard normal direction."""
    return math.sqrt(2 - 2 * cosine)


def pass_count(projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """The greatest count that a pair at the threshold reaches with probability `recall`: its collisions are binomial, as its
    difference falls on independent normal directions as independent normal numbers."""
    p = math.erf(window / math.sqrt(2))
    reached = 0.0
    for count in range(projections, -1, -1):
        reached += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if reached >= recall:
            return count
    return 0


@lru_cache(8)
def directions(dim: int) -> np.ndarray:
    """LEADING + PROJECTIONS standard normal directions, always the same for a dimension."""
    return np.random.default_rng([_SEED, dim]).standard_normal((LEADING + PROJECTIONS, dim))


def unit_vectors(v: np.ndarray) -> np.ndarray:
    """Rows over their lengths, in double precision; no square overflows or vanishes."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def collisions(left: np.ndarray, right: np.ndarray, window: float) -> np.ndarray:
    """How many projections of each pair (row of left, row of right) collide: the right value lies in the window around the left one.

    The right side's values are sorted for each projection, a window is a run of that order, and runs are added up by the
    differences at their ends.
    """
    counts = np.zeros((len(left), len(right)), np.uint8)
    rows = np.arange(len(left))
    for p in range(left.shape[1]):
        order = np.argsort(right[:, p], kind="stable")
        ordered = right[order, p]
        ends = np.zeros((len(left), len(right) + 1), np.int8)
        ends[rows, np.searchsorted(ordered, left[:, p] - window, "left")] += 1
        ends[rows, np.searchsorted(ordered, left[:, p] + window, "right")] -= 1
        counts[:, order] += np.cumsum(ends[:, :-1], axis=1, dtype=np.int8).view(np.uint8)
    return counts


def linked(left: dict, right: dict, cosine: float, least: int) -> np.ndarray:
    """Which pairs of two blocks of one dimension link: of equal label, with `least` collisions, verified by their cosine."""
    window = WINDOW * deviation(cosine) + 1e-5  # projections are kept as 32-bit floats
    same = left["hashes"][:, None] == right["hashes"][None, :]
    reach = LEADING_WINDOW * deviation(cosine) + 1e-9
    for p in range(LEADING):
        same &= np.abs(left["leads"][:, p][:, None] - right["leads"][:, p][None, :]) <= reach
    half = PROJECTIONS // 2
    counts = collisions(left["projs"][:, :half], right["projs"][:, :half], window)
    same &= counts >= least - (PROJECTIONS - half)
    i, j = np.nonzero(same)
    if len(i) > 0.1 * same.size:
        same &= counts + collisions(left["projs"][:, half:], right["projs"][:, half:], window) >= least
    elif len(i):
        more = (np.abs(left["projs"][i, half:] - right["projs"][j, half:]) <= window).sum(1)
        good = counts[i, j] + more >= least
        same[i[~good], j[~good]] = False
    i, j = np.nonzero(same)
    if len(i) > 0.02 * same.size:
        return same & (left["units"] @ right["units"].T >= cosine)
    good = np.einsum("ij,ij->i", left["units"][i], right["units"][j]) >= cosine
    same[i[~good], j[~good]] = False
    return same


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their class's keys, and one row for each class of equal vectors of a label: k1, k2, hash (of the label),
    embedding, weight (rows). Only vectors that can link have keys."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = vectors.select("vec_id", "label", "embedding", F.coalesce(usable, F.lit(False)).alias("usable"))
    key = lambda seed: F.when(F.col("usable"), F.xxhash64(F.lit(seed), "label", "embedding"))
    rows = rows.select("vec_id", "label", "embedding", key(1).alias("k1"), key(2).alias("k2"))
    # a copy is a row like any other; equal ones meet where they are, before anything moves
    grouped = rows.where("k1 is not null").groupBy("k1", "k2").agg(F.xxhash64(F.first("label")).alias("hash"), F.first("embedding").alias("embedding"), F.count("*").alias("weight"))
    return rows.select("vec_id", "k1", "k2"), grouped.withColumn("c", F.monotonically_increasing_id())


def _projected(classes: DataFrame) -> DataFrame:
    """_ROW of each class: its place on the projections, and its unit vector."""

    def run(batches):
        for batch in batches:
            v = batch.column(1)
            at = v.offsets.to_numpy()
            values = v.values.to_numpy().astype(np.float64)
            dims = np.diff(at)
            lead, proj, unit = ([None] * len(dims) for _ in range(3))
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                units = unit_vectors(values[at[rows][:, None] + np.arange(dim)])
                places = units @ directions(dim).T
                for k, r in enumerate(rows.tolist()):
                    lead[r], proj[r], unit[r] = places[k, :LEADING].tolist(), places[k, LEADING:].astype("<f4").tobytes(), units[k].astype("<f8").tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims.astype(np.int32)), pa.array(lead, pa.list_(pa.float64())), batch.column(2), batch.column(3), pa.array(proj, pa.binary()), pa.array(unit, pa.binary())], names=["hash", "dim", "lead", "c", "weight", "proj", "unit"])

    return classes.select("hash", F.transform("embedding", lambda c: c.cast("double")).alias("embedding"), "c", "weight").mapInArrow(run, _ROW)


def _blocks(rows: DataFrame, cosine: float) -> DataFrame:
    """One row (_BLOCK) for each run of vectors in the order of label, dimension and leading projections, with the first and last
    (label, dimension) and the span of the first leading projection in either."""

    def cut(held: list[tuple]) -> dict:
        hashes, dims, cs, weights = (np.array([r[i] for r in held], "<i8") for i in (0, 1, 3, 4))
        leads = np.array([r[2] for r in held], "<f8")
        row = {"block": held[0][3], "n": len(held), "hashes": hashes.tobytes(), "dims": dims.tobytes(), "cs": cs.tobytes(), "weights": weights.tobytes(), "leads": leads.tobytes(), "projs": b"".join(r[5] for r in held), "units": b"".join(r[6] for r in held)}
        for k, at in (("1", 0), ("2", -1)):
            own = leads[(hashes == hashes[at]) & (dims == dims[at]), 0]
            row |= {"first" if k == "1" else "last": int(hashes[at]), f"dim{k}": int(dims[at]), f"low{k}": float(own.min()), f"high{k}": float(own.max())}
        return row

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if held and (len(held) == BLOCK_ROWS or size + len(r[6]) > BLOCK_BYTES):
                    yield pa.RecordBatch.from_pylist([cut(held)], schema=_ARROW)
                    held, size = [], 0
                held.append(r)
                size += len(r[6])
        if held:
            yield pa.RecordBatch.from_pylist([cut(held)], schema=_ARROW)

    parts = max(1, min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BLOCK_ROWS)))
    keys = [F.col("hash"), F.col("dim"), F.floor(F.col("lead")[0] / (LEADING_WINDOW * deviation(cosine))), F.col("lead")[1], F.col("c")]
    return rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, _BLOCK)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
_ARROW = pa.schema([(c, _TYPES[t]) for c, t in (x.split() for x in _BLOCK.split(", "))])


def _meetings(blocks: DataFrame, cosine: float) -> DataFrame:
    """task, block, side: the blocks of each pair of tiles of which two may hold a pair that links (or one block may).

    Blocks of one label follow one another, so only the labels at their ends can meet another block. Of those, spans of the
    first leading projection must come within its window: blocks are joined by the cells of that width that they touch.
    """
    reach = LEADING_WINDOW * deviation(cosine)
    # one row for each block, without its vectors; the tile of a block is its place in the order, divided
    ends = blocks.select("block", "tile", F.explode(F.array(*(F.struct(F.col(h).alias("hash"), F.col(f"dim{k}").alias("dim"), F.col(f"low{k}").alias("low"), F.col(f"high{k}").alias("high")) for h, k in (("first", 1), ("last", 2))))).alias("e")).select("block", "tile", "e.*").distinct()
    cell = lambda c, by: F.floor(F.col(c) / reach).cast("long") + by
    left = ends.withColumn("cell", F.explode(F.sequence(cell("low", 0), cell("high", 0))))
    right = ends.withColumn("cell", F.explode(F.sequence(cell("low", -1), cell("high", 1)))).toDF("block2", "tile2", "hash", "dim", "low2", "high2", "cell")
    pairs = left.join(right, ["hash", "dim", "cell"]).where((F.col("block") < F.col("block2")) & (F.col("low2") - F.col("high") <= reach) & (F.col("low") - F.col("high2") <= reach))
    pairs = pairs.select(F.least("tile", "tile2").alias("t1"), F.greatest("tile", "tile2").alias("t2"), "block", "block2").unionByName(blocks.select(F.col("tile").alias("t1"), F.col("tile").alias("t2"), "block", F.col("block").alias("block2")))
    return pairs.select("t1", "t2", F.explode(F.array("block", "block2")).alias("block")).distinct()


def _side(table: pa.Table) -> list[dict]:
    out = []
    for r in table.to_pylist():
        n = r["n"]
        own = {"block": r["block"], "tile": r["tile"], "leads": np.frombuffer(r["leads"], "<f8").reshape(n, -1), "projs": np.frombuffer(r["projs"], "<f4").reshape(n, -1)}
        own |= {c: np.frombuffer(r[c], "<i8") for c in ("hashes", "dims", "cs", "weights")}
        ends = np.cumsum(own["dims"])
        units = np.frombuffer(r["units"], "<f8")
        # of each dimension by itself
        for dim in np.unique(own["dims"]).tolist():
            rows = np.flatnonzero(own["dims"] == dim)
            part = {c: own[c][rows] for c in ("hashes", "cs", "weights", "leads", "projs")}
            out.append({"block": own["block"], "tile": own["tile"], "dim": dim, "units": units[(ends[rows] - dim)[:, None] + np.arange(dim)], **part})
    return out


def _roots(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row and column of a matrix of links: the least row that it reaches; rows are numbered from 0."""
    n = len(links)
    left, right = np.arange(n), np.full(links.shape[1], n)
    while True:
        new_right = np.minimum(right, np.where(links, left[:, None], n).min(0, initial=n))
        new_left = np.minimum(left, np.where(links, new_right[None, :], n).min(1, initial=n))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors(vec_id, embedding, label).

    Two vectors link if their labels are equal and not null and their cosine, in double precision, is `cosine` or more. Vectors that are
    null, empty or zero, or hold null, NaN or infinite components, link with nothing, nor do vectors of different dimensions.
    n_links counts the other rows linked directly, component_id is the smallest vec_id reached by links, itself included,
    kept is whether the two are equal. Repeated rows are rows of their own that link with each other; rows that share a vec_id are told
    apart. A row with a null vec_id links as any other; its component is the smallest vec_id reached, null if there is none,
    and it is kept only in the latter case. An empty table gives an empty table; other columns don't matter.

    Every link that is returned is verified. A pair at the threshold is found with a probability of RECALL at least, less 2 x 6e-6 for the
    leading projections (the directions are the chance here, drawn once); nearer pairs with a greater one.

    Steps: (1) equal vectors are one class with a weight, so copies cost one vector; (2) classes are sorted by label and leading projections
    and cut into blocks; (3) blocks that may hold a pair within the leading windows meet in tiles; (4) there every projection is
    sorted, collisions in windows around each vector are counted by pair, and pairs that reach pass_count() are verified; a task
    gives a number of links for each vector and links that hold its components together, never all pairs.
    """
    rows, classes = _classes(vectors)
    rows, classes = saved(rows, "near-rows"), saved(classes, "near-classes")
    placed = saved(_projected(classes), "near-projections")
    blocks = saved(_blocks(placed, cosine), "near-blocks")
    order = [F.col("first"), F.col("dim1"), F.floor(F.col("low1") / (LEADING_WINDOW * deviation(cosine))), F.col("block")]
    blocks = saved(_with_tile(blocks, order), "near-tiles")
    least = pass_count()

    def meet(key, table):
        own = _side(table)
        t1, t2 = (k.as_py() for k in key)
        found: list[tuple] = []
        for x in own:
            for y in own:
                if x["tile"] != t1 or y["tile"] != t2 or x["dim"] != y["dim"] or (t1 == t2 and x["block"] > y["block"]):
                    continue
                if x["hashes"].max() < y["hashes"].min() or y["hashes"].max() < x["hashes"].min():
                    continue
                links = linked(x, y, cosine, least)
                one = x["block"] == y["block"]
                if one:
                    np.fill_diagonal(links, False)
                i, j = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
                if not len(i):
                    continue
                links = links[np.ix_(i, j)]
                found.append((x["cs"][i], None, links @ y["weights"][j]))
                if not one:
                    found.append((y["cs"][j], None, x["weights"][i] @ links))
                left, right = _roots(links)
                found.append((np.concatenate([x["cs"][i], y["cs"][j]]), x["cs"][i][np.concatenate([left, right])], None))
        a, b, n = [], [], []
        for c, root, count in found:
            a.append(c)
            b.append(pa.nulls(len(c), pa.int64()) if root is None else pa.array(root))
            n.append(pa.nulls(len(c), pa.int64()) if count is None else pa.array(count))
        if not a:
            return pa.table({c: pa.array([], pa.int64()) for c in ("a", "b", "n")})
        return pa.table({"a": np.concatenate(a), "b": pa.concat_arrays(b), "n": pa.concat_arrays(n)})

    tasks = saved(_meetings(blocks, cosine), "near-meetings")
    fetched = tasks.join(blocks.drop("first", "last", "dim1", "dim2", "low1", "low2", "high1", "high2"), "block")
    found = saved(fetched.groupBy("t1", "t2").applyInArrow(meet, _FOUND), "near-found")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null and a <> b").select("a", "b"))
    known = classes.select("k1", "k2", "c", "weight").join(counts, F.col("c") == F.col("a"), "left").join(roots, F.col("c") == F.col("node"), "left")
    known = saved(known.select("k1", "k2", F.coalesce("root", "c").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "near-known")
    # a class may hold a third of all rows: both sides are plain, so Spark splits it
    joined = saved(rows.join(known, ["k1", "k2"], "left"), "near-joined")
    smallest = joined.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    out = joined.join(smallest, "root", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _with_tile(blocks: DataFrame, order: list) -> DataFrame:
    """blocks with `tile`: TILE neighbours in the order share one."""
    places = numbered(blocks.select("block", *(c.alias(f"o{i}") for i, c in enumerate(order))), [f"o{i}" for i in range(len(order))], "place")
    return blocks.join(places.select("block", F.floor(F.col("place") / TILE).cast("long").alias("tile")), "block")
