"""Exact top-k inner products: vectors in buckets by length, pruned by local cosine thresholds, products verified."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

#: Vectors of a bucket, and queries of a block.
BUCKET_ROWS, QUERY_ROWS = 2048, 1024
#: Buckets, and blocks, of a tile: what meets in one task. A block is moved once for each tile of buckets, not for each bucket.
TILE = 8
#: Blocks for each salt where the tiles' lengths are compared.
SALT_BLOCKS = 512
#: Products below 2^53 are exact in double precision; others are multiplied as whole numbers of any size.
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
#: Squares of lengths up to this are doubles.
_SQUARES = 1e150
_PART = "bucket long, tile long, dim int, most double, ids binary, rows binary, data binary"
_FOUND = "q_row long, query_id long, vec_id long, row long, score long, exact string"


def quantized(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v = floor(scale * x) of each component (a whole number, held as a double, which is exact), norm (its length).

    Vectors that are null, empty, or hold null, NaN or infinite components are left out, as are those of which scale * x
    is no finite double.
    """
    x = F.col("embedding")
    scaled = F.transform(x, lambda c: F.lit(float(scale)) * c.cast("double"))
    finite = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(x.isNotNull() & (F.size(x) > 0) & finite & F.col("vec_id").isNotNull())
    # beyond 2^53 every double is whole; floor itself gives a long
    whole = F.transform(scaled, lambda c: F.when(F.abs(c) < _EXACT, F.floor(c).cast("double")).otherwise(c))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    # squares of components over the greatest one: no length overflows on the way
    most = F.array_max(F.transform("v", lambda c: F.abs(c)))
    return rows.withColumn("_m", F.when(most > 0, most).otherwise(1.0)).withColumn("norm", F.col("_m") * F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + (c / F.col("_m")) * (c / F.col("_m"))))).drop("_m")


def _runs(batches, size: int):
    """Rows (vec_id, row, norm, v) that come in order, as (ids, rows, norms, matrix) of one dimension with at most `size` rows."""
    held: list[tuple] = []
    n = 0

    def block():
        return tuple(np.concatenate(x) for x in zip(*held, strict=True))

    for batch in batches:
        ids, rows, norms = (batch.column(i).to_numpy() for i in range(3))
        v = batch.column(3)
        at = v.offsets.to_numpy()
        values = v.values.to_numpy()
        dims = np.diff(at)
        i = 0
        while i < len(ids):
            if held and (n == size or held[0][3].shape[1] != dims[i]):
                yield block()
                held, n = [], 0
            other = np.flatnonzero(dims[i : i + size - n] != dims[i])
            j = i + int(other[0]) if other.size else min(len(ids), i + size - n)
            held.append((ids[i:j], rows[i:j], norms[i:j], values[at[i] : at[j]].reshape(j - i, -1)))
            n, i = n + j - i, j
    if held:
        yield block()


def _bucketed(rows: DataFrame, size: int, parts: int) -> DataFrame:
    """One row for each bucket: vectors of similar length (longest first), of one dimension. TILE buckets in turn share a tile."""

    def run(batches):
        tile = 0
        for i, (ids, own_rows, norms, v) in enumerate(_runs(batches, size)):
            tile = tile if i % TILE else int(own_rows[0])
            row = {"bucket": int(own_rows[0]), "tile": tile, "dim": v.shape[1], "most": float(norms.max()), "ids": ids.astype("<i8").tobytes(), "rows": own_rows.astype("<i8").tobytes(), "data": v.astype("<f8").tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema=_ARROW)

    keys = [F.size("v"), F.col("norm").desc(), F.col("vec_id"), F.col("row")]
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return dealt.select("vec_id", "row", "norm", "v").mapInArrow(run, _PART)


_ARROW = pa.schema([(c, {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}[t]) for c, t in (x.split() for x in _PART.split(", "))])


def norms_of(v: np.ndarray) -> np.ndarray:
    most = np.abs(v).max(1, initial=0.0)
    unit = v / np.where(most > 0, most, 1.0)[:, None]
    with np.errstate(over="ignore"):
        return most * np.sqrt((unit**2).sum(1))


def _products(q: np.ndarray, v: np.ndarray, bound: float) -> np.ndarray:
    """Whole-number products: longs where doubles are exact, else Python's whole numbers."""
    if bound < _EXACT:
        return (q @ v.T).astype(np.int64)
    whole = lambda x: np.array([int(c) for c in x.ravel().tolist()], object).reshape(x.shape)
    return whole(q) @ whole(v).T


def _at_most(score) -> float:
    """The greatest double that surely isn't over the whole number."""
    if -_EXACT <= score <= _EXACT:
        return float(score)
    try:
        return float(np.nextafter(float(int(score)), -np.inf))
    except OverflowError:
        return float(np.finfo(float).max) if score > 0 else -np.inf


def candidates(q: np.ndarray, q_len: float, v: np.ndarray, v_len: np.ndarray, floor: float, focus: int = 4) -> np.ndarray:
    """Which vectors of a bucket may reach the product `floor` with q, by the cheaper of two prunings.

    The local threshold is the least cosine with which a vector of the bucket's greatest length reaches `floor`. A high one
    limits where the coordinates can lie (coordinate pruning, on the query's largest coordinates: the rest of the unit
    vectors can add at most the product of their lengths); a low one leaves only the length test.
    """
    if q_len == 0 or floor <= 0:
        return np.arange(len(v))
    with np.errstate(over="ignore"):
        kept = np.flatnonzero(v_len * q_len >= floor * (1 - 1e-12))  # longest first, so this is a prefix
    if not kept.size or max(q_len, v_len[0]) > _SQUARES or floor < 0.5 * q_len * v_len[0]:
        return kept
    top = np.argsort(-np.abs(q))[:focus]
    part = v[kept][:, top]
    rest_q = np.sqrt(max(0.0, q_len**2 - float((q[top] ** 2).sum())))
    rest_v = np.sqrt(np.maximum(0.0, v_len[kept] ** 2 - (part**2).sum(1)))
    bound = part @ q[top] + rest_q * rest_v
    return kept[bound >= floor - 1e-6 * abs(floor) - 1e-6]


def _top(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i], rows[i]))[:k], np.int64)
    return np.lexsort((rows, ids, -scores))[:k]


def _side(table: pa.Table) -> list[dict]:
    """The rows of a tile's side, with arrays in place of bytes."""
    out = []
    for r in table.to_pylist():
        v = np.frombuffer(r["data"], "<f8").reshape(-1, r["dim"])
        out.append({**r, "v": v, "len": norms_of(v), **{c: np.frombuffer(r[c], "<i8") for c in ("ids", "rows")}, "floors": np.frombuffer(r["floors"], "<f8") if "floors" in r else None})
    return out


def _best(block: dict, buckets: list[dict], floors: np.ndarray, k: int) -> list[tuple | None]:
    """For each query of the block its k best (scores, ids, rows) among the buckets' vectors that may reach its floor."""
    hits: list[list[tuple]] = [[] for _ in floors]
    for b in buckets:
        if b["dim"] != block["dim"]:
            continue
        with np.errstate(over="ignore"):
            open_ = np.flatnonzero(~(floors > block["len"] * b["most"] * (1 + 1e-12)))  # other queries can't gain here
            limit = float(block["len"].max(initial=0.0)) * b["most"]
        some = [(j, candidates(block["v"][j], block["len"][j], b["v"], b["len"], floors[j])) for j in open_.tolist()]
        # queries for which pruning leaves many go together, in one product of matrices
        dense = [j for j, c in some if len(c) > 0.25 * len(b["v"])]
        scores = _products(block["v"][dense], b["v"], limit) if dense else None
        dense_at = {j: x for x, j in enumerate(dense)}
        for j, c in some:
            own, at = (scores[dense_at[j]], np.arange(len(b["v"]))) if j in dense_at else (_products(block["v"][j : j + 1], b["v"][c], limit)[0], c)
            good = (b["rows"][at] != block["rows"][j]) & (own >= floors[j])
            own, at = own[good], at[good]
            if len(own) > k and own.dtype != object:
                high = own >= np.partition(own, len(own) - k)[len(own) - k]
                own, at = own[high], at[high]
            if len(own):
                best = _top(own, b["ids"][at], b["rows"][at], k)
                hits[j].append((own[best], b["ids"][at[best]], b["rows"][at[best]]))
    out: list[tuple | None] = []
    for found in hits:
        if not found:
            out.append(None)
            continue
        wide = any(x[0].dtype == object for x in found)
        scores, ids, rows = (np.concatenate([x[i].astype(object) if wide and not i else x[i] for x in found]) for i in range(3))
        best = _top(scores, ids, rows, k)
        out.append((scores[best], ids[best], rows[best]))
    return out


def top_k(vectors: DataFrame, query_ids_divide_by: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest whole-number products of each query with all other rows.

    Queries are the rows whose vec_id is divisible by the number; a query meets every row but itself (a repeated row is
    another row; where query rows share an id, each has its k results). Ties go to the smaller vec_id. Only vectors of
    the query's dimension meet it. Finite components of any size take part; products are exact and compared as whole
    numbers, and a score beyond a long is given as the nearest long. Rows with a null vec_id or vector have no part; an
    empty table gives an empty table; other columns don't matter.

    Steps: (1) vectors are dealt by length into buckets; (2) each block of queries finds its k best in its dimension's
    longest bucket, whose last score is a lower bound; (3) tiles of TILE blocks and of TILE buckets are compared by
    lengths alone, and only pairs that may hold a better product are kept, each of which is the work of one group; (4)
    there blocks and buckets are compared by lengths again, vectors are pruned one by one against the bounds,
    multiplied and merged. Pairs of blocks and buckets are never listed.
    """
    spark = vectors.sparkSession
    rows = saved(quantized(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    n = rows.count()
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_ROWS)))
    buckets = saved(_bucketed(rows, BUCKET_ROWS, parts), "topk-buckets").withColumnRenamed("tile", "b_tile")
    queries = saved(_bucketed(rows.where(F.col("vec_id") % query_ids_divide_by == 0), QUERY_ROWS, max(1, parts // query_ids_divide_by)), "topk-queries")
    queries = queries.select(F.col("bucket").alias("block"), F.col("tile").alias("q_tile"), "dim", "ids", "rows", "data")

    def together(pairs: DataFrame, asked: DataFrame, against: DataFrame, function, schema: str) -> DataFrame:
        """function(key, blocks, buckets) for each pair(q_tile, b_tile) of tiles."""
        left = pairs.join(asked, "q_tile")
        right = pairs.select(F.col("q_tile").alias("for_q"), F.col("b_tile").alias("for_b")).join(against, F.col("for_b") == F.col("b_tile")).drop("b_tile")
        return left.groupBy("q_tile", "b_tile").cogroup(right.groupBy("for_q", "for_b")).applyInArrow(function, schema)

    def warm(key, left, right):
        found = {"block": [], "floors": [], "reach": []}
        longest = _side(right)
        for block in (x for x in _side(left) if x["dim"] == longest[0]["dim"]):
            best = _best(block, longest, np.full(len(block["v"]), -np.inf), k)
            floors = np.array([_at_most(b[0][-1]) if b is not None and len(b[0]) == k else -np.inf for b in best])
            # a bucket matters to a query if its greatest length is at least floor / length of the query
            usable = (block["len"] > 0) & np.isfinite(block["len"])
            reach = np.where(usable, floors / np.where(usable, block["len"], 1.0), -np.inf).min()
            for c, x in (("block", block["block"]), ("floors", floors.astype("<f8").tobytes()), ("reach", float(reach))):
                found[c].append(x)
        return pa.table({"block": pa.array(found["block"], pa.int64()), "floors": pa.array(found["floors"], pa.binary()), "reach": pa.array(found["reach"], pa.float64())})

    def meet(key, left, right):
        out: list[tuple] = []
        against = _side(right)
        for block in _side(left):
            for j, best in enumerate(_best(block, against, block["floors"], k)):
                for score, vec_id, row in zip(*(x.tolist() for x in best), strict=True) if best is not None else ():
                    near = max(-_LONG - 1, min(_LONG, score))
                    out.append((int(block["rows"][j]), int(block["ids"][j]), vec_id, row, near, None if near == score else str(score)))
        columns = list(zip(*out, strict=True)) if out else [()] * 6
        return pa.table({c: pa.array(x, pa.string() if c == "exact" else pa.int64()) for c, x in zip(("q_row", "query_id", "vec_id", "row", "score", "exact"), columns, strict=True)})

    # the longest bucket of each dimension is a tile of its own here; blocks of a tile that spans dimensions stay apart
    first = buckets.groupBy("dim").agg(F.max_by("bucket", F.struct("most", "bucket")).alias("bucket"))
    longest = buckets.join(first.select("bucket"), "bucket").withColumn("b_tile", F.col("bucket"))
    begin = queries.select("q_tile", "dim").distinct().join(longest.select("dim", "b_tile"), "dim")
    floors = saved(together(begin.select("q_tile", "b_tile"), queries, longest, warm, "block long, floors binary, reach double"), "topk-floors")
    # lengths alone decide which tiles meet; a salt beside the dimension spreads them
    salts = max(1, -(-queries.count() // SALT_BLOCKS))
    asking = queries.select("block", "q_tile", "dim").join(floors.select("block", "reach"), "block").groupBy("q_tile", "dim").agg(F.min("reach").alias("reach"))
    asking = asking.withColumn("salt", F.pmod(F.xxhash64("q_tile"), F.lit(salts)))
    salted = buckets.groupBy("b_tile", "dim").agg(F.max("most").alias("most")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    pairs = asking.join(salted, ["dim", "salt"]).where(F.col("most") * (1 + 1e-12) >= F.col("reach")).select("q_tile", "b_tile").distinct()
    found = together(saved(pairs, "topk-pairs"), queries.join(floors.drop("reach"), "block"), buckets, meet, _FOUND)

    def merge(key, table):
        ids, own = (table.column(c).to_numpy() for c in ("vec_id", "row"))
        exact = table.column("exact").to_pylist()
        score = table.column("score").to_numpy()
        order = np.array([s if x is None else int(x) for s, x in zip(score.tolist(), exact, strict=True)], object) if any(x is not None for x in exact) else score
        best = _top(order, ids, own, k)
        return pa.table({"query_id": table.column("query_id").take(pa.array(best)), "rank": pa.array(np.arange(1, len(best) + 1), pa.int32()), "vec_id": ids[best], "score": score[best]})

    return found.groupBy("q_row").applyInArrow(merge, "query_id long, rank int, vec_id long, score long")
