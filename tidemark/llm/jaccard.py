"""N-gram Jaccard join: prefixes with token combinations for frequent tokens, single tokens for rare ones, then verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import _U, map_batches, mix, run_hashes, saved, text_chunks, window_hashes, word_bounds

#: Words of a shingle, and the similarity from which two documents link, as a ratio of whole numbers.
SHINGLE_WORDS = 5
SIMILAR = (4, 5)
#: A token is frequent if so many documents have it. Frequent tokens are indexed in pairs.
FREQUENT_DOCS = 64
#: Documents of fewer tokens are indexed by single tokens throughout.
LEAST_FOR_PAIRS = 16
#: Bits of each map of token classes (2 to 4 for each token), and of document maps, at most: their size is bounded. A fuller map only
#: makes tokens look more frequent, or documents more interesting, for all documents alike: it costs time, never a link.
MOST_CLASS_BITS, MOST_DOC_BITS = 27, 27
#: Bytes of token hashes that a task counts at a time, about; map parts that come back (as a power of two).
RANGE_BYTES, _MAP_PARTS = 2 << 20, 8
#: Buckets up to this size list all their pairs at once; larger ones first link to leaders, then what is still apart meets.
SMALL_BUCKET = 8
_BLOCK_BITS = 18
#: Documents and tokens of a block, about, in groups of which nearly all pairs are candidates.
BLOCK_DOCS, BLOCK_TOKENS = 500, 1_000_000


# ---- sets -------------------------------------------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the k-word shingles of each document; of the whole sequence if it is shorter."""
    starts, ends, first = word_bounds(data, offsets)
    words = run_hashes(data, starts, ends, lower=True)
    windows = window_hashes(words, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            own = np.sort(windows[a : b - k + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            yield mix(window_hashes(words[a:b], b - a) ^ _U(b - a))
        else:
            yield np.zeros(0, _U)


def _set_key(own: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone."""
    with np.errstate(over="ignore"):
        return int(mix(own ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U).view(np.int64)), int(mix(own ^ _U(0x14057B7EF767814F)).sum(dtype=_U).view(np.int64))


def _sets(docs: DataFrame, id_type: str) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [(len(own), *_set_key(own)) for _, _, data, offsets in text_chunks(batch.column(1)) for own in shingle_sets(data, offsets)]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in zip(*sets, strict=True))], names=["doc_id", "n", "k1", "k2"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {id_type}, n long, k1 long, k2 long")


# ---- maps of bits -----------------------------------------------------------------------------------------------------


def _slot(bits: int) -> Column:
    return F.xxhash64("doc_id").bitwiseAND((1 << bits) - 1)


def _document_map(ids: DataFrame, bits: int) -> np.ndarray:
    """A map with the bit of each doc_id set, made in blocks by Spark: 2^bits bits come back, whatever the number of rows."""
    block = min(bits, _BLOCK_BITS)

    def fill(key, table):
        own = np.zeros(1 << block, bool)
        own[table.column("slot").to_numpy() & ((1 << block) - 1)] = True
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(own).tobytes()], pa.binary())})

    slots = ids.select(_slot(bits).alias("slot")).distinct().withColumn("block", F.shiftright("slot", block))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for at, data in slots.groupBy("block").applyInArrow(fill, "block long, bits binary").collect():
        out[at << (block - 3) : (at + 1) << (block - 3)] = np.frombuffer(data, np.uint8)
    return np.packbits(np.unpackbits(out, count=1 << bits)) if bits < 3 else out


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _class_maps(docs: DataFrame, wanted: np.ndarray, bits: int, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Maps of the tokens that 2 documents have, and of those that FREQUENT_DOCS have, by their upper bits.

    Each distinct set counts once (nearly). Tokens go to the task of their range as 32-bit rests, each at most
    FREQUENT_DOCS times from a batch; a task counts the documents of its tokens. Ranges are so many that each takes about
    RANGE_BYTES, however many tokens there are; the bits of neighbours are put together before they come back, in
    2^_MAP_PARTS parts. The maps' size is fixed.
    """
    class_bits = int(np.clip(int(tokens * 2).bit_length(), 18, MOST_CLASS_BITS))
    spread = int(np.clip(np.ceil(np.log2(max(1, tokens * 4 / RANGE_BYTES))), 3, class_bits - 3))
    together = max(0, spread - _MAP_PARTS)

    def deal(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(sets)
        sets.clear()
        every.sort()
        at = np.flatnonzero(np.concatenate([every[1:] != every[:-1], [True]]))
        counts = np.diff(np.concatenate([[-1], at]))
        every = np.repeat(every[at], np.minimum(counts, FREQUENT_DOCS))
        rest = ((every >> _U(32 - spread)) & _U(0xFFFFFFFF)).astype(np.uint32)
        ranges = (every >> _U(64 - spread)).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(ranges[1:] != ranges[:-1]) + 1, [len(ranges)]]).tolist()
        parts = [(int(ranges[a]), rest[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], names=["range", "rests"])

    def count(key, table):
        rests = np.sort(np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("rests")]))
        ends = np.flatnonzero(np.concatenate([rests[1:] != rests[:-1], [True]]))
        docs = np.diff(np.concatenate([[-1], ends]))
        cells = rests[ends] >> np.uint32(32 - class_bits + spread)
        found = {"range": pa.array([key[0].as_py()], pa.int32())}
        for name, least in (("shared", 2), ("frequent", FREQUENT_DOCS)):
            own = np.zeros(1 << (class_bits - spread), bool)
            own[cells[docs >= least]] = True
            found[name] = pa.array([np.packbits(own).tobytes()], pa.binary())
        return pa.table(found)

    width = 1 << (class_bits - spread - 3)

    def join(key, table):
        found = {"range": pa.array([key[0].as_py()], pa.int32())}
        first = key[0].as_py() << together
        for name in ("shared", "frequent"):
            own = np.zeros(width << together, np.uint8)
            for at, data in zip(table.column("range").to_pylist(), table.column(name), strict=True):
                own[(at - first) * width : (at - first + 1) * width] = np.frombuffer(data.as_buffer(), np.uint8)
            found[name] = pa.array([own.tobytes()], pa.binary())
        return pa.table(found)

    maps = [np.zeros((1 << class_bits) // 8, np.uint8) for _ in range(2)]
    schema = "range int, shared binary, frequent binary"
    counted = _over_sets(docs, wanted, bits, deal, "range int, rests binary").groupBy("range").applyInArrow(count, schema)
    for at, *data in counted.groupBy(F.shiftright("range", together).alias("part")).applyInArrow(join, schema).collect():
        for m, d in zip(maps, data, strict=True):
            m[at * (width << together) : (at + 1) * (width << together)] = np.frombuffer(d, np.uint8)
    return maps[0], maps[1]


# ---- index ------------------------------------------------------------------------------------------------------------


def _pair_groups(own: np.ndarray, scheme: int, need: int) -> np.ndarray:
    """Keys of the pairs of frequent tokens (in order) that a document of that scheme is indexed by.

    Tokens fall into groups by hash. The prefix is extended until the groups' tokens beyond the first of each make up
    `need`: two documents that share no pair of one group lack at least so many of these tokens.
    """
    groups = max(1, (1 << scheme) // 16)
    group = (mix(own ^ _U(0x9E6C63D0876A9A47)) % _U(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    again = np.ones(len(own), bool)
    firsts = order[np.concatenate([[True], group[order[1:]] != group[order[:-1]]])]
    again[firsts] = False
    end = int(np.searchsorted(np.cumsum(again), need)) + 1
    own, group = own[:end], group[:end]
    keys = []
    for g in np.unique(group):
        tokens = own[group == g]
        i, j = np.triu_indices(len(tokens), 1)
        keys.append(mix(tokens[i] * _U(0x9FB21C651E98DF25) + tokens[j]) ^ _U(scheme * 2 + 1))
    return np.concatenate(keys)


def index_keys(own: np.ndarray, shared: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Keys of a set's prefix: any two sets that link have a key in common.

    Tokens are ordered by class, then by value: those of one document first, then rare ones, then frequent ones. A set x
    that links with y has at most x // 5 tokens that y lacks. So of its first x // 5 + 1 tokens one is shared, and the
    prefix of the set whose prefix ends first lies within the other's order. Tokens of one document need no key. Where
    frequent tokens belong to the prefix it is extended, and they are indexed in pairs (see _pair_groups), for the scheme
    of the set's own size and of the smallest size that may link with it.
    """
    class_bits = (8 * len(shared)).bit_length() - 1
    cell = (own >> _U(64 - class_bits)).astype(np.int64)
    is_shared, is_frequent = _has(shared, cell), _has(frequent, cell)
    need = len(own) // SIMILAR[1] + 1 - int((~is_shared).sum())
    if need <= 0:
        return np.zeros(0, _U)
    rare, often = own[is_shared & ~is_frequent], own[is_frequent]
    if len(rare) >= need:
        return rare[:need]
    need -= len(rare)
    keys = [rare]
    for scheme in sorted({len(own).bit_length() - 1, (-(-len(own) * SIMILAR[0] // SIMILAR[1])).bit_length() - 1}):
        keys.append(often[:need] ^ _U(scheme * 2 + 1) if 1 << scheme < LEAST_FOR_PAIRS else _pair_groups(often, scheme, need))
    return np.concatenate(keys)


def _over_sets(docs: DataFrame, wanted: np.ndarray, bits: int, function, schema: str, once: bool = True) -> DataFrame:
    """function(ids, sets) of the documents in the map, batch by batch; each distinct set once in a batch. Texts don't move."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            take = np.flatnonzero(_has(shared.value, batch.column(2).to_numpy()))
            seen: set = set()
            rows, sets = [], []
            at = 0
            for _, _, data, offsets in text_chunks(batch.column(1).take(pa.array(take))):
                for own in shingle_sets(data, offsets):
                    if len(own) and not (once and (key := _set_key(own)) in seen):
                        if once:
                            seen.add(key)
                        rows.append(take[at])
                        sets.append(own)
                    at += 1
            out = function(batch.column(0).take(pa.array(rows, pa.int64())), sets) if sets else None
            if out is not None and out.num_rows:
                yield out

    return docs.select("doc_id", "text", _slot(bits).alias("slot")).mapInArrow(run, schema)


def _postings(docs: DataFrame, wanted: np.ndarray, bits: int, id_type: str, maps: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(maps)

    def index(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        keys = [index_keys(own, *shared.value) for own in sets]
        counts = np.array([len(k) for k in keys])
        rows = np.repeat(np.arange(len(sets)), counts)
        sizes = np.repeat(np.array([len(x) for x in sets]), counts)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), ids.take(pa.array(rows)), pa.array(sizes)], names=["key", "id", "n"])

    return _over_sets(docs, wanted, bits, index, f"key long, id {id_type}, n long")


def _bucket_rows(postings: DataFrame, id_type: str) -> DataFrame:
    """big, key, a, b, n: pairs of small buckets and (member, leader) of large ones; for the latter also the members alone.

    Rows stream in the order of key and size, so a bucket of any size needs little memory, and gives a number of rows in
    proportion to its size. A leader's pairs end where sizes are too different to link.
    """

    def run(batches):
        out: list[tuple] = []
        key, held, leader, counted = None, [], None, 0

        def pairs():
            for i, (a, n) in enumerate(held):
                for b, m in held[i + 1 :]:
                    if a != b and SIMILAR[1] * n >= SIMILAR[0] * m:
                        out.append((False, key, a, b, m))

        def star(a, n):
            nonlocal leader
            if leader is None or SIMILAR[1] * leader[1] < SIMILAR[0] * n:
                leader = (a, n)
            elif a != leader[0]:
                out.append((False, key, leader[0], a, n))
            out.append((True, key, a, None, n))

        def batch_of(rows):
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.bool_(), pa.int64(), id_arrow, id_arrow, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["big", "key", "a", "b", "n"])

        for batch in batches:
            id_arrow = batch.column(1).type
            keys = batch.column(0).to_numpy()
            # buckets of one row inside the batch vanish at once
            alone = np.ones(len(keys), bool)
            alone[1:] &= keys[1:] != keys[:-1]
            alone[:-1] &= keys[:-1] != keys[1:]
            alone[[0, -1]] = False
            rest = batch.filter(pa.array(~alone))
            for k, a, n in zip(*(rest.column(i).to_pylist() for i in range(3)), strict=True):
                if k != key:
                    pairs()
                    key, held, leader, counted = k, [], None, 0
                counted += 1
                if counted <= SMALL_BUCKET:
                    held.append((a, n))
                else:
                    for x in held:
                        star(*x)
                    held = []
                    star(a, n)
            if out:
                yield batch_of(out)
                out = []
        pairs()
        if out:
            yield batch_of(out)

    n = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = postings.repartition(n, "key").sortWithinPartitions("key", "n", "id")
    return dealt.mapInArrow(run, f"big boolean, key long, a {id_type}, b {id_type}, n long")


# ---- links and components ---------------------------------------------------------------------------------------------


def _sets_of(ids: DataFrame, docs: DataFrame, id_type: str) -> DataFrame:
    """id, own (as longs) of the documents in ids(doc_id), made again from their texts; texts don't move."""
    ids = saved(ids, "jaccard-ids")
    bits = int(np.clip(int(ids.count() * 16).bit_length(), 3, MOST_DOC_BITS))

    def as_longs(found: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([found, pa.array([own.view(np.int64) for own in sets], pa.list_(pa.int64()))], names=["id", "own"])

    sets = _over_sets(docs, _document_map(ids, bits), bits, as_longs, f"id {id_type}, own array<bigint>", once=False)
    return saved(sets.join(ids, F.col("id") == F.col("doc_id"), "left_semi"), "jaccard-sets")


def _verified(pairs: DataFrame, docs: DataFrame, id_type: str) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), docs, id_type)
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("own").alias("own_b")), "b").join(sets.select(F.col("id").alias("a"), F.col("own").alias("own_a")), "a")
    shared = F.size(F.array_intersect("own_a", "own_b"))
    return both.where(SIMILAR[1] * shared >= SIMILAR[0] * (F.size("own_a") + F.size("own_b") - shared)).select("a", "b")


def _dense_links(open_rows: DataFrame, docs: DataFrame, id_type: str) -> DataFrame:
    """Links (a, b) that join what is still apart, among documents (key, id, n, root) that share keys of large buckets.

    Documents that share such keys, directly or by others, form a group, in which nearly all pairs are candidates. No pair
    is listed: a group is cut by size (a band's documents link only with those of the same or the next band) and by
    hash into blocks of about BLOCK_DOCS, and each pair of blocks is one task, which counts shared tokens by an inverted index and
    gives at most one link for each document that it joins to another component.
    """
    lead = open_rows.groupBy("key").agg(F.min("id").alias("lead"))
    edges = open_rows.join(lead, "key").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    groups = components(edges.where("a <> b"))
    band = F.floor(F.log(F.col("n")) / float(np.log(SIMILAR[1] / SIMILAR[0])) + 1e-9).cast("int")
    members = open_rows.select("id", "n", "root").distinct().join(groups.select(F.col("node").alias("id"), F.col("root").alias("group")), "id").withColumn("band", band)
    members = saved(members, "jaccard-members")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int")
    sizes = members.groupBy("group", "band").agg(blocks.alias("blocks"))
    sizes = saved(sizes, "jaccard-blocks")
    near = lambda by, name: sizes.select("group", (F.col("band") + by).alias("band"), F.col("blocks").alias(name))
    placed = members.join(sizes, ["group", "band"]).join(near(-1, "above"), ["group", "band"], "left").join(near(1, "below"), ["group", "band"], "left")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    numbers = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    task = lambda low, step, i, j, side: F.struct(low.alias("low"), F.lit(step).alias("step"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    tasks = F.concat(
        F.transform(F.filter(numbers("blocks"), lambda j: j >= own), lambda j: task(F.col("band"), 0, own, j, 0)),
        F.transform(F.filter(numbers("blocks"), lambda i: i < own), lambda i: task(F.col("band"), 0, i, own, 1)),
        F.transform(numbers("above"), lambda j: task(F.col("band"), 1, own, j, 0)),
        F.transform(numbers("below"), lambda i: task(F.col("band") - 1, 1, i, own, 1)),
    )
    dealt = placed.select("id", "root", "group", F.explode(tasks).alias("t")).select("id", F.xxhash64("root").alias("root"), F.xxhash64("group", "t.low", "t.step", "t.i", "t.j").alias("task"), (F.col("t.i") == F.col("t.j")) & (F.col("t.step") == 0), "t.side")
    dealt = dealt.toDF("id", "root", "task", "one", "side")
    # tasks whose documents are joined already have nothing to find
    apart = dealt.groupBy("task").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("task")
    dealt = saved(dealt.join(apart, "task", "left_semi"), "jaccard-dealt")
    sets = _sets_of(dealt.select(F.col("id").alias("doc_id")).distinct(), docs, id_type)

    def join(key, table):
        ids, roots = table.column("id").combine_chunks(), table.column("root").to_numpy()
        own = table.column("own").combine_chunks()
        tokens, at = own.values.to_numpy().view(_U), own.offsets.to_numpy()
        side, one = table.column("side").to_numpy(), bool(table.column("one")[0].as_py())
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if one else 1))
        parent = {r: r for r in roots.tolist()}

        def find(r):
            while parent[r] != r:
                parent[r] = r = parent[parent[r]]
            return r

        pairs = []
        if len(left) and len(right):
            counts = (at[1:] - at[:-1])[right]
            flat = np.concatenate([tokens[at[d] : at[d + 1]] for d in right])
            doc = np.repeat(np.arange(len(right)), counts)
            order = np.argsort(flat, kind="stable")
            doc = doc[order]
            words, first = np.unique(flat[order], return_index=True)
            ends = np.append(first[1:], len(flat))
            for a in left.tolist():
                mine = tokens[at[a] : at[a + 1]]
                w = np.minimum(np.searchsorted(words, mine), len(words) - 1)
                w = w[words[w] == mine]
                if not len(w):
                    continue
                n = ends[w] - first[w]
                stop = np.cumsum(n)
                both = np.bincount(doc[np.repeat(first[w] - (stop - n), n) + np.arange(stop[-1])], minlength=len(right))
                for b in right[SIMILAR[1] * both >= SIMILAR[0] * (len(mine) + counts - both)].tolist():
                    x, y = find(int(roots[a])), find(int(roots[b]))
                    if x != y:
                        parent[x] = y
                        pairs.append((a, b))
        a, b = (pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1))
        return pa.table({"a": ids.take(a), "b": ids.take(b)})

    rows = dealt.join(sets.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id")).drop("_id")
    return rows.groupBy("task").applyInArrow(join, f"a {id_type}, b {id_type}")


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of links(a, b): one root for each connected component (not its smallest node).

    Each round maps every node to the neighbour (or itself) of the least hash and contracts the links; a component shrinks by
    a share each round, so rounds grow with the logarithm of its size. No link or node goes to the driver, only counts.
    """
    ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    edges = saved(links.where("a <> b").distinct(), "jaccard-edges")
    nodes = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = saved(both.groupBy("a").agg(F.least(F.min(ranked("b")), F.first(ranked("a"))).getField("v").alias("to")), "jaccard-step")
        if nodes is None:
            nodes = step.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            nodes = saved(nodes.join(step, nodes.root == step.a, "left").select("node", F.coalesce("to", "root").alias("root")), "jaccard-nodes")
        left, right = step.select("a", F.col("to").alias("ta")), step.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        edges = saved(edges.join(left, "a").join(right, "b").where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "jaccard-edges")
        if edges.isEmpty():
            return nodes


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: the smallest doc_id that it reaches by links, itself included.

    Words are runs of [^\\x20\\x09-\\x0D], A-Z lower-cased; a set holds the distinct 5-word shingles of the whole text (the
    whole sequence if shorter). Two documents link when 100 * intersection >= 80 * union. Null texts and texts without
    words have no shingle and no link. Documents with equal sets are one from the start (by 128-bit keys), so groups of copies
    cost one; links between different sets are all found (see index_keys). Rows that share a doc_id are one document. A
    row with a null doc_id is a document of its own, whose links count as any others; its component is the smallest doc_id
    that is reached, null if none is. An empty table gives an empty table.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    sets = saved(_sets(docs, id_type), "jaccard-keys")
    if not sets.where("doc_id is null and n > 0").isEmpty():
        return _by_row(docs)
    reps = saved(sets.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "jaccard-reps")
    n_reps, tokens = reps.agg(F.count("rep"), F.sum("n")).first()
    if not n_reps:
        return sets.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    bits = int(np.clip(int(n_reps * 16).bit_length(), 3, MOST_DOC_BITS))
    wanted = _document_map(reps.where("rep is not null").select(F.col("rep").alias("doc_id")), bits)
    postings = _postings(docs, wanted, bits, id_type, _class_maps(docs, wanted, bits, int(tokens)))
    found = saved(_bucket_rows(postings.where("id is not null"), id_type), "jaccard-buckets")
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    # links of small buckets and of leaders
    links = saved(_verified(saved(found.where("not big").select(*pair("a", "b")).distinct(), "jaccard-pairs"), docs, id_type), "jaccard-links")
    # large buckets whose members are not all joined yet
    big = found.where("big").select("key", F.col("a").alias("id"), "n")
    roots = components(links)
    labelled = big.join(roots, big.id == roots.node, "left").select("key", "id", "n", F.coalesce("root", "id").alias("root"))
    labelled = saved(labelled, "jaccard-large")
    apart = saved(labelled.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("key"), "jaccard-apart")
    open_rows = saved(labelled.join(apart, "key", "left_semi"), "jaccard-open")
    links = links.unionByName(saved(_dense_links(open_rows, docs, id_type), "jaccard-more"))
    # documents of links join the one that stands for their set; labels go back to sets by their keys
    nodes = links.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    stands = sets.where("n > 0").join(nodes, "doc_id", "left_semi").join(reps.drop("n"), ["k1", "k2"])
    links = links.unionByName(stands.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b"))
    roots = components(saved(links, "jaccard-all"))
    in_links = reps.join(roots, reps.rep == roots.node).select("k1", "k2", "rep", "root")
    least = in_links.groupBy("root").agg(F.min("rep").alias("least"))
    labels = saved(in_links.join(least, "root").select("k1", "k2", "least").unionByName(reps.join(in_links, ["k1", "k2"], "left_anti").select("k1", "k2", F.col("rep").alias("least"))), "jaccard-labels")
    # a key may be that of a third of all documents; both sides are plain, so Spark splits it
    out = sets.join(labels, ["k1", "k2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("least", "doc_id")).alias("component_id"))




def _by_row(docs: DataFrame) -> DataFrame:
    """near_duplicates with a number for each row in place of doc_id, as null ids tell no documents apart."""
    rows = saved(docs.withColumn("row", F.monotonically_increasing_id()), "jaccard-rows")
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).withColumnRenamed("doc_id", "row")
    found = saved(found.join(rows.select("row", "doc_id"), "row"), "jaccard-by-row")
    # rows that share a doc_id are one document
    shared = found.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("a"), F.max("component_id").alias("b")).where("a <> b")
    joined = found.join(shared.select("doc_id", "a"), "doc_id").select("a", F.col("component_id").alias("b"))
    roots = components(saved(joined.where("a <> b"), "jaccard-shared"))
    found = found.join(roots, F.col("component_id") == F.col("node"), "left").withColumn("component_id", F.coalesce("root", "component_id")).drop("node", "root")
    least = found.groupBy("component_id").agg(F.min("doc_id").alias("least"))
    return found.join(least, "component_id").select("doc_id", "n_shingles", F.col("least").alias("component_id"))
