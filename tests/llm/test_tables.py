"""Sharding, mixing, top-k and the pipeline."""

from __future__ import annotations

import math
import os
import random
import tempfile
import uuid
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.helpers import frame, words
from tests.llm.test_texts import brute_components
from tidemark.llm import mixing, quality, sharding, topk
from tidemark.llm.common import key_crc32
from tidemark.llm.queries import tokenizer_file

ROWS = [(1, None, "en", "a"), (2, "", None, None), (3, "ä b", "de", "b"), (4, "x y z", "de", None), (4, "x y z", "de", None), (None, "no id", "en", "a"), *[(10 + i, "w " * (i % 7), "en", f"s{i % 3}") for i in range(200)]]


def test_permutation_is_one():
    for n in (1, 2, 3, 10, 97, 1000):
        assert sorted(sharding.permute(np.arange(n), n, 1).tolist()) == list(range(n))
    assert sharding.permute(np.arange(1000), 1000, 1).tolist() != sharding.permute(np.arange(1000), 1000, 2).tolist()


def test_sharding(spark):
    clash = ("slot", "row", "part", "at", "place", "first", "k0", "_nr_place", "_nr_id", "_shard_row")
    docs = frame(spark, ROWS).withColumns({c: F.lit("clash") for c in clash})
    kept = sharding.shard(docs, ["doc_id", "text", "source"]).first()
    assert all(kept[c] == "clash" for c in clash[1:]) and set(kept.asDict()) == {*docs.columns, "shard"}
    got = sharding.documents_to_shards(docs, 24).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted((i is None, i or 0, len((t or "").encode()) + 8, crc32((t or "").encode())) for i, t, *_ in ROWS)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.documents_to_shards(docs.repartition(7), 24).collect()
    key = lambda rows: sorted((r.doc_id or 0, r.text_crc32, r.shard, r.slot) for r in rows)
    assert key(got) == key(again)
    assert sharding.documents_to_shards(docs.limit(0), 24).count() == 0


def expected_targets(rows):
    size = Counter()
    for _, text, _, source in rows:
        size[source] += len(words(text))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: float(1 + i % 3) for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(size.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] >= 3 * size[s]}
        if not above:
            return size, target | share
        for s in above:
            target[s] = 3.0 * size[s]
            left -= target[s]
        open_ -= above
    return size, target


def test_mixing_spreads_hot_rows(spark, monkeypatch):
    """Equal rows, with and without columns of their own, are dealt over blocks; none is above a few BLOCK_ROWS."""
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 100)
    sizes, fly = [], mixing._flight_of_block
    folder = tempfile.mkdtemp(prefix="tidemark-test-")

    def recorded(*args):
        inner = fly(*args)

        def run(key, pdf):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(pdf)))
            return inner(key, pdf)

        return run

    monkeypatch.setattr(mixing, "_flight_of_block", recorded)
    docs = frame(spark, [(1, "one two three", "en", "a")] * 3000 + [(2, "one two", "en", "b")] * 300)
    for given, keep in ((docs, ()), (docs.withColumn("row", F.monotonically_increasing_id()), ("row",))):
        got = mixing.mix_documents(given, keep=keep)
        assert got.count() == 3300
        for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
            assert abs(r.taken - r.target) <= 3
    sizes = [int(open(f"{folder}/{x}").read()) for x in os.listdir(folder)]
    assert max(sizes) < 200


def test_mixing(spark):
    rows = ROWS + [(500 + i, "w " * 50, "en", "large") for i in range(40)]
    docs = frame(spark, rows).withColumn("taken", F.lit("clash"))
    got = mixing.mix_documents(docs).collect()
    assert len(got) == len(rows)
    size, target = expected_targets(rows)
    for source in size:
        own = [r for r in got if r.source == source]
        assert all(r.source_size == size[source] and math.isclose(r.target, target[source], abs_tol=1e-6) for r in own)
        assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in own)
        assert abs(sum(r.taken for r in own) - target[source]) <= max([1, *(r.size for r in own)])
    again = mixing.mix_documents(docs.repartition(5)).collect()
    key = lambda rows: sorted((r.doc_id or 0, r.size, r.taken) for r in rows)
    assert key(got) == key(again)
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_flight_keeps_both_totals(spark, monkeypatch):
    dice = np.random.default_rng(1)
    size, p = dice.integers(1, 2000, 500).astype(float), np.full(500, 0.37)
    out = mixing.flight(p, size, np.random.default_rng(2))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert math.isclose(out.sum(), p.sum(), rel_tol=1e-6) and math.isclose(out @ size, p @ size, rel_tol=1e-6)
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 100)  # several rounds
    units = spark.createDataFrame([(i, "s", int(s), 0.37) for i, s in enumerate(size)], "doc_id long, source string, size long, p double")
    got = mixing.cube_sample(units).collect()
    assert len(got) == 500 and abs(sum(r["size"] for r in got if r.taken01) - 0.37 * size.sum()) < 20
    assert abs(sum(r.taken01 for r in got) - 185) <= 12


@pytest.mark.parametrize("buckets", [7, 2048])
def test_top_k(spark, monkeypatch, buckets):
    monkeypatch.setattr(topk, "BUCKET_ROWS", buckets)
    dice = random.Random(5)
    rows = [(i, [dice.gauss(0, 1) * (1 + i % 5) for _ in range(4)]) for i in range(300)]
    rows += [(50, rows[50][1]), (301, None), (302, []), (303, [1.0, None, 2.0, 3.0]), (304, [math.nan] * 4), (305, [math.inf] * 4), (100, [1.0, 2.0]), (306, [2.0, 1.0]), (None, [1.0] * 4), (400, [0.0] * 4)]
    got = defaultdict(list)
    for r in topk.top_k(spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string").repartition(4)).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = defaultdict(list)
    for at, (i, q) in enumerate(whole):
        if i % 50 == 0:
            scores = sorted((-sum(map(int.__mul__, q, v)), j, k) for k, (j, v) in enumerate(whole) if k != at and len(v) == len(q))
            want[i] += [(n + 1, j, -s) for n, (s, j, _) in enumerate(scores[:5])]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if v}
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("far", [1e11, 1e17, 1e200])
def test_top_k_of_long_vectors(spark, monkeypatch, far):
    """Products beyond 2^53 and beyond a long are compared as whole numbers; a score beyond a long is the nearest long."""
    monkeypatch.setattr(topk, "BUCKET_ROWS", 16)
    dice = random.Random(6)
    rows = [(i, [dice.uniform(-1, 1) * (far if i % 3 else 1.0) for _ in range(3)]) for i in range(120)] + [(120, [1e307, 1.0, 1.0]), (150, [0.0, 0.0, 0.0])]
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect())
    whole = {i: [math.floor(256 * x) if abs(x) < 2**60 else int(256 * x) for x in v] for i, v in rows if i != 120}
    want = []
    for i in (0, 50, 100, 150):
        scores = sorted((-sum(map(int.__mul__, whole[i], v)), j) for j, v in whole.items() if j != i)[:5]
        want += [(i, n + 1, j, max(-(1 << 63), min((1 << 63) - 1, -s))) for n, (s, j) in enumerate(scores)]
    assert got == want


def test_pipeline_stages(spark):
    """Each stage on what the one before kept: decisions take effect, columns stay, copies leave one."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, n = docs.columns, docs.count()
    frames = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL).cache()
        frames.append(docs.toPandas())
        assert k == 4 or docs.columns == names
    kept, lined, unique, mixed, packed = frames
    assert 0.6 * n < len(kept) <= n and len(lined) <= len(kept) and len(unique) < len(lined)
    assert unique.doc_id.is_unique and set(unique.doc_id) <= set(lined.doc_id) and set(mixed.doc_id) <= set(unique.doc_id)
    assert mixed.groupby("doc_id").size().max() <= 3
    assert set(packed.doc_id) == set(mixed.doc_id) and packed.groupby("sequence_id").length.sum().max() <= 4096
    assert len(packed[packed.piece == 0]) == len(mixed)


def test_pipeline_keeps_different_rows_of_null_and_shared_ids(spark):
    """A null or shared doc_id joins nothing: one row of each linked group stays, and the mix takes each row by itself."""
    dice = random.Random(7)
    text = lambda: " ".join(f"w{dice.randrange(10_000)}" for _ in range(60))
    own = [text() for _ in range(6)]
    near = own[0] + " tail"
    rows = [(None, own[0], "en", "a"), (None, own[0], "en", "a"), (None, near, "en", "a"), (None, own[1], "en", "a"), (None, own[2], "en", "b"), (7, own[3], "en", "b"), (7, own[4], "en", "b"), (8, own[5], "en", "b"), (9, own[5], "en", "b"), (None, own[5], "en", "b"), (None, "", "en", "b"), (None, None, "en", "b")]
    docs = frame(spark, rows)
    got = corpus_pipeline.near_duplicate_stage(spark, docs, SMALL)
    kept = sorted((r.doc_id or 0, r.text or "") for r in got.collect())
    first = [t for i, t in kept if t in (own[0], near)]
    assert len(first) == 1 and kept == sorted([(0, first[0]), (0, own[1]), (0, own[2]), (7, own[3]), (7, own[4]), (8, own[5]), (0, ""), (0, "")])
    again = corpus_pipeline.near_duplicate_stage(spark, docs.repartition(5), SMALL)
    assert sorted((r.doc_id or 0, r.text or "") for r in again.collect()) == kept
    mixed = Counter((r.doc_id, r.text) for r in corpus_pipeline.mixing_stage(spark, got, SMALL).where("text <> ''").collect())
    assert len(mixed) >= 4 and max(mixed.values()) <= 3


def plain_lines(rows, least=5):
    """(doc_id, text, source) without the lines on `least` sources or more, but for their first place."""
    places, sites = {}, {}
    for i, text, source in rows:
        for pos, raw in enumerate((text or "").split("\n")):
            if line := raw.strip(" \t\r\x0b\x0c"):
                places[line] = min(places.get(line, (i, pos)), (i, pos))
                sites.setdefault(line, set()).add(source)
    out = []
    for i, text, source in rows:
        lines = (text or "").split("\n")
        gone = {pos for pos, raw in enumerate(lines) if len(sites.get(line := raw.strip(" \t\r\x0b\x0c"), ())) >= least and places[line] != (i, pos)}
        left = [x for pos, x in enumerate(lines) if pos not in gone]
        if not gone or any(words(x) for x in left):
            out.append((i, "\n".join(left) if gone else text, source))
    return out


def test_pipeline_against_plain_python(spark):
    """Each stage against a plain version on the stage's own input: all 200 documents, with clashing columns beside."""
    clash = {c: F.lit(c) for c in ("_quality", "score", "_stays", "_id", "_times", "_time", "_row", "row", "doc", "_gone", "_d", "lines_removed", "time")}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumns(clash)
    names = docs.columns
    read = lambda df: sorted((r.doc_id, r.text, r.source) for r in df.collect())
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frames.append(stage(spark, frames[-1], SMALL).cache())
        assert k == 4 or (frames[-1].columns == names and all(r[c] == c for r in frames[-1].limit(5).collect() for c in clash))
    rows = [read(f) for f in frames[:5]]
    model = quality.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), key_crc32("doc_id") % 4 != 2)

    def score(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return float(model.score(quality.text_features(data, np.array([0, len(data)])))[0])

    assert rows[1] == [r for r in rows[0] if score(r[1]) >= 0.7]
    assert rows[2] == sorted(plain_lines(rows[1]))
    component = brute_components([r[:2] for r in rows[2]])
    assert rows[3] == [r for r in rows[2] if component[r[0]][1] == r[0]]
    copies = Counter()
    for _, text, source in rows[4]:
        copies[source] += len(words(text))
    _, target = expected_targets([(i, t, None, s) for i, t, s in rows[3]])
    longest = max(len(words(t)) for _, t, _ in rows[3])
    assert all(abs(copies[s] - target[s]) <= longest for s in target) and set(rows[4]) <= set(rows[3]) and max(Counter(rows[4]).values()) <= 3
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = Counter()
    for i, text, _ in rows[4]:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((i, k, crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096)))
    packed = frames[5].collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed) == want
    fills = Counter()
    for r in packed:
        fills[r.sequence_id] += r.length
    assert max(fills.values()) <= 4096 and len(fills) <= -(-sum(fills.values()) // 4096) * 1.02 + 1


def test_pipeline_without_labels_keeps_all_documents(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = corpus_pipeline.quality_stage(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and got.count() == docs.count() > 0
