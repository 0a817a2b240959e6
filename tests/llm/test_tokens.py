"""Tokens, token files and packing: equal to the library, exact round trips, full use of sequences."""

from __future__ import annotations

import random
import unicodedata
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import frame
from tidemark.llm import packing, rans, tokens
from tidemark.llm.queries import tokenizer_file

ODD = [
    "", None, " ", "\n", "hello world's it's\nnew line", "  two  spaces", "\n\nlead", "tab\tin\t word", "end ", " start", "a\n\nb", "a \n b", "x\r\ny", "ÀÉ Σας ΣΑΣ ﬁ İx", "<|endoftext|> <|ENDOFTEXT|>", "é é ́x", "1234 abc123 %%%***",
    "don't DON'T 'll", "　x y", "word... (word) word'", "’t is", "…a b…", "a <|endoftext|> b", "a<|startoftext|>b\n<|endoftext|>", "a \x01 b\x01c \x01", "\n\x01\n", "\x1c x\x1c",
]


def library(name):
    t = Tokenizer.from_file(tokenizer_file(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_cached_words_give_the_librarys_ids(name, kind, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 300)
    dice = random.Random(1)
    texts = ODD + ["".join(dice.choice(["a", "b", " ", "1", "'", ".", "\n", "\t", "é", " ", "Σ", "%", "\x01", "<|endoftext|>"]) for _ in range(dice.randint(0, 30))) for _ in range(2000)]
    own, want = tokens.WordTokenizer(tokenizer_file(name), kind), library(name)
    assert [x.tolist() for x in own.encode(pa.array(texts))] == [want(t) for t in texts]


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_every_code_point_gives_the_librarys_ids(name, kind):
    """All assigned code points between letters, beside punctuation and beside spaces."""
    want = Tokenizer.from_file(tokenizer_file(name))
    own = tokens.WordTokenizer(tokenizer_file(name), kind)
    points = [chr(c) for c in range(1, 0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs")]
    for i in range(0, len(points), 20_000):
        texts = [f"a{c}, {c}. x{c}y -{c}{c}" for c in points[i : i + 20_000]]
        found = [x.ids for x in want.encode_batch_fast(texts, add_special_tokens=False)]
        assert all(x.tolist() == y for x, y in zip(own.encode(pa.array(texts)), found, strict=True))


def test_coder_round_trip():
    dice = np.random.default_rng(0)
    ids = np.minimum(dice.zipf(1.3, 300_000), 50_000).astype(np.uint32)
    coder = rans.Coder(rans.frequency_table(np.bincount(ids, minlength=50257)))
    for n in (0, 1, rans.LANES - 1, rans.LANES, rans.LANES + 1, len(ids)):
        payload, marks = coder.encode(ids[:n])
        steps = -(-n // rans.LANES)
        got = coder.decode(payload, marks[0], 0, steps, n) if n else ids[:0]
        assert (got == ids[:n]).all()
    assert len(payload) * 4 < 2 * len(ids)  # under 16 bits an id
    for k, mark in enumerate(marks):  # every checkpoint starts a part of its own
        first = k * rans.CHECKPOINT_STEPS
        part = coder.decode(payload, mark, first, min(steps, first + rans.CHECKPOINT_STEPS), n)
        assert (part == ids[first * rans.LANES :][: len(part)]).all()


@pytest.mark.parametrize(("lanes", "steps", "block"), [(rans.LANES, rans.CHECKPOINT_STEPS, rans.BLOCK_TOKENS), (8, 4, 100)])
def test_token_files(spark, monkeypatch, lanes, steps, block):
    """With small parts nearly all documents lie over several, and blocks hold a few documents."""
    for name, value in (("LANES", lanes), ("CHECKPOINT_STEPS", steps), ("BLOCK_TOKENS", block)):
        monkeypatch.setattr(rans, name, value)
    dice = random.Random(2)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, "x " * (40_000 if lanes > 8 else 500)), (7, "again"), (7, "again"), (None, "no id")] + [(200 + i, " ".join(dice.choice(["one", "two", "zwölf"]) for _ in range(500))) for i in range(50 if lanes > 8 else 5)]
    docs = frame(spark, rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as n_tokens")
    blocks, table = rans.write_tokens(docs, tokenizer_file("byte_bpe_50k.json"), 2, 50257)
    assert blocks.where(f"n_tokens > {lanes * steps}").count() == 0
    got = sorted((tuple(r) for r in rans.read_tokens(blocks, table, 50257, "bigint").collect()), key=lambda r: r[1])
    want = library("byte_bpe_50k.json")
    at = 0
    for doc_id, start, n, crc, ids in got:
        assert start == at and n * 4 == len(ids) and crc == crc32(ids)
        at += n
    assert sorted((r[0] is not None, r[0] or 0, r[4].hex()) for r in got) == sorted((i is not None, i or 0, np.array([*want(t), 2], "<u4").tobytes().hex()) for i, t in rows)
    keys = [r[0] for r in got]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    broken = next(r for r in blocks.collect() if r.payload).asDict()
    broken["payload"] = bytes([broken["payload"][0] ^ 1]) + bytes(broken["payload"][1:])
    with pytest.raises(ValueError, match="checksum"):
        rans.decode_part(None, broken)
    assert rans.token_digest(docs.limit(0), tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ITEMS", 40)  # several blocks and rounds
    dice = random.Random(3)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, "word " * 9000), (7, "again"), (7, "again")] + [(200 + i, "word " * dice.randint(0, 3000)) for i in range(300)]
    docs = frame(spark, rows, "doc_id long, text string").selectExpr("*", "1 as piece", "'x' as sequence_id")
    got = packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json")).collect()
    want = []
    for i, text in rows:
        ids = np.array([*library("word_bpe_49k.json")(text), 1], "<u4")
        want += [(i, k, a, len(ids[a : a + 4096]), crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins: dict = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= 1.05 * sum(r.length for r in got) / 4096 + 2
    assert packing.pack_documents(docs.limit(0), tokenizer_file("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("short", [0, 3, 200])
def test_packing_has_no_last_single_group(spark, monkeypatch, short):
    """Bins over half full fit no other: they are final where they are, and no task takes all of them."""
    monkeypatch.setattr(packing, "BLOCK_ITEMS", 40)
    dice = random.Random(5)
    sizes = [dice.randint(2049, 4000) for _ in range(400)] + [dice.randint(50, 600) for _ in range(short)]
    items = spark.createDataFrame(list(enumerate(sizes)), "id long, length long").selectExpr("*", "xxhash64(id) as _pack_block")
    got = packing.pack(items).collect()
    assert sorted((r.id, r.length) for r in got) == list(enumerate(sizes))
    bins: dict = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    fills = sorted(sum(n for _, n in parts) for parts in bins.values())
    assert fills[-1] <= 4096 and fills[0] + fills[1] > 4096 - packing.FREE_TOKENS
    assert all(offset == sum(n for o, n in parts if o < offset) for parts in bins.values() for offset, _ in parts)
    blocks: dict = {}
    for b in bins:
        blocks[b >> 32] = blocks.get(b >> 32, 0) + 1
    assert max(blocks.values()) <= 100


def test_best_fit_is_tight():
    at, offset = packing.best_fit(np.array([6, 5, 5, 4, 10, 3, 7]), 10)
    assert at.max() + 1 == 4
    for b in range(4):
        own = np.flatnonzero(at == b)
        assert sorted(offset[own].tolist())[0] == 0
