"""Near-duplicate vectors, the Merkle manifest and conversation repair against plain versions."""

from __future__ import annotations

import random
import re
from hashlib import sha256
from itertools import product
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import frame
from tidemark.llm import conversations, merkle, neighbours

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_links(rows, least=0.93):
    """n_links and component_id of each row, all pairs compared."""

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        v = v / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    units = [unit(r[1]) if r[2] is not None else None for r in rows]
    near = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least] for i in range(len(rows))]
    part = list(range(len(rows)))
    for _ in rows:
        new = [min(part[j] for j in [i, *near[i]]) for i in range(len(rows))]
        if new == part:
            break
        part = new
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if part[j] == part[i] and rows[j][0] is not None]
        least_id = min(ids, default=None)
        out.append((r[0], len(near[i]), least_id, r[0] == least_id))
    return out


def by_text(rows):
    return sorted(map(repr, map(tuple, rows)))


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.standard_normal(24)
            for _ in range(rng.integers(1, 7)):
                rows.append((len(rows), (centre + rng.standard_normal(24) * rng.choice([0.01, 0.2, 0.28])).tolist(), label))
    rows += [(900 + i, rows[0][1], 0) for i in range(40)]  # copies
    rows += [(940, (np.array(rows[0][1]) * 1e-30).tolist(), 0), (941, (np.array(rows[0][1]) * 1e30).tolist(), 0), (5, rows[0][1], 0), (None, rows[0][1], 0), (None, [1.0] * 24, 7)]
    rows += [(960, None, 0), (961, [], 0), (962, [0.0] * 24, 0), (963, [1.0] * 23 + [None], 0), (964, [float("nan")] * 24, 0), (965, [float("inf")] + [1.0] * 23, 0), (966, [1.0, 2.0], 0), (967, [1.0, 2.0], 0)]
    table = spark.createDataFrame(rows, VECTORS).withColumn("n_links", F.lit("clash")).withColumn("root", F.lit(1)).repartition(3)
    got = neighbours.near_vectors(table)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = plain_links(rows)
    assert any(n > 40 for _, n, *_ in want) and any(0 < n < 5 for _, n, *_ in want)
    assert by_text(got.collect()) == by_text(want)
    assert neighbours.near_vectors(table.limit(0)).count() == 0


def test_near_vectors_over_blocks(spark, monkeypatch):
    """One label over many blocks and tiles; one group that spans them."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + rng.standard_normal(32) * 0.2).tolist() if i % 3 == 0 else rng.standard_normal(32).tolist(), i % 2 and 4) for i in range(600)]
    assert by_text(neighbours.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()) == by_text(plain_links(rows))


def test_collision_counts_and_recall():
    rng = np.random.default_rng(7)
    left, right = rng.standard_normal((30, 9)), rng.standard_normal((40, 9))
    assert (neighbours.collisions(left, right, 0.7) == (np.abs(left[:, None] - right[None]) <= 0.7).sum(2)).all()
    # pairs just at the threshold, the hardest that link, in a dimension of their own
    x = neighbours.unit_vectors(rng.standard_normal((20_000, 48)))
    y = rng.standard_normal((20_000, 48))
    y = neighbours.unit_vectors(y - (x * y).sum(1, keepdims=True) * x)
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * y
    assert np.allclose((x * y).sum(1), 0.93)
    apart = np.abs((x - y) @ neighbours.directions(48)[neighbours.LEADING :].T) <= neighbours.WINDOW * neighbours.deviation()
    assert (apart.sum(1) >= neighbours.pass_count()).mean() >= 0.999


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda doc_id, text, lang, source, n_chars: digest(*map(field, (doc_id, source, lang, n_chars, text)))

    def tree(nodes):
        at, proofs = list(range(len(nodes))), [[] for _ in nodes]
        while len(nodes) > 1:
            for i, place in enumerate(at):
                run = nodes[place - place % 2 : place - place % 2 + 2]
                proofs[i].append(("".join(run[: place % 2]), "".join(run[place % 2 + 1 :])))
            nodes, at = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], [p // 2 for p in at]
        return nodes[0], proofs

    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    own = {k: sorted(langs[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for k in order}
    trees = {k: tree([leaf(*r) for r in own[k]]) for k in order}
    root, upper = tree([trees[k][0] for k in order])
    out = []
    for k, above in zip(order, upper, strict=True):
        for r, proof in zip(own[k], trees[k][1], strict=True):
            changed = r[4] is not None and r[0] is not None and crc32(str(r[0]).encode()) % 7 == 0
            folded = leaf(*r[:4], r[4] + 1) if changed else leaf(*r)
            for left, right in proof + above:
                folded = digest(left, folded, right)
            out.append((r[0], leaf(*r), trees[k][0], root, digest(*(a + b for a, b in proof + above)), folded, folded == root))
    return out


def test_manifest(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LOCAL_LEVELS", 2)
    for n in (1, 2, 5, 23, 47):
        rows = [(i, "é" * (i % 5), ("en", "de", "ä", None)[0 if i % 3 else i % 4], f"s{i % 4}" if i % 6 else None, i if i % 5 else None) for i in range(n)]
        rows += rows[:2] * (n > 10) + [(None, None, None, None, None), (None, "x", "en", "", 9), (3, "", "en", "s", 0)][: n // 2]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("tree", F.lit(1)).withColumn("root", F.lit("clash")).repartition(3)
        got = merkle.manifest(docs)
        assert by_text(got.collect()) == by_text(plain_manifest(rows)), n
    assert merkle.manifest(docs.limit(0)).count() == 0
    long_text = "word " * 200_000
    one = merkle.manifest(frame(spark, [(1, long_text, "en", "a")])).collect()
    assert one[0].leaf == one[0].root == plain_manifest([(1, long_text, "en", "a", len(long_text))])[0][1]


def test_height_and_fold():
    for n, fanout in product((1, 2, 3, 9, 10, 81), (2, 3, 4)):
        nodes = [digest(str(i)) for i in range(n)]
        rows, top = merkle.lift(nodes, merkle.height(n, fanout), fanout)
        assert len(top) == 1 and all(merkle.fold(nodes[i], merkle.siblings(rows, i, fanout)) == top[0] for i in range(n))


WORD = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"0": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(initials, must_go, truncated):
    """Cost and audit by every path, each with its complete letters."""
    paths = {"0": (0, "")}

    def offer(found, state, path):
        if state not in found or path < found[state]:
            found[state] = path

    def inserts(found):
        for _ in range(4):
            for state, (cost, letters) in list(found.items()):
                for to in NEXT[state]:
                    if to != "s":
                        offer(found, to, (cost + 3, letters + "I"))
        return found

    paths = inserts(paths)
    for initial, gone, cut in zip(initials, must_go, truncated, strict=True):
        found = {}
        for state, (cost, letters) in paths.items():
            offer(found, state, (cost + 4, letters + "D"))
            for to in () if gone else NEXT[state]:
                if to == initial:
                    offer(found, to, (cost + 3 * cut, letters + "K"))
                if to != "s":
                    offer(found, to, (cost + 3 * cut + 3, letters + "R"))
        paths = inserts(found)
    return min(paths[s] for s in ("0", "a") if s in paths)


def plain_repair(rows):
    space = lambda v: " " if v is None else v
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        kind = crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, own in convs.items():
        turns = sorted({t for t, *_ in own if t is not None})
        # rows of one turn: only their fault counts and costs are compared, so that any order that the operator states will do
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, faults = set(), []
        for _, role, text in own:
            faults.append("b" if not WORD.search(text) else "d" if (role, text) in seen else "t" if WORD.findall(text)[-1] not in ".!?" else " ")
            seen.add((role, text))
        initials = [r[1][:1] for r in own]
        cost, audit = cheapest(initials, [f in "bd" for f in faults], [f == "t" for f in faults])
        lines, state, at = [], "0", 0
        for edit in audit:
            turn = {"u": "assistant"}.get(state, "user")
            if edit == "I":
                lines.append((turn, ""))
            else:
                if edit != "D":
                    lines.append((own[at][1] if edit == "K" else turn, own[at][2]))
                at += 1
            state = lines[-1][0][:1] if lines else "0"
        text = "\n".join(f"{r}:{t}" for r, t in lines)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
        gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        yield conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha256(text.encode()).hexdigest()


def test_conversations(spark):
    rnd = random.Random(4)
    texts = ["a.", "b", "", None, "c!", "d? ", "e\n", "f .\t", "g h", "...", "é?"]
    rows = []
    for conv in [*range(150), None]:
        turns = [*range(rnd.randrange(14)), *([None] if rnd.random() < 0.2 else [])]
        rows += [(conv, t + (t > 4) if t is not None else None, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rnd.choice(texts) if rnd.random() < 0.6 else f"t{rnd.random()}.") for t in turns]
    rows += [(700, t, "user", "again.") for t in range(60)] + [(701, t, "tool", f"{t}.") for t in range(200)] + [(702, 1, "user", "x" * 300_000)]
    schema = "conv_id long, turn long, role string, text string"
    table = spark.createDataFrame(rows, schema).withColumn("audit", F.lit("clash")).withColumn("copies", F.lit(3)).repartition(4)
    got = conversations.repair_conversations(table)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert by_text(got.select(*names).collect()) == by_text(plain_repair(rows))
    assert conversations.repair_conversations(table.limit(0)).count() == 0
    # repeated rows of one turn are duplicates, however many
    many = spark.createDataFrame([(1, 2, "user", "hi."), (1, 3, "assistant", "yes.")] + [(1, 2, "user", "hi.")] * 500, schema)
    assert [tuple(r) for r in conversations.repair_conversations(many).select(*names).collect()] == list(plain_repair([(1, 2, "user", "hi.")] * 501 + [(1, 3, "assistant", "yes.")]))


def test_survivors_coalesce():
    """What is certain goes out: on plain turns the tree never holds more than a few nodes; where shifts stay open it holds them, and
    the ties of those are compared in full."""
    rnd = random.Random(1)
    for make in (lambda i: "ua"[i % 2], lambda i: "t", lambda i: rnd.choice("uast"), lambda i: rnd.choice("ua")):
        letters, most = [], 0
        repair = conversations.Repair(letters.append)
        initials = [make(i) for i in range(400)]
        gone = [rnd.random() < 0.1 for _ in initials]
        cut = [rnd.random() < 0.3 for _ in initials]
        for row in zip(initials, gone, cut, strict=True):
            repair.row(*row)
            open_ = [repair.root]
            n = 0
            while open_:
                n += 1
                open_ += open_.pop().standing
            most = max(most, n)
        cost = repair.end()
        assert (cost, "".join(letters)) == cheapest(initials, gone, cut)
        if initials[:4] == list("uaua"):
            assert most < 60
