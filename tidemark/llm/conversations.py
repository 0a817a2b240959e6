"""Repair of conversation structure: the cheapest edits by a Viterbi search whose survivors emit what they agree on."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

#: What an edit costs, and what a truncated row adds if it stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
#: Roles by their initials follow (s?(ua)+)?: from each state (0 nothing yet, then the last initial) what may come, and where it leads.
_NEXT = {"0": "su", "s": "u", "u": "a", "a": "u"}
_ENDS = ("0", "a")
_LEGAL_PAIRS = ("su", "ua", "au")
_WORD, _BLANKS = r"[^\x20\x09-\x0D]", " \t\n\x0b\x0c\r"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# ---- damage -----------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows after the damage, equal ones as one row with their number.

    A null role or text counts as one space, as do null ids in the key, `conv_id:turn`. Its crc32 mod 20 drops the row (0), empties
    its text (1), removes `.`, `!` and `?` (2), repeats it (3) or makes its role user (4).
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("_kind")).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("_kind") == 3, 2).otherwise(1).alias("_n"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("_n").alias("copies"))


def _faults(rows: DataFrame) -> DataFrame:
    """The rows without their texts, with `blank`, `truncated` and `again` (an equal role and text came in an earlier turn)."""
    blank = ~F.col("text").rlike(_WORD)
    last = F.substring(F.rtrim(F.col("text"), F.lit(_BLANKS)), -1, 1)
    flagged = rows.select("conv_id", "turn", "role", "h1", "h2", "copies", blank.alias("blank"), (~blank & ~last.isin(".", "!", "?")).alias("truncated"))
    # the earliest turn of each role and text is an aggregate, so no task sorts the rows that are equal
    turn = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    keys = ("conv_id", "role", "h1", "h2")
    first = flagged.groupBy(*keys).agg(F.min(turn).alias("_first")).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = flagged.join(first, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
    return same.select(*flagged.columns, (~turn.eqNullSafe(F.col("_first"))).alias("again"))


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    """Conversations one after the other, each whole in one task, its rows by turn (null first), then role and text."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", *before, "turn", "role", "h1", "h2")


# ---- search -----------------------------------------------------------------------------------------------------------


class Node:
    """An edited row in the tree of survivors: its letters (inserts before it, then its own), the node before it, those on it."""

    __slots__ = ("before", "letters", "rank", "standing")

    def __init__(self, before: Node | None, letters: str):
        self.before, self.letters, self.rank, self.standing = before, letters, 0, set()
        if before is not None:
            before.standing.add(self)


class Repair:
    """The cheapest edits of one conversation, row by row; `emit` gets the letters of edits as soon as they are certain.

    For each state there is one survivor: the cheapest edits that lead there, of equally cheap ones those whose letters come first.
    Survivors are leaves of a tree of backpointers. A node on which nothing stands any more goes, and so on down; when a single node
    stands on the root, all survivors share it: its letters go out and it becomes the root. So the tree holds only
    what is unresolved, and each row costs the same, however long that is.

    Ties compare the complete unresolved letters. No survivor's letters begin with another's (up to the letter of the same row), so
    the order of two paths is that of the nodes they come from, or if these are one, of what follows: ranks of the four
    survivors carry the comparison along. The letters determine the repaired roles.
    """

    def __init__(self, emit: Callable[[str], None]):
        self.emit, self.root = emit, Node(None, "")
        self.leaves: set[Node] = {self.root}
        #: state: cost, node of the last row, inserts after it
        self.alive = self._with_inserts({"0": (0, self.root, "")})

    @staticmethod
    def _with_inserts(found: dict) -> dict:
        """What two inserts at most add (a third leads back to a state), without what can't win any more.

        After an assistant all goes on as from nothing or after a system row, but that a later system row has to be deleted.
        """
        for _ in range(2):
            for state, (cost, node, letters) in list(found.items()):
                for to in _NEXT[state]:
                    if to != "s":
                        _offer(found, to, (cost + INSERT, node, letters + "I"))
        return {state: path for state, path in found.items() if path[0] <= found["a"][0] + {"0": DELETE, "s": 0}.get(state, INSERT)}

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        """Takes the next row: its role's initial, whether it has to be deleted, and whether its text is cut off."""
        found: dict = {}
        more = TRUNCATED if truncated else 0
        for state, (cost, node, letters) in self.alive.items():
            _offer(found, state, (cost + DELETE, node, letters + "D"))
            if not must_go:
                for to in _NEXT[state]:
                    if to == initial:
                        _offer(found, to, (cost + more, node, letters + "K"))
                    if to != "s":
                        _offer(found, to, (cost + REROLE + more, node, letters + "R"))
        made = {}
        for rank, (state, (cost, node, letters)) in enumerate(sorted(found.items(), key=lambda x: (x[1][1].rank, x[1][2]))):
            made[state] = (cost, Node(node, letters), "")
            made[state][1].rank = rank
        self.alive = self._with_inserts(dict(made))
        old, self.leaves = self.leaves, {x[1] for x in self.alive.values()}
        for node in {*old, *(x[1] for x in made.values())} - self.leaves:
            while not node.standing and node is not self.root and node not in self.leaves:
                node.before.standing.discard(node)
                node = node.before
        while len(self.root.standing) == 1 and self.root not in self.leaves:
            (self.root,) = self.root.standing
            self.root.before = None
            self.emit(self.root.letters)

    def end(self) -> int:
        """Emits the rest; returns the cost. There always is a way: all rows deleted, or inserts after the last."""
        cost, node, letters = min((self.alive[s] for s in _ENDS if s in self.alive), key=_order)
        rest = [letters]
        while node is not self.root:
            rest.append(node.letters)
            node = node.before
        self.emit("".join(reversed(rest)))
        return cost


def _order(path: tuple[int, Node, str]) -> tuple:
    return path[0], path[1].rank, path[2]


def _offer(found: dict, state: str, path: tuple[int, Node, str]) -> None:
    if state not in found or _order(path) < _order(found[state]):
        found[state] = path


class _Audit:
    """The counts of one conversation while its rows pass."""

    def __init__(self):
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.letters: list[str] = []
        self.repair = Repair(self.letters.append)
        self.low = self.high = self.last_turn = self.before = None
        self.turns = 0

    def rows(self, turn, role: str, copies: int, blank: bool, truncated: bool, again: bool) -> None:
        own, initial = self.counts, role[:1]
        own["illegal"] += copies - 1 + (self.before is not None and self.before + initial not in _LEGAL_PAIRS)
        self.before = initial
        if turn is not None and turn != self.last_turn:
            self.low, self.high, self.last_turn = turn if self.low is None else self.low, turn, turn
            self.turns += 1
        bad = blank or again
        own["blank"] += copies * blank
        own["duplicate"] += 0 if blank else copies - (not again)
        own["truncated"] += truncated and not bad
        for k in range(copies):
            self.repair.row(initial, bad or k > 0, truncated)

    def done(self) -> dict:
        self.counts["cost"] = self.repair.end()
        self.counts["gaps"] = self.high - self.low + 1 - self.turns if self.turns else 0
        return {**self.counts, "audit": "".join(self.letters)}


def _audits(rows: DataFrame) -> DataFrame:
    """conv_id, the counts and audit of each conversation that has rows."""

    def run(batches):
        own, now = None, None
        for batch in batches:
            out: list[tuple] = []
            for conv, turn, role, copies, blank, truncated, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is None or conv != now:
                    if own is not None:
                        out.append((now, own.done()))
                    own, now = _Audit(), conv
                own.rows(turn, role, copies, blank, truncated, again)
            if out:
                yield table(out, batch.column(0).type)
        if own is not None:
            yield table([(now, own.done())], batch.column(0).type)

    def table(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        counts = [pa.array([x[1][c] for x in out], pa.int64()) for c in _COUNTS]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], kind), *counts, pa.array([x[1]["audit"] for x in out])], names=["conv_id", *_COUNTS, "audit"])

    conv = rows.schema["conv_id"].dataType.simpleString()
    light = _in_order(_faults(rows)).select("conv_id", "turn", "role", "copies", "blank", "truncated", "again")
    return light.mapInArrow(run, f"conv_id {conv}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string")


class _Replay:
    """Applies an audit to the rows as they pass; the repaired conversation is digested, not held."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sum, self.empty = audit, 0, "0", sha256(), True

    def _say(self, role: str, text: str) -> None:
        self.sum.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.state, self.empty = role[:1], False

    def _turn(self) -> str:
        return ROLES["a" if self.state == "u" else "u"]

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._say(self._turn(), "")
            self.at += 1

    def rows(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                self._say(role if edit == "K" else self._turn(), text)

    def done(self) -> str:
        self.inserts()
        return self.sum.hexdigest()


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation, after the damage.

    Rows of a conversation are taken by turn, null first; rows of one turn by role, then by a hash of the text (equal rows are next to
    each other). Each row has its first fault of: blank, duplicate (role and text occurred earlier), truncated (the last
    character that isn't blank is none of `.!?`). gaps counts the turns that are missing between the least and the greatest,
    illegal the neighbours whose initials aren't su, ua or au. cost and audit are of the cheapest edits after which the
    initials follow (s?(ua)+)?, the audit that comes first among equals: K keeps a row, R gives it the role user or assistant,
    D deletes it (blank and duplicate rows always go), I inserts an empty text; a role that is neither system, user nor assistant
    counts by its initial alone, an empty role has none. A null conv_id is a conversation of its own; one that has no rows left has zeros,
    an empty audit and the digest of the empty string. An empty table gives an empty table; other columns don't matter.

    Steps: (1) equal rows become one with a number, so repeated rows move once; (2) duplicates come from an aggregate; (3) rows
    without texts pass the search in order, one conversation after the other, of which only the unresolved edits are held;
    (4) texts pass once more beside the audit and go into the digest. A conversation is a sequence that ends in one digest, so one
    task takes its rows, however many, as a stream that Spark sorts and spills; its memory is the audit, a byte a row.
    """
    narrow = conversations.select("conv_id", "turn", "role", "text")
    rows = damaged(narrow).withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    rows = saved(rows, "conversation-rows")
    audits = saved(_audits(rows), "conversation-audits")
    every = narrow.select(F.col("conv_id").alias("_conv")).distinct()
    heads = every.join(audits, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("_conv", "conv_id")
    heads = heads.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.lit(True).alias("head"))
    stream = heads.unionByName(rows.withColumn("head", F.lit(False)), allowMissingColumns=True).withColumn("is_row", F.when(F.col("head"), 0).otherwise(1))
    stream = _in_order(stream, "is_row").select("conv_id", *_COUNTS, "audit", "head", "role", "text", "copies")
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]

    def run(batches):
        head, replay = None, None
        for batch in batches:
            out: list[tuple] = []
            for *own, is_head, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if is_head:
                    if replay is not None:
                        out.append((*head, replay.done()))
                    head, replay = own, _Replay(own[-1])
                else:
                    replay.rows(role, text, copies)
            if out:
                yield table(out, batch.column(0).type)
        if replay is not None:
            yield table([(*head, replay.done())], batch.column(0).type)

    def table(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    conv = conversations.schema["conv_id"].dataType.simpleString()
    return stream.mapInArrow(run, f"conv_id {conv}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string")
