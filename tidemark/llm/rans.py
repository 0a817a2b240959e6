"""Token files: a static range asymmetric numeral system (rANS) in independent interleaved blocks.

Format of a token table (a folder of Parquet files written by Spark, one or more for each range of doc_id):
  A block is a run of whole documents in ascending doc_id order. Token i of a block belongs to lane i mod LANES; all lanes
  share the payload of little-endian 32-bit words and one static frequency table, kept beside the blocks with total
  2^SCALE_BITS. Every CHECKPOINT_STEPS steps there is a checkpoint, and a block's row for each checkpoint (PART_SCHEMA)
  holds all that decoding needs from there to the next one: the lanes' states, the words of the payload between them, the
  doc_ids of the documents that have ids there and how many, the ids that the first has before and the last has after the
  part, and checksums of the words and of the decoded ids. So parts are decoded apart, in any task, and a row is small
  however long a document is; a text is one value of a row, which Spark bounds at 2 GB.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, saved
from tidemark.llm.tokens import release, tokenizer

SCALE_BITS = 22
LANES = 4096
#: Tokens after which a block is closed (at the end of a document).
BLOCK_TOKENS = 1 << 20
CHECKPOINT_STEPS = 64
_LOW = np.uint64(1 << 31)
PART_SCHEMA = (
    "file_no int, block_no long, part int, first long, n_tokens long, doc_ids binary, lengths binary, before long, after long, states binary, payload binary, payload_crc32 long, ids_crc32 long"
)
#: Bytes of a row group, so that tasks can share the parts of a file.
GROUP_BYTES = 4 << 20


def frequency_table(counts: np.ndarray) -> np.ndarray:
    """Integer frequencies with total 2^SCALE_BITS; every token that occurs has at least 1."""
    counts = np.asarray(counts, np.float64)
    total, size = counts.sum(), 1 << SCALE_BITS
    if not total:
        return np.zeros(len(counts), np.int64)
    table = np.where(counts > 0, np.maximum(1, np.floor(counts / total * size)), 0).astype(np.int64)
    excess = int(table.sum()) - size
    for i in np.argsort(-table, kind="stable"):  # the most frequent ones give or take what rounding left over
        if excess <= 0:
            table[i] -= excess
            break
        give = min(excess, int(table[i]) // 2)
        table[i] -= give
        excess -= give
    return table


class Coder:
    """Encoder and decoder for one frequency table; the lanes' states run side by side in numpy, a checkpoint is kept every `gap` steps."""

    def __init__(self, table: np.ndarray, lanes: int = LANES, gap: int = CHECKPOINT_STEPS):
        self.lanes, self.gap = lanes, gap
        self.freq = table.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(table)])[:-1].astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(table), dtype=np.uint32), table)

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Payload words, and checkpoints: rows of (word place, states) at step 0, gap, 2 gap, ..."""
        n, bits = len(ids), np.uint64(SCALE_BITS)
        steps = -(-n // self.lanes)
        state = np.full(self.lanes, _LOW, np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []
        written = 0
        for step in range(steps - 1, -1, -1):
            part = ids[step * self.lanes : (step + 1) * self.lanes].astype(np.int64)
            k = len(part)
            x, f = state[:k], self.freq.take(part)
            full = np.flatnonzero(x >= f << np.uint64(63 - SCALE_BITS))  # (2^31 >> bits) << 32 states per frequency
            if full.size:
                words.append((x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)[::-1])
                written += full.size
                x[full] >>= np.uint64(32)
            q = x // f
            state[:k] = (q << bits) + (x - q * f) + self.start.take(part)
            if step % self.gap == 0:
                marks.append((written, state.copy()))
        payload = np.concatenate(words)[::-1] if words else np.zeros(0, np.uint32)
        places = np.array([written - w for w, _ in marks[::-1]], np.uint64)
        states = np.array([s for _, s in marks[::-1]], np.uint64).reshape(-1, self.lanes)
        return np.ascontiguousarray(payload), np.hstack([places[:, None], states])

    def decode(self, payload: np.ndarray, mark: np.ndarray, first_step: int, last_step: int, n: int) -> np.ndarray:
        """Ids of the steps first_step to last_step - 1 of a block of n ids, from the checkpoint at first_step."""
        at, state = int(mark[0]), mark[1:].copy()
        bits, mask = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
        out = np.empty(max(0, min(n, last_step * self.lanes) - first_step * self.lanes), np.uint32)
        for step in range(first_step, last_step):
            k = min(self.lanes, n - step * self.lanes)
            x = state[:k]
            slot = x & mask
            part = self.symbol.take(slot.view(np.int64))
            at_part = part.astype(np.int64)
            x = self.freq.take(at_part) * (x >> bits) + slot - self.start.take(at_part)
            low = np.flatnonzero(x < _LOW)
            if low.size:
                x[low] = (x[low] << np.uint64(32)) | payload[at : at + low.size]
                at += low.size
            state[:k] = x
            out[(step - first_step) * self.lanes : (step - first_step) * self.lanes + k] = part
        return out


def parts_of(coder: Coder, lengths: np.ndarray, ids: np.ndarray) -> Iterator[tuple[dict, int, int]]:
    """A block's parts in turn, as fields of PART_SCHEMA, with the first and the last document that have ids there. No length is 0."""
    payload, marks = coder.encode(ids)
    words = np.append(marks[:, 0].astype(np.int64), len(payload))
    ends = np.cumsum(lengths)
    size = coder.gap * coder.lanes
    for part, at in enumerate(range(0, len(ids), size)):
        end = min(len(ids), at + size)
        i, j = np.searchsorted(ends, [at, end - 1], "right").tolist()
        inside = np.minimum(ends[i : j + 1], end) - np.maximum(ends[i : j + 1] - lengths[i : j + 1], at)
        data, own = payload[words[part] : words[part + 1]].astype("<u4").tobytes(), ids[at:end].astype("<u4").tobytes()
        row = {
            "part": part, "n_tokens": end - at, "lengths": inside.astype("<u4").tobytes(), "before": at - int(ends[i] - lengths[i]), "after": int(ends[j]) - end,
            "states": marks[part, 1:].astype("<u8").tobytes(), "payload": data, "payload_crc32": crc32(data), "ids_crc32": crc32(own),
        }
        yield row, i, j


def decode_part(coder: Coder, row: dict) -> np.ndarray:
    """The ids of a part; raises if a checksum differs."""
    if crc32(row["payload"]) != row["payload_crc32"]:
        raise ValueError(f"part {row['file_no']}/{row['block_no']}/{row['part']}: payload checksum differs")
    n = row["n_tokens"]
    mark = np.concatenate([np.zeros(1, np.uint64), np.frombuffer(row["states"], "<u8")])
    ids = coder.decode(np.frombuffer(row["payload"], "<u4"), mark, 0, -(-n // coder.lanes), n)
    if crc32(ids.astype("<u4").tobytes()) != row["ids_crc32"]:
        raise ValueError(f"part {row['file_no']}/{row['block_no']}/{row['part']}: ids checksum differs")
    return ids


def _token_rows(docs: DataFrame, path: str, end_id: int, id_type: str) -> DataFrame:
    """doc_id and its ids with end_id, two bytes each where they fit."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [ids.astype("<u2").tobytes() if ids.max() < 65536 else b"\0" + ids.astype("<u4").tobytes() for ids in tokenizer(path, "bytes").encode(batch.column(1), end_id)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["doc_id", "ids"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {id_type}, ids binary")


def _ids(blob) -> np.ndarray:
    """An odd length marks four-byte ids after one byte."""
    return np.frombuffer(blob, "<u4", offset=1) if memoryview(blob).nbytes % 2 else np.frombuffer(blob, "<u2")


def count_ids(tokens: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each id over all documents: one sparse count a task, summed by Spark; `size` rows at most return."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.concatenate([_ids(x.as_buffer()) for x in batch.column(0)]), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["id", "n"])

    counts = np.zeros(size, np.int64)
    rows = tokens.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for i, n in rows.collect():  # at most one row for each id of the vocabulary
        counts[i] = n
    return counts


def write_tokens(docs: DataFrame, path: str, end_id: int, vocabulary: int) -> tuple[DataFrame, DataFrame]:
    """Tokenizes, counts, and writes blocks in ascending doc_id order: (their parts, the table(id, freq)), both reread.

    doc_id may be null (first) or repeated. Three passes: ids are made once and written; their counts give the shared
    table; a range shuffle by doc_id deals the ids to files. A hot doc_id is spread by the row's place.
    """
    lanes, gap, id_type = LANES, CHECKPOINT_STEPS, docs.schema["doc_id"].dataType.simpleString()
    tokens = saved(_token_rows(docs, path, end_id, id_type), "rans-ids")
    table = frequency_table(count_ids(tokens, vocabulary))
    shared = docs.sparkSession.sparkContext.broadcast(table)  # one number for each id of the vocabulary

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        coder, no, done, file_no = Coder(shared.value, lanes, gap), 0, 0, -1
        held: list[np.ndarray] = []
        keys: list = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            lengths = np.array([len(x) for x in held], np.int64)
            first = done
            for row, i, j in parts_of(coder, lengths, np.concatenate(held)):
                yield pa.RecordBatch.from_pylist([row | {"file_no": file_no, "block_no": no, "first": first, "doc_ids": _pack_keys(keys[i : j + 1])}], schema=_ARROW)
                first += row["n_tokens"]

        for batch in batches:
            for key, blob, part in zip(*(batch.column(i) for i in range(3)), strict=True):
                held.append(_ids(blob.as_py()))
                keys.append(key.as_py())
                file_no, size = part.as_py(), size + len(held[-1])
                if size >= BLOCK_TOKENS:
                    yield from close()
                    no, done, size, held, keys = no + 1, done + size, 0, [], []
        if held:
            yield from close()

    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = tokens.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(n, "doc_id", "_place").sortWithinPartitions("doc_id", "_place")
    groups = {"parquet.block.size": GROUP_BYTES, "parquet.block.size.row.check.min": 1}
    parts = saved(placed.select("doc_id", "ids", F.spark_partition_id()).mapInArrow(encode, PART_SCHEMA), "rans-parts", **groups)
    table_rows = docs.sparkSession.createDataFrame([(int(i), int(table[i])) for i in np.flatnonzero(table)], "id int, freq long")
    return parts, saved(table_rows.coalesce(1), "rans-table")


_ARROW = pa.schema([(c, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t]) for c, t in (x.split() for x in PART_SCHEMA.split(", "))])


def _pack_keys(keys: list) -> bytes:
    """doc_ids as an Arrow stream: any type, with nulls."""
    batch = pa.RecordBatch.from_arrays([pa.array(keys)], names=["doc_id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_tokens(parts: DataFrame, table: DataFrame, vocabulary: int, id_type: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (32 bits each) of every document.

    Each part is decoded from its checkpoint, wherever its row is read, and gives the documents that lie in it whole. What
    it has of others is dealt by document, sorted by place, and read as a stream: the checksum goes on from piece to piece.
    """
    spark, lanes, gap = parts.sparkSession, LANES, CHECKPOINT_STEPS
    freq = np.zeros(vocabulary, np.int64)
    for i, f in table.collect():
        freq[i] = f
    shared = spark.sparkContext.broadcast(freq)
    # one row for each file
    totals = sorted(tuple(r) for r in parts.groupBy("file_no").agg(F.sum("n_tokens")).collect())
    firsts = dict(zip((f for f, _ in totals), np.cumsum([0, *(n for _, n in totals)]).tolist(), strict=False))
    arrow_id = spark.createDataFrame([], f"doc_id {id_type}").toArrow().schema.field(0).type
    schema = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long, ids binary"
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        coder = Coder(shared.value, lanes, gap)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                data = decode_part(coder, row).astype("<u4").tobytes()
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                ends = np.cumsum(lengths)
                keys = pa.ipc.open_stream(row["doc_ids"]).read_all().column(0).combine_chunks().cast(arrow_id)
                pieces = [data[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
                at = firsts[row["file_no"]] + row["first"] + ends - lengths
                start, whole = at.copy(), np.ones(len(at), bool)
                start[0] -= row["before"]
                whole[0] &= not row["before"]
                whole[-1] &= not row["after"]
                kept = [x if with_ids or not w else None for x, w in zip(pieces, whole.tolist(), strict=True)]
                columns = [keys, start, lengths, pa.array([crc32(x) for x in pieces], pa.int64()), pa.array(kept, pa.binary()), at, whole]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=[*names, "at", "whole"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, start, n, crc, held = None, -1, 0, 0, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], arrow_id), pa.array([start]), pa.array([n]), pa.array([crc], pa.int64()), pa.array([b"".join(held) if with_ids else None], pa.binary())], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if row["start"] != start:
                    if n:
                        yield out()
                    key, start, n, crc, held = row["doc_id"], row["start"], 0, 0, []
                n, crc = n + row["n_tokens"], crc32(row["ids"], crc)
                if with_ids:
                    held.append(row["ids"])
        if n:
            yield out()

    decoded = saved(parts.mapInArrow(decode, f"{schema}, at long, whole boolean"), "rans-decoded")
    split = decoded.where("not whole").repartition("start").sortWithinPartitions("start", "at")
    found = decoded.where("whole").select(*names).unionByName(split.select(*names).mapInArrow(join, schema))
    return found if with_ids else found.drop("ids")


def token_digest(docs: DataFrame, path: str, end_id: int = 2, vocabulary: int = 50257) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from token files written and read back.

    Null or empty text has the end id alone; an empty table gives an empty table; rows with equal doc_id keep the order
    of the input. The checks of payload and ids run on every part.
    """
    parts, table = write_tokens(docs, path, end_id, max(vocabulary, end_id + 1))
    return read_tokens(parts, table, max(vocabulary, end_id + 1), docs.schema["doc_id"].dataType.simpleString(), with_ids=False)
