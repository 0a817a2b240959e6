"""What the corpus operators share: written intermediate tables, row numbers and text kernels on Arrow buffers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a numpy kernel takes at a time; a longer document is taken alone.
CHUNK_BYTES = 1 << 18
BATCH_BYTES = 4 << 20
_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; if that is unset, a local one in local mode only."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="tidemark-"))
        folder = f"file://{_own_folder[0]}"
    return f"{folder.rstrip('/')}/tidemark"


def bounded_batches(spark: SparkSession) -> None:
    """Batches that go to Python are bounded by bytes too, so that runs of very long texts need no more memory than others.
    A setting of the session; a lower number of bytes stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def saved(df: DataFrame, name: str, **options) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives lost executors and is read in pieces."""
    bounded_batches(df.sparkSession)
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**{"compression": "zstd"} | options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def key_crc32(column: str) -> Column:
    """Unsigned crc32 of the value as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def numbered(df: DataFrame, order: list, into: str = "row_no", partitions: int | None = None) -> DataFrame:
    """df, written to the shared folder, with the global number of each row in the given order, from 0, in the column `into`.

    Rows are dealt by range, also by their place in the input so that equal keys spread over tasks; only one count for
    each partition reaches the driver.
    """
    # columns of df are kept in a struct of their own, so no name clashes
    ranked = df.select(F.struct(*df.columns).alias("row"), *((F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order)), F.monotonically_increasing_id().alias("place"))
    keys = [*(f"k{i}" for i in range(len(order))), "place"]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranked.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # monotonically_increasing_id holds the partition in its upper bits and the place in it in the lower 33
    dealt = saved(dealt.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")), "numbered")
    starts, total = {}, 0
    for part, rows in sorted(tuple(r) for r in dealt.groupBy("part").count().collect()):
        starts[part] = total
        total += rows
    # one row for each partition: bounded by the number of partitions, never by the number of rows
    first = df.sparkSession.createDataFrame(list(starts.items()), "part int, first long")
    out = dealt.join(F.broadcast(first), "part")
    return out.select(*(F.col("row")[c].alias(c) for c in df.columns if c != into), (F.col("first") + F.col("at")).alias(into))


# ---- text kernels -----------------------------------------------------------------------------------------------------

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_LOWER = _VALUE.copy()
_LOWER[65:91] = _VALUE[97:123]
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, 2 * CHUNK_BYTES)
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, offsets) of runs of rows with about `limit` bytes. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of non-separator bytes of each document, and each document's first run."""
    inside = ~separator[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cut = offsets[:-1][offsets[:-1] < len(data)]
        before[cut] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the byte runs; `lower` maps A-Z to a-z."""
    if not len(starts):
        return np.zeros(0, _U)
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((_LOWER if lower else _VALUE)[data] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k hashes that begin at each place (the last k-1 places have none)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for i in range(k):
        out = out * _U(0xD1342543DE82EF95) + words[i : i + n]
    return mix(out)


def per_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[d]:first[d + 1]] for each document d."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """df.mapInArrow for a function of one batch; None and empty batches vanish."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = function(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def word_count(text: Column) -> Column:
    r"""Number of words [^\x20\x09-\x0D]+; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
