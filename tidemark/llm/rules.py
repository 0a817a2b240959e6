"""Quality rules with thresholds from mergeable quantile sketches for each language and source."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SEPARATOR, _U, map_batches, mix, per_document, run_hashes, saved, text_chunks, window_hashes, word_bounds

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
#: A sketch counts values in bins whose ends grow by this ratio, so a quantile is off by half of it at most, 0.25 % of the value. Counts
#: are whole numbers and merge by addition: the result is the same for every order, partition and run. A metric between
#: 10^-9 and 10^9 has 8,300 bins at most, however many documents there are.
BIN_RATIO = 1.005
_ZERO = -(1 << 31)
#: Quantiles of a group of n documents weigh n / (n + this), those of its language the rest: no size is a switch. In the same way a
#: language leans on all documents, but for word length, which languages don't share.
PRIOR_DOCS = 200
METRICS = ("symbols_per_word", "dup_line_share", "repeat_word_share", "word_length")
#: Word length may be so many spreads beyond the quartiles. A spread is the distance from the median to the nearer quartile, so up to
#: a quarter of a group may be junk on either side without moving the limits much.
LENGTH_SPREADS = 5.0
#: A share may be so many spreads over this quantile of its group; a spread is the distance from the median to the quantile. Shares are
#: taken from documents that pass the base rules and whose word length is within its limits; 5 % of those may be junk.
SHARE_QUANTILE, SHARE_SPREADS = 0.95, 2.0
#: Guard against zero width: the least event (a symbol, a line that repeats, a passage of three words that occurs twice) in a document
#: of the group's median size.
LEAST_EVENT = {"symbols_per_word": (1, "n_words"), "dup_line_share": (1, "n_lines"), "repeat_word_share": (6, "n_words")}
#: The same for word length, in characters a word.
LEAST_LENGTH_SPREAD = 0.001

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_LINE_FEED = np.zeros(256, bool)
_LINE_FEED[10] = True
_STARTS_CHAR = np.ones(256, bool)
_STARTS_CHAR[0x80:0xC0] = False


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(keys)
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        equal = keys[order[1:]] == keys[order[:-1]]
        hit = np.zeros(len(keys), bool)
        hit[1:] = equal
        hit[:-1] |= equal
        same[order] = hit
    return same


def text_metrics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of a run of documents, all from the bytes."""
    n = len(offsets) - 1
    starts, ends, first = word_bounds(data, offsets)
    words = run_hashes(data, starts, ends)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(n), n_words)
    chars = np.concatenate([[0], np.cumsum(_STARTS_CHAR[data] & ~SEPARATOR[data])])
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[data])])
    # 3-word windows: a word counts if any window with it occurs twice in its document
    repeated = np.zeros(len(words) + 2, bool)
    if len(words) >= 3:
        inside = doc[:-2] == doc[2:]
        places = np.flatnonzero(inside)
        keys = window_hashes(words, 3)[places] ^ mix(doc[places].astype(_U) + _U(1))
        place = places[_repeats(keys)]
        repeated[place] = repeated[place + 1] = repeated[place + 2] = True
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    # lines: runs between line feeds that hold a word
    line_starts, line_ends, _ = word_bounds(data, offsets, _LINE_FEED)
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    lines = run_hashes(data, line_starts, line_ends) ^ mix(line_doc.astype(_U) + _U(1))
    n_lines = np.bincount(line_doc, minlength=n)
    _, at = np.unique(lines, return_index=True)
    return {
        "n_words": n_words,
        "word_chars": np.diff(chars[offsets]),
        "n_symbols": np.diff(symbols[offsets]),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - np.bincount(line_doc[at], minlength=n),
        "n_adjacent": per_document(again, first),
        "n_repeat_words": per_document(repeated[: len(words)], first),
    }


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text; null counts as empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [text_metrics(data, offsets) for _, _, data, offsets in text_chunks(batch.column(3))]
        counts = [pa.array(np.concatenate([p[c] for p in parts]).astype(np.int64)) for c in _COUNTS]
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *counts], names=["doc_id", "lang", "source", *_COUNTS])

    narrow = docs.select("doc_id", "lang", "source", "text")
    return map_batches(narrow, run, narrow.drop("text").withColumns({c: F.lit(0).cast("long") for c in _COUNTS}).schema)


def _shares() -> dict[str, Column]:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_word_share": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
    }


def _bin(value: Column) -> Column:
    return F.when(value > 0, F.floor(F.log(value) / float(np.log(BIN_RATIO)))).otherwise(F.lit(_ZERO)).cast("int")


def _of_bin(number: Column) -> Column:
    """The middle of a bin."""
    return F.when(number == _ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(BIN_RATIO), number + 0.5))


def _sketches(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """lang, source, metric (its place), bin, n: one row for each bin of each metric in each (language, source), summed where the rows are."""
    bins = F.posexplode(F.array(*(_bin(F.col(c).cast("double")) for c in metrics))).alias("metric", "bin")
    return rows.select("lang", "source", bins).groupBy("lang", "source", "metric", "bin").agg(F.count("*").alias("n"))


def _quantiles(sketches: DataFrame, by: list[str], wanted: dict[str, tuple[float, ...]], level: str) -> DataFrame:
    """by, docs_<level> and <metric>_<place>_<level>: the least bin up to which the quantile's share of the group lies.

    Sketches of a wider group are sums of those of its parts. A task orders the bins of a group's metric, never its documents.
    """
    merged = sketches.groupBy(*by, "metric", "bin").agg(F.sum("n").alias("n"))
    place = Window.partitionBy(*by, "metric").orderBy("bin")
    run = merged.withColumns({"upto": F.sum("n").over(place.rowsBetween(Window.unboundedPreceding, 0)), "docs": F.sum("n").over(Window.partitionBy(*by, "metric"))})
    found = [
        _of_bin(F.min(F.when((F.col("metric") == m) & (F.col("upto") >= F.greatest(F.lit(1), F.ceil(F.col("docs") * q))), F.col("bin")))).alias(f"{c}_{i}_{level}")
        for m, (c, ranks) in enumerate(wanted.items()) for i, q in enumerate(ranks)
    ]
    return run.groupBy(*by).agg(F.max("docs").alias(f"docs_{level}"), *found)


def _group_quantiles(rows: DataFrame, wanted: dict[str, tuple[float, ...]]) -> DataFrame:
    """lang, source, and for each column of `wanted` its quantiles as <column>_<place>. One row for each (language, source).

    One sketch for each (language, source) is built where the rows are and merged; sketches of a language and of all
    documents are merges of those, so the rows are read once.
    """
    sketches = saved(_sketches(rows, list(wanted)), "rule-sketches")
    names = [f"{c}_{i}" for c, ranks in wanted.items() for i in range(len(ranks))]
    own = _quantiles(sketches, ["lang", "source"], wanted, "own")
    lang = _quantiles(sketches, ["lang"], wanted, "lang").withColumnRenamed("lang", "_l")
    every = _quantiles(sketches.withColumn("_all", F.lit(0)), ["_all"], wanted, "all").drop("_all")
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("_l"))).join(F.broadcast(every))  # `every` is one row

    def pick(n: str) -> Column:
        def blend(level: str, wider: Column) -> Column:
            return wider + F.col(f"docs_{level}") / (F.col(f"docs_{level}") + PRIOR_DOCS) * (F.col(f"{n}_{level}") - wider)

        lang = F.col(f"{n}_lang") if n.startswith("word_length") else blend("lang", F.col(f"{n}_all"))
        return blend("own", lang).alias(n)

    return joined.select("lang", "source", *(pick(n) for n in names))


def _with_limits(counted: DataFrame, limits: DataFrame) -> DataFrame:
    # one row of limits for each (language, source): Spark broadcasts it if its size allows, else splits skewed keys
    limits = limits.withColumnsRenamed({"lang": "_l", "source": "_s"})
    return counted.join(limits, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_l", "_s")


_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words"


def thresholds(counted: DataFrame) -> DataFrame:
    """lang, source, and the lowest and highest word length and the highest shares allowed there: a row for each (language, source).

    Word length first, from the quartiles of all documents of MIN_WORDS words; then the shares, from documents within
    those limits. Both passes read counts, never texts.
    """
    rows = counted.withColumns(_shares())
    found = _group_quantiles(rows.where(F.col("n_words") >= MIN_WORDS), {"word_length": (0.25, 0.5, 0.75)})
    low, mid, high = (F.col(f"word_length_{i}") for i in range(3))
    beyond = LENGTH_SPREADS * F.greatest(F.least(high - mid, mid - low), F.lit(LEAST_LENGTH_SPREAD))
    lengths = saved(found.select("lang", "source", (high + beyond).alias("word_length_max"), (low - beyond).alias("word_length_min")), "rule-lengths")
    usual = _with_limits(rows, lengths).where(f"NOT ({_FAILED})").where("word_length BETWEEN word_length_min AND word_length_max")
    found = _group_quantiles(usual, {**dict.fromkeys(LEAST_EVENT, (0.5, SHARE_QUANTILE)), "n_words": (0.5,), "n_lines": (0.5,)})

    def share(m: str) -> Column:
        mid, top = F.col(f"{m}_0"), F.col(f"{m}_1")
        event, size = LEAST_EVENT[m]
        return (top + SHARE_SPREADS * (top - mid) + event / F.greatest(F.col(f"{size}_0"), F.lit(1.0))).alias(f"{m}_max")

    shares = found.select("lang", "source", *(share(m) for m in LEAST_EVENT))
    # a group without such documents has no limits of shares: none of its documents can be kept
    return _with_limits(lengths, shares)


def apply_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document.

    base_failed: under MIN_WORDS words, or over half of the words repeat. Others are kept if every metric is within the
    thresholds of their language and source. Null and empty texts fail; null languages and sources are groups of their
    own; repeated rows are judged alike; an empty table gives an empty table. Reruns agree to the bit: sketches are counts.
    Only counts are shuffled, never texts.
    """
    counted = saved(with_counts(docs), "rule-counts")
    limits = saved(thresholds(counted), "rule-thresholds")
    failed = F.expr(_FAILED)
    joined = _with_limits(counted, limits).withColumns(_shares())
    within = F.col("word_length") >= F.col("word_length_min")
    for m in METRICS:
        within &= F.col(m) <= F.col(f"{m}_max")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return joined.select("doc_id", *counts, failed.alias("base_failed"), F.coalesce(~failed & within, F.lit(False)).alias("kept"), *METRICS)
