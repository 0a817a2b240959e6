"""Quality classifier by positive-unlabelled learning with the non-negative risk."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, text_chunks
from tidemark.llm.rules import text_metrics

#: Trusted positives that are learned from, at most.
POSITIVES = 4000
#: Unlabelled texts are drawn by strata of language (in so many groups by hash) and length (powers of 4): so many in proportion, but of
#: each stratum LEAST or all it has. They weigh as many as they stand for, so the unlabelled risk is an unbiased one over
#: all rows, and no language or length is without a part in it.
UNLABELLED, LANGUAGE_GROUPS, LEAST = 8000, 64, 32
EPOCHS, STEP, DECAY = 300, 0.03, 1e-4

# byte classes: other, lower case, upper case, digit, space, line feed, end of a clause, other ASCII punctuation, bytes over 127
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 1
_CLASS[[32, 9]], _CLASS[[10, 13]], _CLASS[list(b".,;:!?")] = 4, 5, 6
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:!?"]] = 7
_TRIPLES = 8**3


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of numbers from whole texts: shares of byte-class triples, and shapes of words, lines and repeats."""
    n = len(offsets) - 1
    m = text_metrics(data, offsets)
    words, lines = np.maximum(1, m["n_words"]), np.maximum(1, m["n_lines"])
    sizes = np.diff(offsets)
    kinds = _CLASS[data]
    doc = np.repeat(np.arange(n), sizes)
    inside = doc[:-2] == doc[2:] if len(doc) > 2 else np.zeros(0, bool)
    triples = (kinds[:-2] * 64 + kinds[1:-1] * 8 + kinds[2:] if len(doc) > 2 else np.zeros(0, np.int64))[inside]
    counts = np.bincount(doc[:-2][inside] * _TRIPLES + triples, minlength=n * _TRIPLES).reshape(n, _TRIPLES) if len(triples) else np.zeros((n, _TRIPLES))
    shape = np.stack([np.log1p(m["n_words"]), m["word_chars"] / words, m["n_symbols"] / words, m["n_dup_lines"] / lines, m["n_repeat_words"] / words, np.sqrt(m["n_repeat_words"] / words), np.log1p(words / lines), m["n_words"] == 0, m["n_adjacent"] / words], 1)
    return np.hstack([shape, np.sqrt(counts / np.maximum(1, sizes)[:, None])]).astype(np.float32)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, weight: np.ndarray | None = None) -> QualityModel:
    """weight: rows that each unlabelled one stands for. Minimises prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss, by Adam over all rows.

    Where the second part falls below 0, which only over-fitting can do, its own gradient is climbed instead. With the
    logistic loss the score estimates the probability of a positive.
    """
    n = len(positive) + len(unlabelled)
    share = np.full(len(unlabelled), 1 / len(unlabelled)) if weight is None else weight / weight.sum()
    mean = (positive.sum(0, dtype=np.float64) + len(unlabelled) * (share @ unlabelled)) / n
    square = ((positive - mean) ** 2).sum(0) + len(unlabelled) * (share @ (unlabelled - mean) ** 2)
    scale = np.where((scale := np.sqrt(square / n)) > 1e-6, scale, 1.0)
    p, u = (np.clip((x - mean) / scale, -6, 6).astype(np.float32) for x in (positive, unlabelled))
    w = np.zeros(p.shape[1] + 1)  # the last is the bias
    first, second = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    even = np.full(len(p), 1 / len(p))
    grad = lambda x, d, part: np.append((d * part).astype(np.float32) @ x, d @ part)
    for t in range(1, EPOCHS + 1):
        v = w[:-1].astype(np.float32)
        zp, zu = (p @ v + w[-1]).astype(np.float64), (u @ v + w[-1]).astype(np.float64)
        negative = share @ np.logaddexp(0, zu) - prior * np.logaddexp(0, zp).mean()
        g_negative = grad(u, sigmoid(zu), share) - prior * grad(p, sigmoid(zp), even)
        g = prior * grad(p, sigmoid(zp) - 1, even) + g_negative if negative >= 0 else -g_negative
        g[:-1] += DECAY * w[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= STEP * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return QualityModel(mean.astype(np.float32), scale.astype(np.float32), w[:-1].astype(np.float32), float(w[-1]), prior)


def featurize(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` and `features` (little-endian 32-bit floats) of every whole text."""

    def run(batches):
        for batch in batches:
            rows = [r.tobytes() for _, _, data, offsets in text_chunks(batch.column(len(keep))) for r in text_features(data, offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.binary())], names=[*keep, "features"])

    narrow = docs.select(*keep, "text")
    return narrow.mapInArrow(run, narrow.drop("text").withColumn("features", F.lit(b"")).schema)


def learn(docs: DataFrame, labels: DataFrame, learned: Column) -> QualityModel | None:
    """A model from rows where `learned` holds: trusted positives are those with quality 1; unlabelled are all texts.

    The class prior is the share of positives among the labelled rows there. Negative labels serve for nothing else. Rows
    equal in doc_id and text count once, rows that share a doc_id count each; a row of which `learned` is null, as with a
    null doc_id, is not learned from. Positives are those with the smallest hash of doc_id and text, POSITIVES at most;
    unlabelled ones are drawn in the same way from each stratum (see LEAST). docs without a column lang are strata by length
    alone: languages serve for the draw, never for a score. None if there are no positives.
    """
    marked = labels.where(learned & F.col("quality").isNotNull())
    totals = marked.agg(F.count("*"), F.sum(F.when(F.col("quality") == 1, 1).otherwise(0))).first()
    if not totals[1]:
        return None
    prior = min(0.98, totals[1] / totals[0])
    group = F.pmod(F.xxhash64("lang"), F.lit(LANGUAGE_GROUPS)) if "lang" in docs.columns else F.lit(0).cast("long")
    length = F.least(F.lit(15), F.floor(F.log(F.coalesce(F.octet_length("text"), F.lit(0)) + 1.0) / float(np.log(4.0))))
    rows = docs.where(learned).select(F.col("doc_id").alias("_id"), "text", F.xxhash64("doc_id", "text").alias("_hash"), (group * 16 + length).cast("int").alias("_stratum"))
    every = saved(rows.groupBy("_hash").agg(F.first("_id").alias("_id"), F.first("_stratum").alias("_stratum")), "quality-rows")
    trusted = every.join(marked.where("quality = 1").select(F.col("doc_id").alias("_id")), "_id", "left_semi").orderBy("_hash").limit(POSITIVES)
    # one row for each stratum: 16 * LANGUAGE_GROUPS at most
    strata = {r[0]: r[1] for r in every.groupBy("_stratum").agg(F.count("*")).collect()}
    total = sum(strata.values())
    quota = {k: min(n, max(LEAST, round(UNLABELLED * n / total))) for k, n in strata.items()}
    quotas = docs.sparkSession.createDataFrame([(k, n, quota[k]) for k, n in strata.items()], "_s int, _n long, _quota long")
    few = F.pmod("_hash", F.lit(1 << 30)) * F.col("_n") < (F.col("_quota") * 2.0 + 50) * (1 << 30)
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy(F.pmod("_hash", F.lit(1 << 30)), "_hash"))
    drawn = every.join(F.broadcast(quotas), F.col("_stratum") == F.col("_s")).where(few).withColumn("_rank", rank).where(F.col("_rank") <= F.col("_quota"))
    ids = trusted.select(F.col("_hash").alias("_h"), F.lit(True).alias("is_p"), F.lit(0.0).alias("stands")).unionByName(drawn.select(F.col("_hash").alias("_h"), F.lit(False).alias("is_p"), (F.col("_n") / F.col("_quota")).alias("stands")))
    ids = saved(ids.groupBy("_h").agg(F.max("is_p").alias("is_p"), F.max("stands").alias("stands")), "quality-ids")
    # at most POSITIVES + UNLABELLED + LEAST a stratum hashes are broadcast, and as many rows of 520 numbers come back; a repeated row
    # is made one where it is, before its text moves
    sample = rows.join(F.broadcast(ids), F.col("_hash") == F.col("_h")).groupBy("_hash").agg(*(F.first(c).alias(c) for c in ("text", "is_p", "stands")))
    found = sorted(tuple(r) for r in featurize(sample, ["_hash", "is_p", "stands"]).collect())
    if not found:
        return None
    x = np.array([np.frombuffer(r[3], "<f4") for r in found])
    is_p, stands = np.array([bool(r[1]) for r in found]), np.array([r[2] for r in found])
    drawn_rows = stands > 0
    return fit(x[is_p], x[drawn_rows], prior, stands[drawn_rows]) if is_p.any() and drawn_rows.any() else None


def scored(docs: DataFrame, model: QualityModel | None, text: str = "text", into: str = "score") -> DataFrame:
    """docs with the score (0 to 1) of every whole text; null counts as empty. Without a model every score is 0.5. No shuffle."""
    docs = docs.drop(into)
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 520 numbers

    def run(batches):
        own = shared.value
        for batch in batches:
            score = np.full(batch.num_rows, 0.5)
            if own is not None:
                for i, j, data, offsets in text_chunks(batch.column(names.index(text))):
                    score[i:j] = own.score(text_features(data, offsets))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*names, into])

    return docs.mapInArrow(run, docs.withColumn(into, F.lit(0.0)).schema)
