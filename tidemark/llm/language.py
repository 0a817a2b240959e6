"""Language identification by string kernels: presence of character n-grams, Nyström landmarks, kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, text_chunks

#: Symbols: 0 for what is no letter, 1 to 26 for a to z; each script has some of its own, which its letters share by code point.
SYMBOL_BITS = 7
#: (first code point, code point after the last, number of symbols); all other letters share the last symbols. Scripts of 2 to 4
#: symbols are told from others, but languages that share one of them hardly from each other.
SCRIPTS = (
    (0x00C0, 0x0250, 30), (0x0370, 0x0400, 8), (0x0400, 0x0530, 32), (0x0590, 0x0600, 6), (0x0600, 0x0780, 8), (0x0900, 0x0E00, 4), (0x0E00, 0x0F00, 2), (0x3040, 0x30A0, 2), (0x30A0, 0x3100, 2),
    (0x3400, 0xA000, 2), (0xAC00, 0xD7B0, 2),
)
#: Blended spectrum: all lengths from 1 to this.
LONGEST = 3
#: Where the codes of each length begin, and how many codes there are.
_BASE = np.cumsum([0, *(1 << (SYMBOL_BITS * k) for k in range(1, LONGEST + 1))])
N_CODES = int(_BASE[-1])
#: Labelled documents that are learned from, of each language and at most; landmarks among them.
PER_LANGUAGE, MOST_LEARNED, LANDMARKS = 400, 4000, 256
#: Numbers of all their sets together, at most: what comes to the driver is 200 MB at most, or one set.
MOST_CODES = 50_000_000
RIDGE = 1e-3
UNDETERMINED = "und"


@lru_cache(1)
def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each code point, and whether it is a letter."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    lower = np.fromiter((ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x110000)), np.int64, 0x110000)
    first = 27 + sum(n for *_, n in SCRIPTS)
    symbol = first + lower % ((1 << SYMBOL_BITS) - first)
    at = 27
    for low, high, n in SCRIPTS:
        symbol[low:high] = at + lower[low:high] % n
        at += n
    symbol = np.where((lower >= 97) & (lower <= 122), lower - 96, symbol)
    return np.where(letter, symbol, 0).astype(np.int32), letter


def ngram_codes(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """For each document the codes of its n-grams of all lengths (with repeats), and whether it has a letter."""
    symbol, letter = _symbols()
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    all_symbols, letters = symbol[points], np.concatenate([[0], np.cumsum(letter[points])])
    for a, b in zip(chars[:-1].tolist(), chars[1:].tolist(), strict=True):
        own = all_symbols[a:b]
        codes, gram = [own], own
        for k in range(2, LONGEST + 1):
            gram = (gram[:-1] << SYMBOL_BITS) + own[k - 1 :]
            codes.append(gram + _BASE[k - 1])
        yield np.concatenate(codes), bool(letters[b] > letters[a])


@dataclass
class LanguageModel:
    """Landmarks over the codes that occur in them, and the ridge weights of one one-versus-rest problem a language."""

    languages: list[str]
    codes: np.ndarray  # the codes that occur in a landmark
    landmarks: np.ndarray  # landmarks x codes, 0 or 1
    sizes: np.ndarray  # distinct n-grams of each landmark
    weights: np.ndarray  # landmarks x languages

    def kernel(self, present: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Normalised presence kernel of rows (0 or 1 for each code) with the landmarks: shared n-grams / sqrt of sizes."""
        shared = present @ self.landmarks.T
        return shared / np.sqrt(np.maximum(1, sizes)[:, None] * self.sizes[None, :])

    def predict(self, present: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = self.kernel(present, sizes) @ self.weights
        best = values.argmax(1)
        return best, np.clip((values[np.arange(len(best)), best] + 1) / 2, 0.0, 1.0)


def fit(grams: list[np.ndarray], labels: list[str]) -> LanguageModel | None:
    """Kernel ridge regression in the Nyström space: minimises |K_nm w - y|^2 + ridge * n * w' K_mm w for each language."""
    languages = sorted(set(labels))
    if not languages:
        return None
    order = sorted(range(len(grams)), key=lambda i: (sum(labels[j] == labels[i] for j in range(i)), labels[i]))  # languages take turns
    marks = [grams[i] for i in order[:LANDMARKS]]
    codes = np.unique(np.concatenate(marks)).astype(np.int64)
    dense = lambda rows: np.array([np.isin(codes, r) for r in rows], np.float32).reshape(len(rows), len(codes))
    model = LanguageModel(languages, codes, dense(marks), np.array([len(r) for r in marks], np.float32), np.zeros(0))
    k_mm = model.kernel(model.landmarks, model.sizes).astype(np.float64)
    left, right = RIDGE * len(grams) * k_mm + 1e-8 * len(grams) * np.eye(len(marks)), np.zeros((len(marks), len(languages)))
    for at in range(0, len(grams), 256):
        k = model.kernel(dense(grams[at : at + 256]), np.array([len(r) for r in grams[at : at + 256]], np.float32)).astype(np.float64)
        y = np.array([[1.0 if lab == x else -1.0 for x in languages] for lab in labels[at : at + 256]])
        left += k.T @ k
        right += k.T @ y
    model.weights = np.linalg.solve(left, right).astype(np.float32)
    return model


def learn(docs: DataFrame, learned: Column, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """A model from the texts and languages of rows where `learned` holds: at most per_language distinct rows (doc_id, language and
    text) of each language, those with the smallest hash, and MOST_LEARNED in all, MOST_CODES numbers in all (a bounded
    sample of labelled rows, whole texts; languages take turns). None if there is no such row.

    Repeated rows count once and rows that share a doc_id count each, so a language never vanishes behind the ids of another. A row of
    which `learned` is null, as with a null doc_id, is not learned from. A first pass counts the languages' distinct rows;
    only rows whose hash is among about the first 2 * per_language + 50 of their language are ranked, so a language of any
    size costs its task no more than that.
    """
    rows = docs.where(learned & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", F.col("lang").alias("_lang"), F.xxhash64("doc_id", "lang", "text").alias("_hash"))
    every = saved(rows.select("_lang", "_hash").distinct(), "language-rows")
    counts = every.groupBy(F.col("_lang").alias("_l")).agg(F.count("*").alias("_n"))
    few = F.pmod("_hash", F.lit(1 << 30)) * F.col("_n") < float(2 * per_language + 50) * (1 << 30)
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(F.pmod("_hash", F.lit(1 << 30)), "_hash"))
    ranked = every.join(counts, F.col("_lang") == F.col("_l")).where(few).withColumn("_rank", rank).where(F.col("_rank") <= per_language)
    chosen = saved(ranked.orderBy("_rank", "_lang").limit(MOST_LEARNED).select(F.col("_hash").alias("_h"), "_rank"), "language-chosen")

    def grams(batches):
        for batch in batches:
            sets, kept, at = [], [], 0
            for _, _, data, offsets in text_chunks(batch.column(0)):
                for codes, has_letter in ngram_codes(data, offsets):
                    if has_letter:
                        sets.append(np.unique(codes).astype("<i4").tobytes())
                        kept.append(at)
                    at += 1
            take = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in (1, 2, 3)), pa.array(sets, pa.binary())], names=["lang", "rank", "hash", "grams"])

    # at most MOST_LEARNED hashes are broadcast; a repeated row is made one where it is, before its text moves
    sample = rows.join(F.broadcast(chosen), F.col("_hash") == F.col("_h")).groupBy("_hash").agg(F.first("text").alias("text"), F.first("_lang").alias("lang"), F.first("_rank").alias("rank"))
    found = saved(sample.select("text", "lang", "rank", "_hash").mapInArrow(grams, "lang string, rank int, hash long, grams binary"), "language-grams")
    sizes = sorted((r[0], r[1], r[2], r[3]) for r in found.select("rank", "lang", "hash", F.length("grams")).collect())
    total, kept = 0, []
    for *_, row, size in sizes:
        total += size // 4
        if kept and total > MOST_CODES:
            break
        kept.append(row)
    back = found.join(F.broadcast(docs.sparkSession.createDataFrame([(h,) for h in kept], "_h long")), F.col("hash") == F.col("_h"), "left_semi")
    back = sorted(tuple(r) for r in back.select("lang", "hash", "grams").collect())
    return fit([np.frombuffer(r[2], "<i4") for r in back], [r[0] for r in back])


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (0 to 1) of every whole text; no shuffle, and texts are never cut.

    `und` with score 0 if the text is null or has no letter, or nothing was learned. Of equal scores the first language in
    alphabetical order wins. Columns of docs named lang_pred or score are replaced. Scores are batched matrix products:
    (batch x codes) . (codes x landmarks) . (landmarks x languages).
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)  # LANDMARKS x codes numbers: bounded by the parameters

    def run(batches):
        own = shared.value
        flags = np.zeros(N_CODES, bool)
        for batch in batches:
            best, score = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            if own is not None:
                rows = max(1, 4_000_000 // max(1, len(own.codes)))
                present, sizes, held = np.zeros((rows, len(own.codes)), np.float32), np.zeros(rows, np.float32), []

                def flush(present=present, sizes=sizes, held=held, best=best, score=score):
                    if held:
                        best[held], score[held] = own.predict(present[: len(held)], sizes[: len(held)])
                        held.clear()

                at = 0
                for _, _, data, offsets in text_chunks(batch.column(names.index(text))):
                    for codes, has_letter in ngram_codes(data, offsets):
                        if has_letter:
                            flags[codes] = True
                            present[len(held)] = flags[own.codes]
                            sizes[len(held)] = np.count_nonzero(flags)
                            flags[codes] = False
                            held.append(at)
                            if len(held) == rows:
                                flush()
                        at += 1
                flush()
            labels = pa.array([own.languages[b] if b >= 0 else UNDETERMINED for b in best.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, labels, pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(run, docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema)
