"""The corpus pipeline: documents pass its stages in turn; each result is written and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last return the columns of
documents, whatever other columns docs has and however they are named. Rows are told apart by themselves, not by doc_id: null
and shared doc_ids are rows as any others, and equal rows are rows of their own. A stage gives an empty table for an empty
table. ORACLE_SQL is None, as SQL can express neither the classifier nor the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.common import bounded_batches, documents, key_crc32, saved
from tidemark.llm.jaccard import near_duplicates
from tidemark.llm.lines import remove_lines
from tidemark.llm.mixing import mix_documents
from tidemark.llm.packing import pack_documents
from tidemark.llm.queries import tokenizer_file

LEAST_SCORE = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score LEAST_SCORE or more stay. The model learns from labelled rows with crc32(doc_id) mod 4 not 2.

    If nothing can be learned there (no label, none of quality 1, or no text of one), no document is judged and all stay.
    Null texts are scored as empty ones; equal rows are judged alike; rows with a null doc_id are judged, never learned from.
    """
    bounded_batches(spark)
    model = quality.learn(docs.select("doc_id", "text", "lang"), spark.read.parquet(f"{sf_dir}/labels.parquet"), key_crc32("doc_id") % 4 != 2)
    if model is None:
        return docs
    score = _free(docs, "score")
    return quality.scored(docs, model, into=score).where(F.col(score) >= LEAST_SCORE).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on 5 sites or more go, but for their first place; a document goes if nothing else was in it. n_chars follows.

    Null and empty texts stay. Rows equal in doc_id and text count as one document, and are cut alike.
    """
    names = docs.columns
    as_one = docs.select("doc_id", "text", "source", F.struct(*(c for c in names if c != "text")).alias("doc"))
    out = remove_lines(as_one)
    out = out.where((F.col("lines_removed") == 0) | (F.col("lines_left") > 0))
    new = {"text": F.col("text")}
    if "n_chars" in names:
        changed = F.when(F.col("lines_removed") > 0, F.char_length("text")).otherwise(F.col("doc.n_chars"))
        new["n_chars"] = changed.cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("doc")[c]).alias(c) for c in names))


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column has."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _with_row(docs: DataFrame) -> DataFrame:
    """doc (the row as it is), row (a number of its own), written."""
    return saved(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "pipeline-rows")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest doc_id stays, once; a null doc_id comes last.

    Rows are told apart by a number of their own, so rows of null or shared doc_ids with different, unlinked texts all
    stay. Among equal doc_ids the least hash of the whole row decides: reruns agree. Rows without words all stay.
    """
    rows = _with_row(docs)
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), "doc.text")).select(F.col("doc_id").alias("row"), "component_id")
    ranked = rows.select("row", F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"), F.xxhash64("doc").alias("hash"), "row").alias("rank"))
    stay = found.join(ranked.hint("merge"), "row").groupBy("component_id").agg(F.min("rank").getField("row").alias("row"))
    # both sides grow with the documents: the same join at every size
    return rows.join(saved(stay.select("row"), "pipeline-groups").hint("merge"), "row", "left_semi").select("doc.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it: 0 to 3. Null and shared doc_ids are documents of their own.

    Documents without words, null texts among them, are taken at the rate of their source too.
    """
    rows = _with_row(docs)
    # blocks are dealt by the hash of the whole row, which spreads null and shared doc_ids, and by the row's number, which spreads rows
    # that are equal throughout: those are interchangeable, so only how many copies they get together depends on it
    mixed = mix_documents(rows.select(F.xxhash64("doc").alias("doc_id"), "doc.text", "doc.source", "row"), keep=("row",))
    taken = saved(mixed, "pipeline-mix").where("copies > 0").select("row", F.sequence(F.lit(1), F.col("copies").cast("int")).alias("times"))
    return rows.join(taken.hint("merge"), "row").select("doc", F.explode("times").alias("time")).select("doc.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens at most: a row for each piece of a document. A null or empty text is its end id alone."""
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-stage{k}")
    return docs
