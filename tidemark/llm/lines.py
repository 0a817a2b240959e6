"""Cross-site line removal: HyperLogLog sketches of the sites of each line, exact counts where the sketch can't decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

#: A line is boilerplate if it occurs on at least so many distinct sites.
MIN_SITES = 5
#: 4096 registers: a standard error of about 1.3 %; estimates within four of those (and a half) of the limit are counted exactly.
LOG2_REGISTERS, MARGIN = 12, 0.055
_WORD = r"[^\x20\x09-\x0D]"
_BLANKS = " \t\r\x0b\x0c"


def _occurrences(docs: DataFrame, site: str) -> DataFrame:
    """_d, _t (the document), _pos, _h1, _h2 (the line, without blanks at its ends), _site, of each line with a word."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)))
    # the text's hash before its lines are parted, else it would be made again for each line
    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_t"), _site(site), lines.alias("_lines"))
    rows = texts.select("_d", "_t", "_site", F.posexplode("_lines").alias("_pos", "_line"))
    return rows.where(F.col("_line").rlike(_WORD)).select("_d", "_t", "_pos", "_site", F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(1), "_line").alias("_h2"))


def _site(site: str) -> Column:
    """Null is a site of its own."""
    return F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("n")).alias("_site")


def _candidates(occurrences: DataFrame, min_sites: int) -> DataFrame:
    """_h1, _h2, _sites (estimated), _first (the first place: document, position) of each line that may be on min_sites sites.

    One HyperLogLog sketch a line takes its occurrences' sites where the rows are, and sketches of a line are merged: what
    moves is one row for each line of a task, however often the line occurs and on however many sites.
    """
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LOG2_REGISTERS))).alias("_sites")
    spread = occurrences.groupBy("_h1", "_h2").agg(sketch, F.min(F.struct("_d", "_t", "_pos")).alias("_first"))
    return saved(spread.where(F.col("_sites") >= min_sites * (1 - MARGIN) - 0.5), "line-spread")


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> tuple[DataFrame, DataFrame]:
    """The lines on at least min_sites distinct sites (_h1, _h2, _first), and the occurrences of the lines that were near or over.

    Sketches of all lines come first. Only where the estimate is near the limit, within four standard errors and a half,
    distinct sites are counted. Further from it a sketch decides; that one is more than four standard errors off, on the
    wrong side, has a chance of about 3e-5 for a line whose sites are just beyond the margin, and less for others.
    """
    occurrences = _occurrences(docs, site)
    spread = _candidates(occurrences, min_sites)
    rows = saved(occurrences.join(spread.select("_h1", "_h2"), ["_h1", "_h2"], "left_semi"), "line-occurrences")
    near = F.col("_sites") <= min_sites * (1 + MARGIN) + 0.5
    exact = rows.join(spread.where(near).select("_h1", "_h2"), ["_h1", "_h2"], "left_semi").groupBy("_h1", "_h2", "_site").agg(F.lit(1).alias("_one"))
    exact = exact.groupBy("_h1", "_h2").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_sites).select("_h1", "_h2")
    found = spread.where(~near).unionByName(spread.join(exact, ["_h1", "_h2"], "left_semi")).drop("_sites")
    return saved(found, "line-boilerplate"), rows


def remove_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """docs with text without boilerplate lines, and lines_removed, lines_left (lines with a word).

    The first place of each boilerplate line (smallest doc_id, then position) keeps it, so nothing vanishes from the
    corpus. Null and empty texts stay as they are; lines without a word stay and are never counted; a null site is a site
    of its own; rows that are equal in doc_id and text count as one document; an empty table gives an empty table. Columns of
    docs named lines_removed or lines_left are replaced, all others stay. Texts are shuffled at most once, for the last
    join, by document.
    """
    docs = docs.drop("lines_removed", "lines_left")
    names = docs.columns
    found, rows = boilerplate(docs, site, min_sites)
    hits = rows.drop("_site").join(found, ["_h1", "_h2"]).where(F.struct("_d", "_t", "_pos") != F.col("_first"))
    # by document: as many positions as it has lines
    hits = hits.groupBy("_d", "_t").agg(F.collect_set("_pos").alias("_gone"))
    whole = docs.select(F.struct(*names).alias("_doc"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    joined = whole.join(hits, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_t")), "left")
    text = F.col("_doc")["text"]
    lines = F.split(text, "\n")
    # a mark for each line up to the last that goes, made from the distances between those that go: linear in the lines
    order = F.sort_array("_gone")
    before = F.concat(F.array(F.lit(-1)), F.slice(order, 1, F.size(order) - 1))
    marks = F.array_join(F.zip_with(order, before, lambda a, b: F.concat(F.repeat(F.lit("0"), a - b - 1), F.lit("1"))), "")
    kept = F.array_join(F.zip_with(lines, F.split(marks, ""), lambda x, gone: F.when(gone == "1", F.lit(None)).otherwise(x)), "\n")
    worded = F.size(F.filter(F.coalesce(lines, F.array().cast("array<string>")), lambda x: x.rlike(_WORD)))
    gone = F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone"))
    out = {"text": F.when(F.col("_gone").isNull(), text).otherwise(kept)}
    return joined.select(*(out.get(c, F.col("_doc")[c]).alias(c) for c in names), gone.cast("long").alias("lines_removed"), (worded - gone).cast("long").alias("lines_left"))


def line_dedup_digest(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, lines_removed, lines_left, text_md5 of what is left of every document."""
    out = remove_lines(docs.select("doc_id", "text", site), site, min_sites)
    return out.select("doc_id", "lines_removed", "lines_left", F.md5(F.col("text").cast("binary")).alias("text_md5"))


DIGEST_SQL = r"""
WITH lines AS (
  SELECT doc_id, hash(text) AS t, coalesce('s' || source, 'n') AS site, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS raw
  FROM documents WHERE text IS NOT NULL
), worded AS (
  SELECT doc_id, t, site, pos, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM lines WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')
), spread AS (
  SELECT line, min((doc_id, t, pos)) AS place FROM worded GROUP BY line HAVING count(DISTINCT site) >= 5
), gone AS (
  SELECT DISTINCT w.doc_id, w.t, w.pos FROM worded w JOIN spread s USING (line) WHERE (w.doc_id, w.t, w.pos) <> s.place
), left_lines AS (
  SELECT l.doc_id, l.t, string_agg(l.raw, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text, count(g.pos) AS removed,
    count(*) FILTER (WHERE g.pos IS NULL AND regexp_matches(l.raw, '[^\x20\x09-\x0D]')) AS remaining
  FROM (SELECT DISTINCT doc_id, t, pos, raw FROM lines) l LEFT JOIN gone g USING (doc_id, t, pos) GROUP BY l.doc_id, l.t
)
SELECT d.doc_id, coalesce(x.removed, 0) AS lines_removed, coalesce(x.remaining, 0) AS lines_left, md5(CASE WHEN x.removed > 0 THEN coalesce(x.text, '') ELSE d.text END) AS text_md5
FROM documents d LEFT JOIN left_lines x ON d.doc_id IS NOT DISTINCT FROM x.doc_id AND hash(d.text) = x.t
"""
