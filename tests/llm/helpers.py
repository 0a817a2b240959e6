from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    """Rows of documents; the rest of the columns is filled in."""
    full = [(*r, *([None] * (4 - len(r))), len(r[1] or "")) if "n_chars" in schema else r for r in rows]
    return spark.createDataFrame(full, schema).repartition(3)
