"""Suffix-array dedup by a depth-limited radix sort.

The suffixes of all documents are told apart from the most significant digit on, and only
through `length` units. The first digit is the anchor of a suffix's first window
(windows.py), a function of those `length` units that neighbouring suffixes share; a
counting pass over 2**27 digit cells finishes suffixes whose digit is alone. The rest is
dealt by that digit; equal runs of suffixes are settled whole, and the remaining ones are
sorted on by eight bytes (or one word) a pass until they are alone or `length` units deep.
The groups then left are exactly the repeated windows.

A unit goes if a window covering it also starts earlier: in a document with a smaller
doc_id, or further ahead in the same one. Windows never cross documents and are judged on
the input.

 - A missing or empty text, or one shorter than a window, is kept as it is (missing: empty).
 - Rows that repeat a doc_id follow one another in order of their text; the later one's
   windows repeat the earlier one's. A missing doc_id is smaller than any other.
 - An empty table gives an empty result. Further columns pass through suffix_array_text.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keyed, table
from .repeats import Search, with_spans

LENGTH, GRAM = 100, 50
PASSAGE_WORDS, PASSAGE_GRAM = 50, 20


def _kept(text: bytes, spans: list[list[int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    parts.append(text[at:])
    return b"".join(parts)


def _cut_digest(text: bytes, spans) -> tuple[int, int, int, str]:
    kept = _kept(text, spans)
    return len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()


def suffix_array_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the SHA-256 of the bytes kept."""
    rows, step = keyed(docs)
    search = Search(length, min(gram, length), words=False, across=False, step=step)
    return with_spans(rows, search, _cut_digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _cut_words(text: bytes, spans) -> tuple[str, bool]:
    if not spans:
        return text.decode(), True
    words = text.split()
    for a, b in reversed(spans):
        del words[a:b]
    return b" ".join(words).decode(), bool(words)


def suffix_array_text(docs: DataFrame, length: int = PASSAGE_WORDS, gram: int = PASSAGE_GRAM) -> DataFrame:
    """Documents without passages of `length` words or more that stand earlier.

    Columns stay as they are, but for text and n_chars. A text without such a passage is
    unchanged, white space included; else the words left are joined by one space. A document
    nothing of which is left goes.
    """
    rows, step = keyed(docs, whole=True)
    search = Search(length, gram, words=True, across=False, step=step)
    cut = with_spans(rows.drop("doc_id"), search, _cut_words, "cut string, left_over boolean").where(F.col("left_over"))
    had = F.col("row.text").isNotNull()
    changed = {"text": F.when(had, F.col("cut"))}
    if "n_chars" in docs.columns:
        same = ~had | (F.col("row.text") == F.col("cut"))
        changed["n_chars"] = F.when(same, F.col("row.n_chars")).otherwise(F.length("cut")).cast(docs.schema["n_chars"].dataType)
    return cut.select(*(changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup(table(spark, sf_dir, "documents"))
