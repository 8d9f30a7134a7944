"""Substring dedup over words with a count-min prefilter.

Every partition adds its windows to a count-min sketch; the merged sketch overestimates how
often a window occurs (by its anchor, see windows.py, which occurs at least as often), so a
window that repeats is always estimated repeated. The second pass groups exactly those.

Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A window is `length` consecutive words of one
document. A word goes if a window that covers it also starts in a document with a smaller
doc_id; windows are judged on the input.

 - A missing or empty text, or one shorter than a window, keeps all its words (perhaps none).
 - Rows that repeat a doc_id are one document as far as "smaller" goes: they never
   remove each other's words. A missing doc_id is smaller than any other.
 - An empty table gives an empty result. Further columns of the input are not carried.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from .common import keyed, table
from .repeats import Search, with_spans

LENGTH, GRAM, SKETCH_ROWS = 13, 6, 2


def _kept_words(text: bytes, spans: list[list[int]]) -> tuple[list[bytes], int]:
    words = text.split()
    total = len(words)
    for a, b in reversed(spans):
        del words[a:b]
    return words, total


def _cut_text(text: bytes, spans) -> tuple[int, int, str]:
    words, total = _kept_words(text, spans)
    return total, total - len(words), b" ".join(words).decode()


def _cut_digest(text: bytes, spans) -> tuple[int, int, str]:
    words, total = _kept_words(text, spans)
    return total, total - len(words), hashlib.sha256(b" ".join(words)).hexdigest()


def substring_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space (or their SHA-256)."""
    rows, step = keyed(docs)
    search = Search(length, min(gram, length), words=True, across=True, step=step)
    last = "kept_sha256 string" if digest else "text string"
    return with_spans(rows, search, _cut_digest if digest else _cut_text,
                      f"n_words long, n_removed long, {last}", SKETCH_ROWS)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), digest=True)
