"""Benchmark decontamination with an FM-index of every training shard.

A shard is a MB of neighbouring documents in a task. Its words become symbols of the
benchmark's vocabulary; stretches of benchmark words long enough to hold a phrase, that is
all places where one can occur, are indexed: suffix array, Burrows-Wheeler transform,
wavelet-tree ranks and sampled positions. Every phrase is searched backward in every index,
its occurrences located, and the spans of a document merged.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased. A phrase is `length`
consecutive words of an item, or all words of a shorter one.

The benchmark is taken in blocks of at most BLOCK_BYTES of text on average. One block at a
time is broadcast: the documents pass it without a shuffle, and where another one follows,
they are written with their hits and the block is given up.

 - A missing or empty text has no words; an item without words occurs nowhere.
 - Rows are judged one by one: repeated doc_ids or missing ones keep a row each. Item ids
   are compared as text, repeated ones count once, a missing one is the empty text.
 - An empty benchmark hits nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table, texts
from .fm_index import FMIndex
from .op10_jaccard_join import LOWER
from .windows import slices, word_units

LENGTH = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 1 << 20

#: Bytes that are no part of a word, before A-Z are lower-cased.
NO_WORD = np.zeros(256, bool)
NO_WORD[0x00:0x30] = NO_WORD[0x3A:0x41] = NO_WORD[0x5B:0x61] = NO_WORD[0x7B:0x80] = True


def _words(buf: np.ndarray, offsets: np.ndarray):
    return word_units(buf, offsets, NO_WORD, LOWER)


class Phrases:
    """Distinct phrases of a block of items as vocabulary symbols, and the items of each."""

    def __init__(self, items: list[tuple[str, str]], length: int):
        found: dict[tuple, set[str]] = {}
        vocabulary: set[int] = set()
        for name, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            words = _words(data, np.array([0, len(data)]))[0].tolist()
            vocabulary.update(words)
            for i in range(max(1, len(words) - length + 1) if words else 0):
                found.setdefault(tuple(words[i:i + length]), set()).add(name)
        self.vocabulary = np.array(sorted(vocabulary), np.uint64)
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for size in {len(p) for p in found}:
            rows = [p for p in found if len(p) == size]
            symbols = np.searchsorted(self.vocabulary, np.array(rows, np.uint64)) + 1
            self.by_length[size] = symbols, [sorted(found[p]) for p in rows]
        self.shortest = min(self.by_length, default=0)

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbol of each word, 0 where the vocabulary has none."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)


def occurrences(phrases: Phrases, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """(length, first word of each occurrence, items) of every phrase in a shard; documents are word ranges."""
    if not phrases.by_length or not len(words):
        return
    symbols = phrases.symbols(words)
    # Stretches of known words within a document.
    known = symbols > 0
    first = known.copy()
    first[1:] &= ~known[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(words))]
    first[edge] = known[edge]
    begin = np.flatnonzero(first)
    gap = np.flatnonzero(np.concatenate([~known, [True]]))
    stop = gap[np.searchsorted(gap, begin)]
    stop = np.minimum(stop, np.concatenate([begin[1:], [len(words)]]))
    wide = stop - begin >= phrases.shortest
    begin, size = begin[wide], (stop - begin)[wide]
    if not len(begin):
        return
    # The indexed text: stretches with one separator each; `home` leads back to the shard's words.
    home = np.repeat(begin, size + 1) + np.arange((size + 1).sum()) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    text = symbols[np.minimum(home, len(words) - 1)]
    text[np.cumsum(size + 1) - 1] = 0
    index = FMIndex(text, len(phrases.vocabulary))
    for length, (rows, items) in phrases.by_length.items():
        low, high = index.search(rows)
        hit = np.flatnonzero(high > low)
        if len(hit):
            n = high[hit] - low[hit]
            place = home[index.locate(np.repeat(low[hit] - np.cumsum(n) + n, n) + np.arange(n.sum()))]
            for phrase, at in zip(hit, np.split(place, np.cumsum(n)[:-1])):
                yield length, at, items[phrase]


def _search(phrases, first: bool):
    """Add to each row its hit word spans (flat, merged), the bytes they cover, its items, and its number of words."""
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            text = batch.column("text")
            buf, offsets = texts(text)
            for i, j in slices(buf, offsets, SHARD_BYTES):
                part = offsets[i:j + 1]
                words, at, begin, end = _words(buf[part[0]:part[-1]], part - part[0])
                rows = batch.slice(i, j - i)
                spans: list[list[list[int]]] = [[] for _ in range(j - i)]
                items: list[set[str]] = [set() for _ in range(j - i)]
                for length, starts, names in occurrences(phrases.value, words, at):
                    for doc, start in zip((np.searchsorted(at, starts, "right") - 1).tolist(), starts.tolist()):
                        spans[doc].append([start - int(at[doc]), start - int(at[doc]) + length])
                        items[doc].update(names)
                if not first:
                    for doc, (had, names) in enumerate(zip(rows.column("spans").to_pylist(), rows.column("items").to_pylist())):
                        spans[doc] += [had[k:k + 2] for k in range(0, len(had), 2)]
                        items[doc].update(names)
                flat, cover = [], []
                for doc, own in enumerate(spans):
                    joined: list[list[int]] = []
                    for a, b in sorted(own):
                        if joined and a <= joined[-1][1]:
                            joined[-1][1] = max(b, joined[-1][1])
                        else:
                            joined.append([a, b])
                    base, byte = int(at[doc]), int(part[doc] - part[0])
                    flat.append([x for span in joined for x in span])
                    cover.append([x for a, b in joined for x in (int(begin[base + a]) - byte, int(end[base + b - 1]) - byte)])
                kept = [c for c in batch.schema.names if c not in ("n_words", "spans", "cover", "items")]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in kept), pa.array(np.diff(at)), pa.array(flat, pa.list_(pa.int64())),
                     pa.array(cover, pa.list_(pa.int64())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    [*kept, "n_words", "spans", "cover", "items"])
    return run


def hits(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with n_words, spans and cover (merged hits as word and as byte ranges, flat) and items (item ids as text).

    Columns of these names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "spans", "cover", "items")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    added = "n_words long, spans array<long>, cover array<long>, items array<string>"
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        phrases = spark.sparkContext.broadcast(Phrases([tuple(r) for r in rows], length))
        docs = docs.mapInArrow(_search(phrases, block == 0), f"{types}, {added}")
        if block + 1 < blocks:
            docs = settle(docs, "hits")
            phrases.destroy()
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """Documents without their hit passages; columns stay, text and n_chars change.

    What stands around a passage is joined by one space. A document of which no word is left goes.
    """
    columns = docs.columns
    own = docs.select(F.struct(*columns).alias("row"), F.col("text").cast("string").alias("text"))
    found = hits(own, benchmark, length)

    def cut(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            buf, offsets = texts(batch.column("text"))
            out, left = [], []
            for i, (cover, spans, n) in enumerate(zip(batch.column("cover").to_pylist(), batch.column("spans").to_pylist(),
                                                      batch.column("n_words").to_pylist())):
                text = buf[offsets[i]:offsets[i + 1]].tobytes()
                edges = [0, *cover, len(text)]
                parts = [text[a:b].strip() for a, b in zip(edges[::2], edges[1::2])]
                out.append((b" ".join(p for p in parts if p) if cover else text).decode())
                left.append(not cover or n > sum(spans[1::2]) - sum(spans[::2]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string()), pa.array(left)], ["row", "cut", "left_over"])

    cut_rows = found.mapInArrow(cut, f"row {own.schema['row'].dataType.simpleString()}, cut string, left_over boolean")
    changed = {"text": F.when(F.col("row.text").isNotNull(), F.col("cut"))}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(F.col("row.text").isNull() | (F.col("row.text") == F.col("cut")), F.col("row.n_chars")).otherwise(F.length("cut")).cast(docs.schema["n_chars"].dataType)
    return cut_rows.where("left_over").select(*(changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in columns))


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = hits(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
