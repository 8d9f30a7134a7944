"""Spans of documents covered by windows that occur before, exactly and without all windows in one shuffle.

1. A bounded sketch counts anchors (windows.py); runs whose anchor is alone are dropped.
2. Within a record batch, all but the first of equal runs are settled at once; the rest is
   dealt by anchor. Equal runs are settled there too. Where runs of one anchor differ, one
   of each content goes on.
3. Those runs fetch their content from their documents, again by anchor, and their windows
   are compared exactly.

Anchors of very common passages are recognised in a bounded sample of documents and their
runs taken window by window, so that neither their copies (settled before the shuffle) nor
their surroundings meet in one task. A missed one costs time, not results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .common import batches, settle, texts
from .windows import SLICE_BYTES, mix, repeated_windows, runs, slices, units_of

#: Documents read to find common anchors, and the share of them that makes an anchor common.
SAMPLE_DOCUMENTS = 20_000
COMMON_SHARE = 0.005
_FLUSH = 400_000


@dataclass(frozen=True)
class Search:
    """What a window is and which earlier occurrence counts.

    words: units are words, else bytes. across: only a window that starts in another
    document counts, else one earlier in the same document counts too.
    """

    length: int
    gram: int
    words: bool
    across: bool
    step: int = 1

    def document(self, key: np.ndarray) -> np.ndarray:
        return key // self.step


def _slices_of(batch: pa.RecordBatch, search: Search):
    """Document keys, units and offsets for groups of the batch's documents, in order of their keys."""
    keys = batch.column("doc_key").to_numpy(zero_copy_only=False)
    order = np.argsort(keys, kind="stable")
    if (order[1:] < order[:-1]).any():
        batch, keys = batch.take(pa.array(order)), keys[order]
    buf, offsets = texts(batch.column("text"))
    for i, j in slices(buf, offsets):
        part = offsets[i:j + 1]
        yield keys[i:j], *units_of(buf[part[0]:part[-1]], part - part[0], search.words)


def _runs_of(batch: pa.RecordBatch, search: Search, hot: np.ndarray | None = None):
    for keys, units, offsets in _slices_of(batch, search):
        key, content, start, n = runs(units, offsets, search.length, search.gram, hot)
        doc = np.searchsorted(offsets, start, "right") - 1
        yield key, content, keys[doc], start - offsets[doc], n


def _anchors(search: Search):
    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for key, *_ in _runs_of(batch, search):
            yield key
    return keys_of


def common_anchors(docs: DataFrame, rows: int, search: Search) -> np.ndarray:
    """Sorted anchors that many of the sampled documents hold in different surroundings."""
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, rows))
    least = max(32, int(min(rows, SAMPLE_DOCUMENTS) * COMMON_SHARE))

    def seen(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            found = [*_runs_of(batch, search)]
            if found:
                key, content = (np.concatenate(x) for x in [*zip(*found)][:2])
                _, one = np.unique(key ^ mix(content), return_index=True)
                values, counts = np.unique(key[one], return_counts=True)
                many = counts > 1
                yield from batches({"key": values[many].view(np.int64), "n": counts[many]})

    sample = docs if share == 1 else docs.sample(share, seed=7)
    found = (sample.mapInArrow(seen, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= least).select("key").collect())
    return np.sort(np.array([r["key"] for r in found], np.int64).view(np.uint64))


def _settle(key, content, doc, start, n, search: Search):
    """Split runs into open ones and spans that repeat an earlier run. Rows must be in order of (doc, start)."""
    order = np.argsort(key ^ mix(content), kind="stable")
    key, content, doc, start, n = (x[order] for x in (key, content, doc, start, n))
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0)) if len(key) else np.zeros(0, np.int64)
    again = ~fresh
    if search.across:
        again &= search.document(doc) != search.document(doc[first])
    spans = merged(doc[again], start[again], start[again] + n[again] - 1 + search.length)
    keep = ~again
    return (key[keep], content[keep], doc[keep], start[keep], n[keep]), spans


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Spans with those of a document that touch or overlap made one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    # One running maximum for all documents: each next document is lifted above the one before.
    lift = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + lift)
    fresh = np.concatenate([[True], (start + lift)[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(doc) - 1]])
    return doc[fresh], start[fresh], (reach - lift)[last]


_RUN = "key long, content long, doc_key long, start long, n long, open boolean"


def _rows(key, content, doc, start, n, open_: bool):
    return batches({"key": key.view(np.int64), "content": content.view(np.int64), "doc_key": doc, "start": start, "n": n,
                    "open": np.full(len(key), open_)})


def _span_rows(doc, start, end):
    """Settled spans travel with the runs, spread by document and place."""
    key = mix(doc.astype(np.uint64) + start.astype(np.uint64))
    return _rows(key, np.zeros(len(key), np.uint64), doc, start, end, False)


def _emit(search: Search, counted, hot):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            found = []
            for row in _runs_of(batch, search, hot.value):
                many = counted.value.reached(row[0])
                if len(hot.value):
                    many |= row[4] == 1  # single windows of common anchors carry keys of their own
                found.append([x[many] for x in row])
            if not found:
                continue
            open_, spans = _settle(*map(np.concatenate, zip(*found)), search)
            yield from _rows(*open_, True)
            yield from _span_rows(*spans)
    return run


def chunks_by_key(incoming: Iterator[pa.RecordBatch], flush: int = _FLUSH) -> Iterator[pa.Table]:
    """Tables of whole keys from batches sorted by key, each of about `flush` rows."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in incoming:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= flush:
            whole = pa.Table.from_batches(held)
            keys = whole.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield whole.slice(0, cut)
                held = whole.slice(cut).combine_chunks().to_batches()
                rows -= cut
    if held:
        yield pa.Table.from_batches(held)


_PART = "open boolean, key long, doc_key long, start long, end long"


def _compare_runs(search: Search):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks_by_key(incoming):
            key, content, doc, start, n, open_ = (rows.column(i).to_numpy() for i in range(6))
            done = ~open_
            spans = [merged(doc[done], start[done], n[done])]
            key, content, doc, start, n = (x[open_] for x in (key.view(np.uint64), content.view(np.uint64), doc, start, n))
            order = np.lexsort((start, doc))
            (key, content, doc, start, n), more = _settle(*(x[order] for x in (key, content, doc, start, n)), search)
            spans.append(more)
            for part in spans:
                yield from batches({"open": np.zeros(len(part[0]), bool), "key": np.zeros(len(part[0]), np.int64),
                                    "doc_key": part[0], "start": part[1], "end": part[2]})
            # Several contents of one anchor: their windows have to be compared.
            order = np.lexsort((content, key))
            key, content, doc, start, n = (x[order] for x in (key, content, doc, start, n))
            if len(key):
                fresh = np.concatenate([[True], key[1:] != key[:-1]])
                label = np.cumsum(fresh) - 1
                other = np.concatenate([[False], (key[1:] == key[:-1]) & (content[1:] != content[:-1])])
                differ = (np.bincount(label, other) > 0)[label]
                yield from batches({"open": np.ones(int(differ.sum()), bool), "key": key[differ].view(np.int64),
                                    "doc_key": doc[differ], "start": start[differ],
                                    "end": (start + n - 1 + search.length)[differ]})
    return run


_CONTENT = "key long, doc_key long, start long, units binary"


def _fetch(search: Search):
    """Cut the content of the wanted runs out of their documents."""
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            buf, offsets = texts(batch.column("text"))
            docs = batch.column("doc_key").to_pylist()
            key, doc, start, data, size = [], [], [], [], 0
            for i, wanted in enumerate(batch.column("wanted").to_pylist()):
                text = buf[offsets[i]:offsets[i + 1]]
                units, _ = units_of(text, np.array([0, len(text)]), search.words)
                for w in wanted:
                    key.append(w["key"])
                    doc.append(docs[i])
                    start.append(w["start"])
                    data.append(units[w["start"]:w["end"]].tobytes())
                    size += len(data[-1])
                if size >= SLICE_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(data, pa.binary())],
                        ["key", "doc_key", "start", "units"])
                    key, doc, start, data, size = [], [], [], [], 0
    return run


def _compare_windows(search: Search):
    kind = np.uint64 if search.words else np.uint8

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks_by_key(incoming, 20_000):
            key, doc, start = (rows.column(i).to_numpy() for i in range(3))
            data = rows.column(3).combine_chunks().cast(pa.large_binary())
            where = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
            units = np.frombuffer(data.buffers()[2], np.uint8)[where[0]:where[-1]].view(kind)
            where = (where - where[0]) // units.itemsize
            n = np.diff(where) - search.length + 1
            run_of = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(run_of)) - np.repeat(np.cumsum(n) - n, n)
            found = repeated_windows(units, where[:-1][run_of] + step, np.unique(key, return_inverse=True)[1][run_of], search.length)
            live = np.flatnonzero(found >= 0)
            doc, start = doc[run_of[live]], start[run_of[live]] + step[live]
            order = np.lexsort((start, doc, found[live]))
            label, doc, start = found[live][order], doc[order], start[order]
            fresh = np.ones(len(label), bool)
            fresh[1:] = label[1:] != label[:-1]
            again = ~fresh
            if search.across and len(label):
                first = np.maximum.accumulate(np.where(fresh, np.arange(len(label)), 0))
                again &= search.document(doc) != search.document(doc[first])
            d, s, e = merged(doc[again], start[again], start[again] + search.length)
            yield from batches({"doc_key": d, "start": s, "end": e})
    return run


def _holders(sketch_):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            keys = mix(batch.column("doc_key").to_numpy().astype(np.uint64))
            yield batch.filter(pa.array(sketch_.value.reached(keys)))
    return run


def _doc_keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield mix(batch.column("doc_key").to_numpy().astype(np.uint64))


def repeated_spans(docs: DataFrame, search: Search, sketch_rows: int = 1, most_bits: int = sketch.MAX_BITS) -> DataFrame:
    """(doc_key, spans): unit ranges of each document that repeated windows cover; no row where none does.

    docs has doc_key and text. Spans may overlap one another.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_key", "text")
    size = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    expected = size["bytes"] // (6 if search.words else 1) * 2 // (search.length - search.gram + 2)
    counted = spark.sparkContext.broadcast(
        sketch.build(docs, _anchors(search), sketch.bits_for(expected, most_bits), sketch_rows))
    hot = spark.sparkContext.broadcast(common_anchors(docs, size["rows"], search))

    parts = settle(
        docs.mapInArrow(_emit(search, counted, hot), _RUN)
        .repartition(F.col("key")).sortWithinPartitions("key")
        .mapInArrow(_compare_runs(search), _PART), "runs", "open")
    counted.destroy()
    hot.destroy()
    open_ = parts.where(F.col("open"))
    wanted = open_.groupBy("doc_key").agg(F.collect_list(F.struct("key", "start", "end")).alias("wanted"))
    holders = spark.sparkContext.broadcast(
        sketch.build(open_.select("doc_key"), _doc_keys, sketch.bits_for(size["rows"], most_bits), 1, 1))
    windows = (
        docs.mapInArrow(_holders(holders), docs.schema)
        .join(wanted, "doc_key").mapInArrow(_fetch(search), _CONTENT)
        .repartition(F.col("key")).sortWithinPartitions("key")
        .mapInArrow(_compare_windows(search), "doc_key long, start long, end long")
    )
    spans = parts.where(~F.col("open")).select("doc_key", "start", "end").union(windows)
    return spans.groupBy("doc_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def with_spans(docs: DataFrame, search: Search, cut: Callable, schema: str, sketch_rows: int = 1,
               most_bits: int = sketch.MAX_BITS, key: str = "doc_key") -> DataFrame:
    """Apply cut(text bytes, list of (start, end)) to every document; its values follow the document's other columns."""
    spans = repeated_spans(docs, search, sketch_rows, most_bits)
    joined = docs.join(spans, "doc_key", "left")
    kept = [c for c in docs.columns if c not in ("doc_key", "text")]
    added = [x.split()[0] for x in schema.split(",")]

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            buf, offsets = texts(batch.column("text"))
            spans_of = batch.column("spans").to_pylist()
            at, size = 0, 0
            made: list[tuple] = []
            for i in range(batch.num_rows):
                text = buf[offsets[i]:offsets[i + 1]].tobytes()
                found = sorted((s["start"], s["end"]) for s in spans_of[i] or ())
                joined_up: list[list[int]] = []
                for a, b in found:
                    if joined_up and a <= joined_up[-1][1]:
                        joined_up[-1][1] = max(b, joined_up[-1][1])
                    else:
                        joined_up.append([a, b])
                made.append(cut(text, joined_up))
                size += len(text)
                if size >= 8 * SLICE_BYTES or i == batch.num_rows - 1:
                    part = batch.slice(at, i + 1 - at)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in kept), *(pa.array(list(v)) for v in zip(*made))], [*kept, *added])
                    made, at, size = [], i + 1, 0
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept)
    return joined.mapInArrow(run, f"{types}, {schema}")
