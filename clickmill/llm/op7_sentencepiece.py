"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

A text becomes a whitespace marker (U+2581) followed by itself with spaces replaced by
markers. Of all ways to cut it into pieces of the vocabulary the one with the highest sum
of log scores is taken, on a tie the one whose last piece begins first. A character that no
piece covers alone costs 10 more than the worst piece and is written as its UTF-8 bytes.
Decoding turns markers into spaces, byte pieces into bytes and drops the first space. A
marker in the text itself is written as bytes, so decoding gives back every text exactly.

A file with merge ranks instead of log scores (byte-pair encoding: whole numbers falling by
one) is read by Zipf's law: the score of rank r is -ln(r + 1) - ln(sum of 1 / (i + 1)).

Pieces have markers at their beginning only, so no piece crosses from a character into a
marker: a text is a row of chunks that are cut on their own. A task cuts each distinct chunk
of a MB once, all chunks in step. The vocabulary is broadcast: MAX_PIECES bounds it.

 - A missing or empty text has no pieces and decodes to the empty text.
 - Rows are treated one by one; repeated or missing ids keep a row each. An empty table
   gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, texts
from .double_array import DoubleArray
from .windows import SLICE_BYTES, range_hashes, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_PIECES = 1_000_000
PENALTY = 10.0
_CELLS = 1 << 20

MARK = "▁".encode()
#: Stands for a marker that the text itself holds; no byte of it occurs in UTF-8.
OWN_MARK = bytes([0xF8, 0xF9, 0xFA])

#: Bytes of the character that begins with a byte; 0 inside one.
WIDTH = np.zeros(256, np.int64)
WIDTH[:0x80], WIDTH[0xC0:0xE0], WIDTH[0xE0:0xF0], WIDTH[0xF0:0xF8], WIDTH[0xF8] = 1, 2, 3, 4, 3


class Pieces:
    """Vocabulary, log scores and trie."""

    def __init__(self, pieces: list[str], scores: np.ndarray, kinds: list[str]):
        """kinds: `normal`, `byte` or `other` (control and unknown pieces, never used) of each piece."""
        if len(pieces) > MAX_PIECES:
            raise ValueError(f"more than {MAX_PIECES} pieces")
        normal = [i for i, kind in enumerate(kinds) if kind == "normal"]
        self.scores = np.asarray(scores, np.float32).copy()
        own = self.scores[normal]
        if len(own) and (own == np.floor(own)).all() and own.min() < -1000:
            rank = np.searchsorted(np.sort(-own), -own)
            self.scores[normal] = -np.log(rank + 1.0) - np.log((1 / np.arange(1, len(own) + 1)).sum())
        self.unknown = np.float32(self.scores[normal].min() - PENALTY) if normal else np.float32(-PENALTY)
        self.trie = DoubleArray({pieces[i].encode(): i for i in normal})
        self.byte = np.zeros(256, np.int64)
        raw = [b""] * len(pieces)
        for i, kind in enumerate(kinds):
            if kind == "byte":
                value = int(pieces[i][3:5], 16)
                self.byte[value], raw[i] = i, bytes([value])
            elif kind == "normal":
                raw[i] = pieces[i].encode().replace(MARK, b" ")
        if kinds.count("byte") < 256:
            raise ValueError("the vocabulary has no byte pieces")
        self.byte[list(OWN_MARK)] = self.byte[list(MARK)]
        self.is_byte = np.array([kind == "byte" for kind in kinds])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        covered = np.zeros(256, bool)
        for i in normal:
            covered[list(pieces[i].encode())] = True
        #: Single-byte characters that no piece holds end a chunk on both sides.
        self.alone = ~covered & (np.arange(256) < 128)
        self.leading = all(MARK not in pieces[i].encode().lstrip(MARK) and "▁" not in pieces[i].lstrip("▁") for i in normal)

    @staticmethod
    def load(path: str = MODEL) -> Pieces:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        kinds = ["byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "normal" for i in range(n)]
        return Pieces([m.id_to_piece(i) for i in range(n)], np.array([m.get_score(i) for i in range(n)]), kinds)

    def cut(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi for rows of bytes, longest first: all piece ids in order, and where each row's begin."""
        rows, wide = data.shape
        best = np.full((rows, wide + 1), -np.inf, np.float32)
        best[:, 0] = 0
        start, piece = np.zeros((rows, wide + 1), np.int32), np.full((rows, wide + 1), -1, np.int32)
        for at in range(wide):
            here = int(np.searchsorted(-sizes, -at, "left"))  # rows longer than `at`
            width = WIDTH[data[:here, at]]
            live = np.flatnonzero((width > 0) & (best[:here, at] > -np.inf))
            states, covered, k = np.zeros(len(live), np.int64), np.zeros(here, bool), 0
            walking = live
            while len(walking):
                inside = sizes[walking] > at + k
                walking, states = walking[inside], states[inside]
                if not len(walking):
                    break
                states = self.trie.step(states, data[walking, at + k].astype(np.int64))
                good = states >= 0
                walking, states = walking[good], states[good]
                k += 1
                found = self.trie.value[states]
                ends = found >= 0
                if ends.any():
                    row, entry = walking[ends], found[ends]
                    covered[row[width[row] == k]] = True
                    score = best[row, at] + self.scores[entry]
                    better = score > best[row, at + k]
                    row, entry = row[better], entry[better]
                    best[row, at + k], start[row, at + k], piece[row, at + k] = score[better], at, entry
            bare = live[~covered[live]]
            if len(bare):
                end = at + width[bare]
                score = best[bare, at] + self.unknown
                better = score > best[bare, end]
                bare, end = bare[better], end[better]
                best[bare, end], start[bare, end], piece[bare, end] = score[better], at, -1
        # Walk back: an unknown character counts one id for each of its bytes.
        order, ids, places, at = np.arange(rows), [], [], sizes.astype(np.int64).copy()
        live = np.flatnonzero(at > 0)
        count = np.zeros(rows, np.int64)
        while len(live):
            end = at[live]
            begin, entry = start[live, end].astype(np.int64), piece[live, end]
            bare = entry < 0
            ids.append(entry[~bare].astype(np.int64))
            places.append((live[~bare], end[~bare]))
            for b in range(int((end - begin)[bare].max()) if bare.any() else 0):
                has = np.flatnonzero(bare & (begin + b < end))
                ids.append(self.byte[data[live[has], begin[has] + b]])
                places.append((live[has], begin[has] + b + 1))
            at[live] = begin
            live = live[begin > 0]
        if not ids:
            return np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
        row, end, ids = np.concatenate([p[0] for p in places]), np.concatenate([p[1] for p in places]), np.concatenate(ids)
        order = np.argsort(row * (wide + 1) + end, kind="stable")
        count = np.bincount(row, minlength=rows)
        return ids[order], np.concatenate([[0], np.cumsum(count)])

    def chunks(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The marked texts end to end, chunk begins and ends, and the document of each chunk."""
        text = bytes(buf)
        sizes = np.diff(offsets)
        had = text.replace(MARK, OWN_MARK) if MARK in text else text
        flat = np.frombuffer(had, np.uint8)
        # One marker before each text that is not empty, and one for each space: three bytes in place of one.
        space = flat == 32
        grow = np.where(space, 3, 1)
        full = sizes > 0
        grown = np.concatenate([[0], np.cumsum(grow)])
        lead = np.cumsum(full) * 3
        doc = np.repeat(np.arange(len(sizes)), sizes)
        place = grown[:-1] + lead[doc]
        total = int(grown[-1] + (lead[-1] if len(lead) else 0))
        out = np.empty(total, np.uint8)
        out[place[~space]] = flat[~space]
        marks = np.concatenate([place[space], (grown[offsets[:-1]] + lead - 3)[full]])
        for k, b in enumerate(MARK):
            out[marks + k] = b
        is_mark = np.zeros(total + 1, bool)
        is_mark[marks] = True
        inner = np.zeros(total + 1, bool)
        for k in range(3):
            inner[marks + k] = True
        first = is_mark.copy()
        if not self.leading:
            first[:] = False
        else:
            first[1:] &= ~inner[:-1]
            alone = np.flatnonzero(self.alone[out])
            first[alone] = True
            first[alone + 1] = True
        first[(grown[offsets[:-1]] + lead - 3)[full]] = True
        begin = np.flatnonzero(first[:-1])
        end = np.concatenate([begin[1:], [total]]) if len(begin) else begin
        starts = np.concatenate([grown[offsets[:-1]] + lead - 3 * full, [total]])
        return out, begin, end, np.searchsorted(starts, begin, "right") - 1

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's begin. buf holds the texts end to end."""
        n = len(offsets) - 1
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
        data, begin, end, doc = self.chunks(buf, offsets)
        key = range_hashes(data, begin, end)
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        size = (end - begin)[first]
        order = np.argsort(-size, kind="stable")
        parts, at = [], 0
        while at < len(order):
            wide = int(size[order[at]])
            pick = order[at:at + max(1, min(_CELLS // wide, 32_768))]
            place = begin[first[pick]][:, None] + np.arange(wide)
            rows = np.where(np.arange(wide) < size[pick][:, None], data[np.minimum(place, len(data) - 1)], 0)
            parts.append(self.cut(rows, size[pick]))
            at += len(pick)
        ids = np.concatenate([p[0] for p in parts])
        count = np.empty(len(order), np.int64)
        where = np.empty(len(order), np.int64)
        lengths = np.concatenate([np.diff(p[1]) for p in parts])
        count[order], where[order] = lengths, np.cumsum(lengths) - lengths
        own = count[inverse]
        total = int(own.sum())
        pick = np.repeat(where[inverse] - np.cumsum(own) + own, own) + np.arange(total)
        return ids[pick], np.concatenate([[0], np.cumsum(np.bincount(doc, own, n).astype(np.int64))])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts end to end, and their offsets."""
        size = np.diff(self.raw_at)[ids]
        pick = np.repeat(self.raw_at[ids] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        ends = np.concatenate([[0], np.cumsum(size)])[offsets]
        keep = np.ones(len(pick), bool)
        full = np.diff(ends) > 0
        keep[ends[:-1][full]] = False  # the first marker's space
        return self.raw[pick][keep], ends - np.concatenate([[0], np.cumsum(full)])


def _digests(pieces):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            buf, offsets = texts(batch.column("text"))
            for i, j in slices(buf, offsets, SLICE_BYTES):
                part = offsets[i:j + 1]
                ids, at = pieces.value.encode(buf[part[0]:part[-1]], part - part[0])
                back, ends = pieces.value.decode(ids, at)
                small = ids.astype("<u4")
                fallback = np.concatenate([[0], np.cumsum(pieces.value.is_byte[ids])])[at]
                chars = np.concatenate([[0], np.cumsum((back & 0xC0) != 0x80)])[ends]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), pa.array(np.diff(at)), pa.array(np.diff(fallback)),
                    pa.array([hashlib.sha256(small[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])], pa.string()),
                    pa.array(np.diff(chars)),
                    pa.array([hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])], pa.string()),
                ], ["doc_id", "n_pieces", "n_fallback", "ids_sha256", "n_chars", "decoded_sha256"])
    return run


def _encoded(pieces):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            buf, offsets = texts(batch.column("text"))
            for i, j in slices(buf, offsets, SLICE_BYTES):
                part = offsets[i:j + 1]
                ids, at = pieces.value.encode(buf[part[0]:part[-1]], part - part[0])
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, j - i) for c in batch.columns),
                     pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                    [*batch.schema.names, "ids"])
    return run


def _decoded(pieces):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            ids = batch.column("ids").fill_null([]) if batch.column("ids").null_count else batch.column("ids")
            at = ids.offsets.to_numpy().astype(np.int64)
            # A million ids at a time, so that a batch of long texts needs no more memory than others.
            for i, j in slices(at, at, SLICE_BYTES // 2):
                flat = ids.values.slice(int(at[i]), int(at[j] - at[i])).to_numpy(zero_copy_only=False).astype(np.int64)
                back, ends = pieces.value.decode(flat, at[i:j + 1] - at[i])
                whole = back.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, j - i) for c in batch.columns),
                     pa.array([whole[a:b].decode() for a, b in zip(ends[:-1], ends[1:])], pa.string())],
                    [*batch.schema.names, "decoded"])
    return run


def _types(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """docs with the array column ids, which replaces one of that name."""
    docs = docs.drop("ids")
    pieces = docs.sparkSession.sparkContext.broadcast(Pieces.load(path))
    return docs.mapInArrow(_encoded(pieces), f"{_types(docs)}, ids array<int>")


def decode(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """rows with the text of their ids as column decoded, which replaces one of that name."""
    rows = rows.drop("decoded")
    pieces = rows.sparkSession.sparkContext.broadcast(Pieces.load(path))
    return rows.mapInArrow(_decoded(pieces), f"{_types(rows)}, decoded string")


def _both(pieces):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _encoded(pieces)(incoming):
            yield from _decoded(pieces)(iter([batch]))
    return run


def encode_and_decode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """docs with ids and decoded, which replace columns of these names, in one pass."""
    docs = docs.drop("ids", "decoded")
    pieces = docs.sparkSession.sparkContext.broadcast(Pieces.load(path))
    return docs.mapInArrow(_both(pieces), f"{_types(docs)}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """Per document: number of pieces, those that are byte pieces, SHA-256 of the ids (little-endian, 32 bit), and the decoded text's length and SHA-256."""
    pieces = docs.sparkSession.sparkContext.broadcast(Pieces.load(path))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _digests(pieces), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pieces long, n_fallback long, "
        "ids_sha256 string, n_chars long, decoded_sha256 string")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
