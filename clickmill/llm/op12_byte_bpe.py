"""Byte-level BPE encoding and decoding in padded numpy matrices.

A text is cut into the matches of a pattern, each encoded on its own: a match that is a
token of the vocabulary is that token, any other begins as its bytes and, while two
neighbours make a token together, the leftmost pair of lowest rank becomes one token.

Matches of like length (up to a power of two) are the rows of one matrix, padded at the
right, with a second matrix of the ranks of neighbouring pairs. Each round merges in every
row its leftmost pair of minimum rank, found in a hash table of all pairs that make a token,
and closes the gap, so a round takes one column off; rows without a pair leave the matrix.

A match of over LONG bytes would take a round of its whole length for each merge. In such a
row one round merges all pairs of the minimum rank from the left, up to the first merge
that puts a lower rank beside it; pairs wait in one list for each rank, so a round touches
only what it merges. That is what many rounds of the rule above would do.

A task encodes each distinct match of a slice once and keeps a bounded number of them for
the next slices. The vocabulary is broadcast: MAX_TOKENS bounds it.

 - A missing or empty text has no ids and decodes to the empty text.
 - Rows are treated one by one; repeated or missing ids keep a row each. An empty table
   gives an empty result. Columns `ids` and `decoded` of the input are replaced, all others
   pass through.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, texts
from .windows import SLICE_BYTES, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MAX_TOKENS = 1_000_000
LONG = 256
#: Cells of a matrix, matches taken from a text at a time, and what a task keeps of slices done.
_CELLS, _MATCHES, _KEPT_MATCHES, _KEPT_BYTES = 1 << 20, 200_000, 150_000, 4 << 20
_NONE = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _place(key: np.ndarray, bits: int) -> np.ndarray:
    return (key.astype(np.uint64) * _SPREAD >> np.uint64(64 - bits)).astype(np.int64)


class PairTable:
    """Rank of the token that two tokens make together, by open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(8, int(2 * len(rank) + 1).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, _NONE, np.int32)
        key = left.astype(np.int64) << 32 | right
        at, left_over = _place(key, self.bits), np.arange(len(key))
        while len(left_over):
            free = left_over[self.key[at[left_over]] < 0]
            self.key[at[free]] = key[free]  # of several at one place the last stays
            self.rank[at[free]] = rank[free]
            left_over = left_over[self.key[at[left_over]] != key[left_over]]
            at[left_over] = at[left_over] + 1 & len(self.key) - 1

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, _NONE where they make no token; a negative token is padding."""
        key = left.astype(np.int64) << 32 | right
        key[(left < 0) | (right < 0)] = -2
        at = _place(key, self.bits)
        found, out = self.key[at], self.rank[at]
        away = np.flatnonzero((found != key) & (found >= 0))
        out[found != key] = _NONE
        while len(away):
            at[away] = at[away] + 1 & len(self.key) - 1
            found = self.key[at[away]]
            hit = found == key[away]
            out[away[hit]] = self.rank[at[away[hit]]]
            away = away[~hit & (found >= 0)]
        return out


class Vocabulary:
    """Tokens by rank, the pairs that make them, and the pattern that cuts texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if len(ranks) > MAX_TOKENS:
            raise ValueError(f"more than {MAX_TOKENS} tokens")
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.ranks, self.pattern = ranks, pattern
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[token[:k]], ranks[token[k:]], rank) for token, rank in ranks.items()
                 for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
        self.pairs = PairTable(*np.array(pairs or np.zeros((0, 3)), np.int64).T)
        raw = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            raw[rank] = token
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(t) for t in raw])])

    @staticmethod
    def load(path: str | None = None, pattern: str | None = None) -> Vocabulary:
        """A file of base64 tokens with their ranks, one a line."""
        if path is None or pattern is None:
            import public_tokenizers

            path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
        with open(path, "rb") as lines:
            return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def _merge_rows(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, tokens padded with -1) as rows of padded tokens run out of pairs."""
        number = np.arange(len(rows))
        ranks = self.pairs(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(rows), -1)
        while len(number):
            if not ranks.shape[1]:
                yield number, rows
                return
            at = ranks.argmin(1)
            best = ranks[np.arange(len(number)), at]
            done = best == _NONE
            if done.any():
                yield number[done], rows[done]
                live = ~done
                number, rows, ranks, at, best = number[live], rows[live], ranks[live], at[live], best[live]
                if not len(number):
                    return
            line = np.arange(len(number))
            rows[line, at] = best
            stay = np.ones(rows.shape, bool)
            stay[line, at + 1] = False
            rows = rows[stay].reshape(len(line), -1)
            stay = np.ones(ranks.shape, bool)
            stay[line, at] = False
            ranks = ranks[stay].reshape(len(line), -1)
            for place in (at - 1, at):
                inside = np.flatnonzero((place >= 0) & (place < ranks.shape[1]))
                where = place[inside]
                ranks[inside, where] = self.pairs(rows[inside, where], rows[inside, where + 1])

    def _merge_long(self, tokens: np.ndarray) -> np.ndarray:
        """The tokens of one long match, all pairs of the minimum rank in a round."""
        n = len(tokens)
        tokens = np.append(tokens, np.int32(-1))  # place n: padding after the last and before the first
        after, before = np.append(np.arange(1, n + 1), n), np.append(np.arange(-1, n - 1), n)
        before[0] = n
        alive = np.ones(n + 1, bool)
        rank = np.append(self.pairs(tokens[:-1], tokens[1:]), _NONE)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] != _NONE]
            places = places[np.argsort(rank[places], kind="stable")]
            cuts = np.flatnonzero(np.diff(rank[places])) + 1
            for part in np.split(places, cuts):
                if len(part):
                    r = int(rank[part[0]])
                    if r not in waiting:
                        waiting[r] = []
                        heappush(heap, r)
                    waiting[r].append(part)

        wait(np.arange(n))
        while heap:
            r = heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            seen = at
            # Of pairs that share tokens (a run of one token) every other one is merged.
            joined = np.concatenate([[False], after[at[:-1]] == at[1:]])
            first = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            middle = after[at]
            end = after[middle]
            left = tokens[before[at]]
            left[1:][before[at[1:]] == middle[:-1]] = r
            lower = np.flatnonzero(np.minimum(self.pairs(left, np.full(len(at), r)), self.pairs(np.full(len(at), r), tokens[end])) < r)
            if len(lower):
                at, middle, end = (x[:int(lower[0]) + 1] for x in (at, middle, end))
            tokens[at] = r
            alive[middle] = False
            after[at] = end
            before[end] = at
            before[n] = n
            touched = np.unique(np.concatenate([at, before[at]]))
            touched = touched[touched < n]
            rank[touched] = self.pairs(tokens[touched], tokens[after[touched]])
            wait(touched)
            if len(lower):
                wait(seen[alive[seen] & (rank[seen] == r)])
        return tokens[:n][alive[:n]]

    def encode_matches(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all matches in order, and how many each has."""
        size = np.fromiter(map(len, matches), np.int64, len(matches))
        whole = np.fromiter((self.ranks.get(m, -1) for m in matches), np.int64, len(matches))
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        easy = np.flatnonzero((whole >= 0) & (size > 0))
        parts.append((easy, np.ones(len(easy), np.int64), whole[easy].astype(np.int32)))
        hard = np.flatnonzero((whole < 0) & (size > 0))
        for i in hard[size[hard] > LONG]:
            ids = self._merge_long(self.bytes[np.frombuffer(matches[i], np.uint8)])
            parts.append((np.array([i]), np.array([len(ids)]), ids))
        hard = hard[size[hard] <= LONG]
        hard = hard[np.argsort(size[hard], kind="stable")]
        at = 0
        while at < len(hard):
            wide = 1 << int(size[hard[at]] - 1).bit_length()
            same = int(np.searchsorted(size[hard], wide, "right"))
            pick = hard[at:min(same, at + max(1, _CELLS // wide))]
            wide = int(size[pick[-1]])
            flat = np.frombuffer(b"".join(matches[i].ljust(wide, b"\0") for i in pick), np.uint8).reshape(len(pick), wide)
            rows = np.where(np.arange(wide) < size[pick][:, None], self.bytes[flat], np.int32(-1))
            for number, tokens in self._merge_rows(rows):
                real = tokens >= 0
                parts.append((pick[number], real.sum(1), tokens[real]))
            at += len(pick)
        order = np.concatenate([p[0] for p in parts])
        count = np.concatenate([p[1] for p in parts])
        ids = np.concatenate([p[2] for p in parts])
        n = np.zeros(len(matches), np.int64)
        n[order] = count
        start = np.zeros(len(matches), np.int64)
        start[order] = np.cumsum(count) - count
        return ids[spread(start, n)], n

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts end to end, and their offsets."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.raw_at) - 1):
            raise ValueError("an id is not of the vocabulary")
        size = np.diff(self.raw_at)[ids]
        return self.raw[spread(self.raw_at[ids], size)], np.concatenate([[0], np.cumsum(size)])[offsets]


def spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of n places each, one after another."""
    total = int(n.sum())
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(total)


class _Numbers(dict):
    """Numbers matches as they are first asked for."""

    def __missing__(self, match: str) -> int:
        number = self[match] = len(self)
        return number


class Encoder:
    """Encodes texts; distinct matches are encoded once, and a bounded number is kept."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(vocabulary.pattern)
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.bytes = 0
        self.ids, self.start, self.n = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _of(self, matches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the matches in order, and how many each has."""
        had = len(self.known)
        which = np.fromiter(map(self.known.__getitem__, matches), np.int64, len(matches))
        if len(self.known) > had:
            raw = [m.encode() for m in islice(self.known, had, None)]
            ids, n = self.vocabulary.encode_matches(raw)
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n) - n])
            self.ids, self.n = np.concatenate([self.ids, ids]), np.concatenate([self.n, n])
            self.bytes += sum(map(len, raw))
        n = self.n[which]
        ids = self.ids[spread(self.start[which], n)]
        if len(self.known) > _KEPT_MATCHES or self.bytes > _KEPT_BYTES:
            self._forget()
        return ids, n

    def encode(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and the offsets of each text's."""
        ids, count = [], np.zeros(len(rows), np.int64)
        held: list[str] = []
        of: list[tuple[int, int]] = []

        def flush() -> None:
            found, n = self._of(held)
            ids.append(found)
            ends = np.concatenate([[0], np.cumsum(n)])
            at = 0
            for row, m in of:
                count[row] += ends[at + m] - ends[at]
                at += m
            held.clear()
            of.clear()

        for row, text in enumerate(rows):
            found = self.pattern.finditer(text) if len(text) > SLICE_BYTES else None
            while True:
                part = self.pattern.findall(text) if found is None else [m.group() for m in islice(found, _MATCHES)]
                held += part
                of.append((row, len(part)))
                if len(held) >= _MATCHES:
                    flush()
                if found is None or len(part) < _MATCHES:
                    break
        if held:
            flush()
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum(count)])


def _encoded_slices(vocabulary, incoming: Iterator[pa.RecordBatch]):
    """Parts of each batch of about SLICE_BYTES of text with their ids and offsets."""
    encoder = Encoder(vocabulary.value)
    for batch in incoming:
        column = batch.column("text")
        _, offsets = texts(column)
        for i, j in slices(offsets, offsets):
            ids, at = encoder.encode([t or "" for t in column.slice(i, j - i).to_pylist()])
            yield batch.slice(i, j - i), ids, at


def _ids_array(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))


def _decoded_texts(vocabulary: Vocabulary, ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """Texts of the ids; bytes that are no UTF-8 become U+FFFD, as of ids that no text has."""
    back, ends = vocabulary.decode(ids, at)
    whole = back.tobytes()
    return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])], pa.string())


def _encoding(vocabulary, decoded: bool):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, at in _encoded_slices(vocabulary, incoming):
            columns, names = [*part.columns, _ids_array(ids, at)], [*part.schema.names, "ids"]
            if decoded:
                columns, names = [*columns, _decoded_texts(vocabulary.value, ids, at)], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _decoding(vocabulary):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            ids = batch.column("ids").fill_null([]) if batch.column("ids").null_count else batch.column("ids")
            at = ids.offsets.to_numpy().astype(np.int64)
            for i, j in slices(at, at, SLICE_BYTES // 2):
                flat = ids.values.slice(int(at[i]), int(at[j] - at[i])).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, j - i) for c in batch.columns), _decoded_texts(vocabulary.value, flat, at[i:j + 1] - at[i])],
                    [*batch.schema.names, "decoded"])
    return run


def _digests(vocabulary):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, at in _encoded_slices(vocabulary, incoming):
            back, ends = vocabulary.value.decode(ids, at)
            small = ids.astype("<u4")
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(np.diff(at)),
                pa.array([hashlib.sha256(small[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])], pa.string()),
                pa.array([hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])], pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _without(df: DataFrame, *names: str) -> tuple[DataFrame, str]:
    """df without columns of these names, and the types of the others."""
    kept = df.drop(*names)
    return kept, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)


def _shared(spark: SparkSession, path: str | None, pattern: str | None):
    return spark.sparkContext.broadcast(Vocabulary.load(path, pattern))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """docs with the array column ids."""
    docs, types = _without(docs, "ids")
    return docs.mapInArrow(_encoding(_shared(docs.sparkSession, path, pattern), False), f"{types}, ids array<int>")


def decode(rows: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """rows with the text of their ids as column decoded."""
    rows, types = _without(rows, "decoded")
    return rows.mapInArrow(_decoding(_shared(rows.sparkSession, path, pattern)), f"{types}, decoded string")


def encode_and_decode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """docs with ids and the text decoded from them, in one pass."""
    docs, types = _without(docs, "ids", "decoded")
    return docs.mapInArrow(_encoding(_shared(docs.sparkSession, path, pattern), True), f"{types}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per document the number of tokens and the SHA-256 of its ids (little-endian, 32 bit) and of the bytes decoded from them."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _digests(_shared(docs.sparkSession, path, pattern)),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
