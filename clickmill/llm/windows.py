"""Windows of a sequence as runs that share an anchor, for exact search of repeated windows.

A window is `length` consecutive units (bytes, or words as 64-bit hashes) of one document.
Its anchor is the gram of `gram` units in it that hashes lowest, the leftmost on a tie, so
equal windows have equal anchors at equal places. Neighbouring windows share an anchor: a
run is all windows of one anchor occurrence, a few per cent of the number of windows.

 - A window whose anchor occurs once in the collection occurs once itself.
 - Runs with the same content hold pairwise the same windows; one of them stands for all.
 - Windows at different places of their anchor differ, so none repeats within one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
SLICE_BYTES = 1 << 20
SEGMENT_UNITS = 1 << 21
_INDEX = U((1 << 22) - 1)
_STEP = U(0x9E3779B97F4A7C15)
_INVERSE = pow(int(_STEP), -1, 2**64)
_BYTE = np.random.default_rng(20240601).integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)

#: White space that ends a word: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


_TABLES: dict[int, np.ndarray] = {}


def _powers(step: int, n: int) -> np.ndarray:
    """The first n powers of step; one table for each step is kept, the longest yet asked for."""
    had = _TABLES.get(step)
    if had is None or len(had) < n:
        had = np.full(-(-max(n, 1) // (1 << 18)) << 18, step, U)
        had[0] = 1
        np.multiply.accumulate(had, out=had)
        _TABLES[step] = had
    return had[:n]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash multiplier and of its inverse."""
    return _powers(int(_STEP), n), _powers(_INVERSE, n)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(31))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(29)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(32)
    return h


def prefix_sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each units[begin:end] from the prefix sums."""
    return mix((sums[end] - sums[begin]) * powers(len(sums))[1][begin])


def range_hashes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each buf[begin:end], for ranges in order that do not overlap.

    Each byte is mixed with its place in the range before the sum, so no two contents
    collide by the form of the sum; that takes a chance of one in 2**64.
    """
    n = end - begin
    if not len(n):
        return np.zeros(0, U)
    ahead = np.cumsum(n) - n
    place = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(ahead, n)
    value = buf[place + np.repeat(begin, n)].astype(U)
    value |= place.view(U) << U(8)
    value *= _STEP
    value = mix(value)
    full = n > 0
    out = np.zeros(len(n), U)
    if full.any():
        out[full] = np.add.reduceat(value, ahead[full])
    return mix(out + n.astype(U))


def word_bounds(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word in the bytes of documents that lie end to end."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~space[buf]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(buf))]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_units(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE,
               fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, each document's offsets among them, and the words' begins and ends."""
    begin, end = word_bounds(buf, offsets, space)
    return range_hashes(buf if fold is None else fold[buf], begin, end), np.searchsorted(begin, offsets), begin, end


def slices(buf: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most `limit` bytes each; a longer document stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def units_of(buf: np.ndarray, offsets: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Units and document offsets among them; a long document is hashed in blocks cut at white space."""
    if not words:
        return buf, offsets
    if len(buf) <= 2 * SLICE_BYTES:
        return word_units(buf, offsets)[:2]
    parts, at = [], 0
    while at < len(buf):
        stop = min(at + SLICE_BYTES, len(buf))
        while stop < len(buf):
            gap = np.flatnonzero(SPACE[buf[stop:stop + SLICE_BYTES]])
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(stop + SLICE_BYTES, len(buf))
        parts.append(word_units(buf[at:stop], np.array([0, stop - at]))[0])
        at = stop
    units = np.concatenate(parts)
    return units, np.array([0, len(units)])


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:len(values) - (width - done)], values[width - done:]) if done < width else values


def _segment_runs(units: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    values = _BYTE[units] if units.dtype == np.uint8 else units
    sums = prefix_sums(values)
    inverse = powers(len(sums))[1]
    grams = mix((sums[gram:] - sums[:-gram]) * inverse[:len(sums) - gram])
    lowest = _lowest((grams & ~_INDEX) | np.arange(len(grams), dtype=U), length - gram + 1)
    inside = np.zeros(len(units) + 1, np.int32)
    begin, end = offsets[:-1], offsets[1:] - length + 1
    good = end > begin
    np.add.at(inside, begin[good], 1)
    np.add.at(inside, end[good], -1)
    windows = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    anchors = (lowest[windows] & _INDEX).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    start = windows[first]
    n = np.diff(np.concatenate([first, [len(anchors)]]))
    key = grams[anchors[first]]
    content = mix((sums[start + n - 1 + length] - sums[start]) * inverse[start])
    return key, content, start, n, anchors[first] - start, sums


def runs(units: np.ndarray, offsets: np.ndarray, length: int, gram: int, hot: np.ndarray | None = None):
    """(key, content, start, n) of every run, in order; start counts from the first unit.

    Runs whose key is in the sorted array `hot` are returned window by window, each under a
    key of its own, so that no key gathers the surroundings of a very common passage.
    """
    empty = tuple(np.zeros(0, t) for t in (U, U, np.int64, np.int64))
    found = []
    for at in range(0, max(1, len(units)), SEGMENT_UNITS):
        stop = min(len(units), at + SEGMENT_UNITS + length - 1)
        where = np.clip(offsets, at, stop) - at
        if stop - at < length or not (np.diff(where) >= length).any():
            continue
        key, content, start, n, shift, sums = _segment_runs(units[at:stop], where, length, gram)
        if hot is not None and len(hot):
            split = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
            if split.any():
                times = np.where(split, n, 1)
                which = np.repeat(np.arange(len(key)), times)
                step = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                alone = split[which]
                start = start[which] + np.where(alone, step, 0)
                n = np.where(alone, 1, n[which])
                own = mix(key[which] + (shift[which] - step).astype(U) * _STEP + U(1))
                content = np.where(alone, hashes(sums, start, start + n - 1 + length), content[which])
                key = np.where(alone, own, key[which])
        found.append((key, content, start + at, n))
    return tuple(map(np.concatenate, zip(*found))) if found else empty


def repeated_windows(units: np.ndarray, position: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Depth-limited radix sort of the suffixes at `position`; class of each, -1 where it is alone.

    Suffixes are told apart digit by digit from the most significant on, and only through
    `length` units; a digit is one word or eight bytes. A suffix left alone in its group is
    finished. The groups left after the last digit are exactly the repeated windows.
    """
    found = np.full(len(position), -1, np.int64)
    if units.dtype == np.uint8:
        depths = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])] if length >= 8 else list(range(length))
        step = 8 if length >= 8 else 1
        digits = np.ndarray((max(0, len(units) - step + 1),), f">u{step}", units.tobytes(), 0, (1,))
    else:
        depths, digits = range(length), units
    live = np.arange(len(position))
    for depth in depths:
        digit = digits[position[live] + depth].astype(U)
        order = np.lexsort((digit, group[live]))
        live, digit = live[order], digit[order]
        here = group[live]
        fresh = np.ones(len(live), bool)
        fresh[1:] = (here[1:] != here[:-1]) | (digit[1:] != digit[:-1])
        label = np.cumsum(fresh) - 1
        many = np.bincount(label)[label] > 1 if len(label) else np.zeros(0, bool)
        live, label = live[many], label[many]
        group = group.copy()
        group[live] = label
        if not len(live):
            return found
    found[live] = group[live]
    return found
