"""Count sketches built from partition sketches and merged block by block.

A sketch counts 64-bit keys in one or more rows of 2**bits cells, each row with a hash of
its own, and keeps of every cell only whether its count reached `least`. Cells are shared,
so a count is overestimated and never underestimated: a key that occurs `least` times is
always reported, one that does not may be. Partitions send the low 16 bits of the cells
they touch, in blocks of 65,536 cells; a block is summed in one task. What reaches the
driver and is broadcast is rows * 2**bits / 8 bytes at most, whatever the input size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import mix

#: Largest number of cells of a row, as a power of two: 16 MB of bits.
MAX_BITS = 27
_SCHEMA = "block int, cells binary"
#: Keys that a task gathers before it sends them on.
_HELD = 1_500_000


def bits_for(expected: int, most: int = MAX_BITS) -> int:
    """Eight cells a key, between 2**16 and 2**most."""
    return int(min(most, max(16, np.ceil(np.log2(max(1, expected) * 8)))))


def _cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    h = keys if row == 0 else mix(keys + np.uint64(row) * np.uint64(0xD1B54A32D192ED03))
    return (h >> np.uint64(64 - bits)).astype(np.int64)


class Sketch:
    """Bits of the cells whose count reached the wanted one."""

    def __init__(self, rows: int, bits: int, blocks: list[tuple[int, bytes]]):
        self.rows, self.bits = rows, bits
        self.data = np.zeros((rows, 1 << bits >> 3), np.uint8)
        per_row = 1 << bits >> 16
        for block, data in blocks:
            at = block % per_row * 8192
            self.data[block // per_row, at:at + 8192] = np.frombuffer(data, np.uint8)

    def reached(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for row in range(self.rows):
            cells = _cells(keys, row, self.bits)
            out &= (self.data[row][cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
        return out


def _partial(keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], rows: int, bits: int):
    def packed(keys: np.ndarray, row: int) -> pa.RecordBatch:
        cells = _cells(keys, row, bits)
        cells.sort()
        block = (cells >> 16).astype(np.int32)
        edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        low = (cells & 0xFFFF).astype(np.uint16)
        return pa.RecordBatch.from_arrays(
            [pa.array(block[edges[:-1]] + np.int32(row * (1 << bits >> 16))),
             pa.array([low[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())], ["block", "cells"])

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in incoming:
            for keys in keys_of(batch):
                held.append(keys)
                size += len(keys)
                if size >= _HELD:
                    whole = np.concatenate(held)
                    held, size = [], 0
                    yield from (packed(whole, row) for row in range(rows))
        if size:
            whole = np.concatenate(held)
            yield from (packed(whole, row) for row in range(rows))
    return run


def _merge(least: int):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, counts = None, np.zeros(1 << 16, np.int64)

        def packed():
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([np.packbits(counts >= least).tobytes()], pa.binary())],
                ["block", "cells"])

        for batch in incoming:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != current:
                    if current is not None:
                        yield packed()
                    current = block
                    counts[:] = 0
                counts += np.bincount(np.frombuffer(cells.as_buffer(), np.uint16), minlength=1 << 16)
                np.minimum(counts, least, out=counts)
        if current is not None:
            yield packed()
    return run


def build(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
          bits: int, rows: int = 1, least: int = 2) -> Sketch:
    """Merged sketch of the keys that `keys_of` yields for each record batch of df."""
    merged = (
        df.mapInArrow(_partial(keys_of, rows, bits), _SCHEMA)
        .repartition(F.col("block")).sortWithinPartitions("block")
        .mapInArrow(_merge(least), _SCHEMA)
    )
    return Sketch(rows, bits, [(r["block"], bytes(r["cells"])) for r in merged.toLocalIterator()])
