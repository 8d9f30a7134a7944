"""A double-array trie over byte strings."""

from __future__ import annotations

import numpy as np


class DoubleArray:
    """State 0 is the root; byte b leads from s to t = base[s] + b + 1 if check[t] == s; value[t] is the entry that ends there, or -1."""

    def __init__(self, entries: dict[bytes, int]):
        size = 1 << max(10, (sum(map(len, entries)) * 2).bit_length())
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        self.check[0] = 0
        used = bytearray(size)
        used[0] = 1
        words = sorted(entries)
        # No entry may use the first 256 places, which only some bytes could reach. States with one way on fill the gaps from the left; others are placed further and further right.
        lowest, further = 257, 257
        todo = [(0, 0, len(words), 0)]
        for state, begin, end, depth in todo:
            if begin < end and len(words[begin]) == depth:
                self.value[state] = entries[words[begin]]
                begin += 1
            starts: list[tuple[int, int]] = []
            for i in range(begin, end):
                if not starts or words[i][depth] != starts[-1][0]:
                    starts.append((words[i][depth], i))
            if not starts:
                continue
            while used[lowest]:
                lowest += 1
            first = starts[0][0]
            base = max(0, (lowest if len(starts) == 1 else further) - first - 1)
            while any(used[base + label + 1] for label, _ in starts):
                base += 1
                if base + 516 >= size:
                    size *= 2
                    self.base, self.check, self.value = (
                        np.concatenate([x, np.full(len(x), fill, np.int32)])
                        for x, fill in ((self.base, 0), (self.check, -1), (self.value, -1)))
                    used.extend(bytes(size - len(used)))
            self.base[state] = base
            if len(starts) > 1:
                further = max(further, base + first + 1)
            for k, (label, i) in enumerate(starts):
                after = base + label + 1
                used[after] = 1
                self.check[after] = state
                todo.append((after, i, starts[k + 1][1] if k + 1 < len(starts) else end, depth + 1))
        top = int(np.flatnonzero(np.frombuffer(used, np.uint8))[-1]) + 258
        pad = max(0, top - size)
        self.base = np.pad(self.base, (0, pad))[:top]
        self.check = np.pad(self.check, (0, pad), constant_values=-1)[:top]
        self.value = np.pad(self.value, (0, pad), constant_values=-1)[:top]

    def step(self, states: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        after = self.base[states] + data + 1
        return np.where(self.check[after] == states, after, -1)
