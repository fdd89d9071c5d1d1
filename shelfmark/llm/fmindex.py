"""An FM-index over word numbers: backward search through wavelet ranks, places by samples.

The text is a row of runs of symbols from 1 up, each run closed by a separator (0). In suffix
order separators count as different symbols, by place, so no comparison goes on past the
end of a run. Searches take many patterns at once, as numpy arrays.
"""

from __future__ import annotations

import numpy as np

#: Every so manieth place of the text has its suffix position kept.
SAMPLE = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling."""
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, ends.sum() + symbols).astype(np.int64)
    size, step = len(symbols), 1
    while True:
        after = np.zeros(size, np.int64)
        after[: size - step] = rank[step:] + 1 if step < size else 0
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(size, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if not size or rank[order[-1]] == size - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bitmap for each bit of a symbol."""

    def __init__(self, sequence: np.ndarray, largest: int):
        self.levels, self.bits = [], max(1, int(largest).bit_length())
        for shift in range(self.bits - 1, -1, -1):
            bit = (sequence >> shift) & 1
            ones = np.zeros(len(bit) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((ones, len(bit) - int(ones[-1])))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        symbols = np.arange(largest + 1)
        self._base = self._down(symbols, np.zeros(largest + 1, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(self.levels):
            bit = (symbols >> (self.bits - 1 - level)) & 1
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbols, at) - self._base[symbols]

    def symbol(self, at: np.ndarray) -> np.ndarray:
        found = np.zeros(len(at), np.int64)
        for ones, zeros in self.levels:
            bit = ones[at + 1] - ones[at]
            found = found * 2 + bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return found


class FMIndex:
    def __init__(self, symbols: np.ndarray, largest: int):
        """``symbols`` ends with a separator."""
        order = suffix_array(symbols)
        self.size = len(symbols)
        self.tree = WaveletMatrix(symbols[order - 1], largest)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=largest + 1))])
        kept = (order % SAMPLE == 0) | (symbols[order - 1] == 0)
        self._kept = np.concatenate([[0], np.cumsum(kept)])
        self._places = order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Patterns (rows, their symbols at the right) that occur, and their ranges of suffixes."""
        alive = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        done = []
        for back in range(1, patterns.shape[1] + 1 if len(patterns) else 1):
            symbols = patterns[alive, -back]
            low = self.first[symbols] + self.tree.rank(symbols, low)
            high = self.first[symbols] + self.tree.rank(symbols, high)
            found = low < high
            alive, low, high = alive[found], low[found], high[found]
            over = lengths[alive] == back
            done.append((alive[over], low[over], high[over]))
            alive, low, high = alive[~over], low[~over], high[~over]
        if not done:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(part) for part in zip(*done))

    def locate(self, suffixes: np.ndarray) -> np.ndarray:
        """Places in the text, walking back to a sampled one."""
        places, steps = np.empty(len(suffixes), np.int64), 0
        left, at = np.arange(len(suffixes)), suffixes
        while len(left):
            kept = self._kept[at + 1] > self._kept[at]
            places[left[kept]] = self._places[self._kept[at[kept]]] + steps
            left, at = left[~kept], at[~kept]
            symbols = self.tree.symbol(at)
            at = self.first[symbols] + self.tree.rank(symbols, at)
            steps += 1
        return places
