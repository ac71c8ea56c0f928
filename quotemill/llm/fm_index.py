"""FM-index over a sequence of small integers: a wavelet tree over the Burrows-Wheeler transform, searched backward.

Searches run for many patterns at once, one symbol of each per step, so that a step is a few array operations.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_LOW = np.uint64(63)


class WaveletTree:
    """Symbols below ``sigma`` as one bit plane per level, with the ones counted in front of every 64-bit word.

    Nodes of a level lie side by side in one plane, zeros of a level in front of its ones.
    """

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.size = len(symbols)
        self.depth = max(1, int(sigma - 1).bit_length())
        self.planes: list[tuple[np.ndarray, np.ndarray, int]] = []
        left = np.asarray(symbols, np.int32)
        for level in reversed(range(self.depth)):
            bit = (left >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros((self.size >> 6) + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            ahead = np.zeros(len(words), np.int32)
            np.cumsum(np.bitwise_count(words[:-1]), out=ahead[1:])
            self.planes.append((words, ahead, self.size - int(bit.sum())))
            left = np.concatenate([left[~bit], left[bit]])
        self.start = self._walk(np.arange(sigma, dtype=np.int32), np.zeros(sigma, np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where positions go from the root to the leaves of these symbols."""
        for level, (words, ahead, zeros) in zip(reversed(range(self.depth)), self.planes):
            word = at >> 6
            ones = ahead[word] + np.bitwise_count(words[word] & ((_ONE << (at.astype(np.uint64) & _LOW)) - _ONE))
            at = np.where(symbols >> level & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in front of its position."""
        return self._walk(symbols, at) - self.start[symbols]


class FMIndex:
    """Index of a cyclic text whose rotations are in the order of their first ``depth`` symbols or more.

    Searches are right for patterns of up to ``depth`` symbols. prefix_groups tells which rotations agree in a prefix.
    """

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        text = np.asarray(text, np.int64)
        self.size = len(text)
        self._ranks = [text]
        while 1 << len(self._ranks) - 1 < depth:
            last, width = self._ranks[-1], 1 << len(self._ranks) - 1
            pairs = last * (int(last.max(initial=0)) + 1) + np.roll(last, -width)
            self._ranks.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
        self.order = np.argsort(self._ranks[-1], kind="stable")
        self.tree = WaveletTree(text[self.order - 1], sigma)
        counts = np.bincount(text, minlength=sigma)
        self.first = np.cumsum(counts) - counts

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of rotations that begin with the symbol, then with what the intervals [low, high) begin with."""
        base = self.first[symbols]
        return base + self.tree.rank(symbols, low), base + self.tree.rank(symbols, high)

    def prefix_groups(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(group of each row of the index, first row of each group and the end): rows that agree in ``length`` symbols."""
        same = np.ones(max(0, self.size - 1), bool)
        done = 0
        for level in reversed(range(length.bit_length())):
            if length >> level & 1:
                own = np.roll(self._ranks[level], -done)[self.order]
                same &= own[1:] == own[:-1]
                done += 1 << level
        first = np.concatenate([[0], np.flatnonzero(~same) + 1, [self.size]])
        return np.repeat(np.arange(len(first) - 1), np.diff(first)), first


def shared_windows(text: np.ndarray, sigma: int, begin: np.ndarray, size: np.ndarray, owner_value: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pattern, first symbol, smallest value): for every window of ``length`` symbols of every pattern, the smallest
    ``owner_value`` among the patterns that hold it.

    text: the patterns (begin, size), each followed by the symbol 0, which they do not hold. Each pattern is streamed
    backward through the index. The interval of what was matched last grows by a symbol on the left; past ``length``
    symbols it is widened to all rows that agree in ``length``, which drops the symbol on the right. The index holds
    every pattern, so a match never fails.
    """
    index = FMIndex(text, sigma, length + 1)
    group, first = index.prefix_groups(length)
    owner = np.zeros(len(text), np.int64)
    owner[begin] = 1
    owner = np.cumsum(owner) - 1
    least = np.minimum.reduceat(owner_value[owner][index.order], first[:-1])
    by_size = np.argsort(-size, kind="stable")
    end, sizes = (begin + size)[by_size], size[by_size]
    low, high = np.zeros(len(size), np.int64), np.full(len(size), len(text), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for step in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -step))  # patterns of more than ``step`` symbols
        low, high = index.extend(text[end[:live] - 1 - step], low[:live], high[:live])
        if step >= length - 1:
            own = group[low]
            found.append((by_size[:live], sizes[:live] - 1 - step, least[own]))
            low, high = first[own], first[own + 1]
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))
