"""A compressed FM-index in numpy: wavelet matrix over the BWT, ranks by popcounts, sampled suffix positions.

Texts are whole numbers, 0 separates them. All searches are vectorised: many patterns or rows go through each step at
once.
"""

from __future__ import annotations

import numpy as np

from .suffix import suffix_array


class Bits:
    """A bit vector with ranks: one bit each, and a count for every 64."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        raw = np.packbits(np.concatenate([bits.astype(bool), np.zeros(64 - n % 64, bool)]), bitorder="little")
        self.words = raw.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class Wavelet:
    """Ranks and symbols of a sequence of numbers below 2 ** ``depth``, one bit vector for each bit."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for b in reversed(range(self.depth)):
            bit = (seq >> b) & 1 != 0
            self.levels.append((Bits(bit), len(seq) - int(bit.sum())))
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.start = np.zeros(symbols, np.int64)
        self.start = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(self.levels):
            one = (c >> (self.depth - 1 - k)) & 1 != 0
            r = bits.rank(i)
            i = np.where(one, zeros + r, i - r)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each c before each i."""
        return self._down(c, i) - self.start[c]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each i, and its occurrences before i."""
        c = np.zeros(len(i), np.int64)
        for bits, zeros in self.levels:
            one = bits.get(i)
            r = bits.rank(i)
            i = np.where(one, zeros + r, i - r)
            c = 2 * c + one
        return c, i - self.start[c]


class FMIndex:
    """``text`` ends with 0; a sampled position is kept for the start of each text between zeros and every ``rate`` on."""

    def __init__(self, text: np.ndarray, symbols: int, rate: int = 16):
        text = np.asarray(text, np.int64)
        order = suffix_array(text)
        self.size = len(text)
        self.wavelet = Wavelet(text[order - 1], symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        at = np.arange(self.size)
        begin = np.zeros(self.size, np.int64)
        begin[1:] = np.where(text[:-1] == 0, at[1:], 0)
        keep = ((at - np.maximum.accumulate(begin)) % rate == 0)[order]
        self.marked, self.samples = Bits(keep), order[keep]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [lo, hi) of patterns (one in each row, left-aligned); symbols that aren't in the text: -1."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for back in range(1, patterns.shape[1] + 1 if len(patterns) else 1):
            j = lengths - back
            on = np.flatnonzero((j >= 0) & (lo < hi))
            if not len(on):
                continue
            c = patterns[on, j[on]]
            gone = c < 0
            hi[on[gone]] = lo[on[gone]]
            on, c = on[~gone], c[~gone]
            lo[on] = self.less[c] + self.wavelet.rank(c, lo[on])
            hi[on] = self.less[c] + self.wavelet.rank(c, hi[on])
        return lo, hi

    def statistics(self, text: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of a streamed ``text``: for each end, how many numbers before it match the index, up to
        ``most``, and the suffix interval of that match. A number is put before the match until the interval is empty."""
        lo, hi, length = np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64), np.zeros(len(ends), np.int64)
        on = np.arange(len(ends))
        for back in range(1, most + 1):
            on = on[ends[on] >= back]
            c = text[ends[on] - back]
            on, c = on[c > 0], c[c > 0]
            low, high = (self.less[c] + self.wavelet.rank(c, x[on]) for x in (lo, hi))
            here = low < high
            on = on[here]
            lo[on], hi[on], length[on] = low[here], high[here], back
            if not len(on):
                break
        return length, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking back to sampled ones."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo := todo[~self.marked.get(rows[todo])]):
            c, n = self.wavelet.access(rows[todo])
            rows[todo] = self.less[c] + n
            steps[todo] += 1
        return self.samples[self.marked.rank(rows)] + steps
