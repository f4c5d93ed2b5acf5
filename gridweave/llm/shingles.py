"""Word and shingle hashes of texts, as arrays, for operators that run inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _A)


class WordHasher:
    """Hashes of the words of UTF-8 texts, with A-Z as a-z; words end at the six ASCII blanks.

    A word's hash is a polynomial over a random number for each byte, from prefix sums: a few array passes for all words.
    """

    def __init__(self) -> None:
        table = numbers(256, 1)
        table[65:91] = table[97:123]
        self.table = table
        self.blank = np.zeros(256, bool)
        self.blank[[32, *range(9, 14)]] = True
        self.base = int(numbers(1, 2)[0]) | 1
        self.powers = self._powers(self.base, CHUNK)
        self.inverse = self._powers(pow(self.base, -1, 1 << 64), CHUNK)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate((out, out * np.uint64(pow(base, len(out), 1 << 64))))
        return out[:n]

    def _some(self, data: np.ndarray, head: int | None = None) -> np.ndarray:
        n = len(data)
        if n > len(self.powers):  # one word that is longer than a chunk
            self.powers, self.inverse = self._powers(self.base, n), self._powers(pow(self.base, -1, 1 << 64), n)
        inside = np.concatenate(([False], ~self.blank[data], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.table[data] * self.powers[:n], dtype=np.uint64)))
        if head is not None:
            ends = np.minimum(ends, starts + head)
        return mix((sums[ends] - sums[starts]) * self.inverse[np.minimum(starts, n - 1)]) if len(starts) else np.zeros(0, np.uint64)

    def words(self, data: np.ndarray, head: int | None = None) -> np.ndarray:
        """Hashes of the words of one text, or of their first `head` bytes, in order; long texts go in chunks that end at a blank."""
        if len(data) <= CHUNK:
            return self._some(data, head) if len(data) else np.zeros(0, np.uint64)
        out, at = [], 0
        while at < len(data):
            end = min(at + CHUNK, len(data))
            while end < len(data):
                blanks = np.flatnonzero(self.blank[data[at:end]])
                if len(blanks):
                    end = at + int(blanks[-1]) + 1
                    break
                end = min(end + CHUNK, len(data))
            out.append(self._some(data[at:end], head))
            at = end
        return np.concatenate(out)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of `size` words; of fewer words, one of the whole sequence; of none, none."""
    n = len(words)
    if n == 0:
        return words
    parts = min(n, size)
    factors = numbers(parts, 3) | np.uint64(1)
    out = np.full(n - parts + 1, parts * 0x51ED27 + 1, np.uint64)
    for k in range(parts):
        out += words[k: n - parts + 1 + k] * factors[k]
    return np.unique(mix(out))


def texts(column) -> Iterator[np.ndarray]:
    """The bytes of each string of an Arrow column, without a copy; nulls are empty."""
    import pyarrow as pa

    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        yield data[at[i]:at[i + 1]] if valid is None or valid[i] else data[:0]
