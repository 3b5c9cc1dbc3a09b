"""Hashes of all substrings of a length at once: polynomial prefix sums modulo 2**64 over random byte values."""

from __future__ import annotations

import numpy as np


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Rolling:
    """The same for every task: values depend on the bytes and on ``seed`` alone."""

    def __init__(self, seed: int = 1):
        random = np.random.default_rng(seed)
        self.values = random.integers(0, 2**64, 256, dtype=np.uint64)
        self.base = np.uint64(int(random.integers(0, 2**63)) * 2 + 1)
        self.back = np.uint64(pow(int(self.base), -1, 2**64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 1 << 20)
            for name, base in (("up", self.base), ("down", self.back)):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of ``data`` (bytes); give them to :meth:`spans`."""
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each span, wherever it stands."""
        return mix((sums[ends] - sums[starts]) * self.down[starts])

    def windows(self, sums: np.ndarray, length: int) -> np.ndarray:
        """The hash of every window of ``length`` bytes, by its start."""
        n = len(sums) - length
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((sums[length:] - sums[:n]) * self.down[:n])

    def texts(self, items: list[bytes]) -> np.ndarray:
        """The hash of each text by itself."""
        if not items:
            return np.zeros(0, dtype=np.uint64)
        lengths = np.array([len(x) for x in items])
        ends = np.cumsum(lengths)
        return self.spans(self.sums(np.frombuffer(b"".join(items), dtype=np.uint8)), ends - lengths, ends)

    def shingles(self, texts: list[list[bytes]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the n-word shingles (joined by a space) of texts given as words, each one's text, and counts by text."""
        sizes = np.array([len(x) for x in texts], dtype=np.int64)
        counts = np.maximum(sizes - n + 1, 0)
        joined = b" ".join([w for x in texts for w in x])
        data = np.frombuffer(joined, dtype=np.uint8)
        if not len(data):
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), counts
        gaps = np.flatnonzero(data == 32)
        starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(data)]
        row = np.repeat(np.arange(len(texts)), sizes)
        first = np.flatnonzero(np.arange(len(starts)) + n <= np.repeat(np.cumsum(sizes), sizes))
        return self.spans(self.sums(data), starts[first], ends[first + n - 1]), row[first], counts
