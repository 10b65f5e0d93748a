"""Hashes of words and of runs of words, over whole batches of texts with numpy.

A run's hash is a polynomial in its words' hashes, modulo 2**64, so the hash
of any run comes from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text hashed at a time; bounds the memory whatever the length of a text.
TILE = 1 << 20
_BASE, _RUN = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


class _Powers:
    """Powers of a base and of its inverse, kept for the longest use so far."""

    def __init__(self, base: int) -> None:
        self.base, self.up, self.down = base, _powers(base, 1024), _powers(pow(base, -1, 1 << 64), 1024)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            m = max(n, 2 * len(self.up))
            self.up, self.down = _powers(self.base, m), _powers(pow(self.base, -1, 1 << 64), m)
        return self.up, self.down


_of_bytes, _of_words = _Powers(_BASE), _Powers(_RUN)


def _word_hashes(raw: np.ndarray) -> np.ndarray:
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _of_bytes(len(raw) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def word_hashes(text: str | bytes, lower: bool = False) -> np.ndarray:
    """A 64-bit hash for each word of a text, words parted by space and U+0009 to U+000D; lower: after lower-casing A-Z."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text, np.uint8)
    if lower:
        raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    parts, at = [], 0
    while at < len(raw):
        end = min(at + TILE, len(raw))
        if end < len(raw):  # a tile ends where a word does
            tail = raw[end:]
            step = 1 << 12
            for i in range(0, len(tail), step):
                found = np.flatnonzero((tail[i : i + step] == 32) | ((tail[i : i + step] >= 9) & (tail[i : i + step] <= 13)))
                if len(found):
                    end += i + int(found[0])
                    break
            else:
                end = len(raw)
        parts.append(_word_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def many_word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and for each text where its words end."""
    joined = b"\n".join(texts)
    hashes = word_hashes(joined, lower)
    raw = np.frombuffer(joined, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    first = np.flatnonzero(~space & np.concatenate(([True], space[:-1]))) if len(raw) else np.zeros(0, np.int64)
    return hashes, np.searchsorted(first, np.cumsum([len(t) + 1 for t in texts]), side="left")


def grouped(texts: list[bytes], most: int = TILE // 4) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together have about ``most`` bytes."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Runs:
    """Hashes of runs of words, given the words' hashes."""

    def __init__(self, words: np.ndarray) -> None:
        up, self.down = _of_words(len(words) + 1)
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(words * up[: len(words)])))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def of_length(self, k: int) -> np.ndarray:
        n = len(self.sums) - 1
        starts = np.arange(max(0, n - k + 1))
        return self(starts, starts + k)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
