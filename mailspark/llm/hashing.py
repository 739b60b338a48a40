"""Words of many texts at once as 64-bit hashes, in numpy; used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h.astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), _BASE, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def groups(texts: Sequence[str], most: int = 2_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in runs of bounded size (or one text), each with the number of its first text."""
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        if held and size + len(raw) > most:
            yield at, held
            at, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield at, held


@dataclass
class Words:
    """Words of texts laid end to end: hash, text number, and where in the bytes they lie."""

    raw: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    length: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    sums: np.ndarray

    def bounds(self) -> np.ndarray:
        """First word of each text, and the number of words."""
        return np.searchsorted(self.text, np.arange(len(self.offsets)))

    def prefix(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the words longer than ``n`` bytes: which, and the hash of their first ``n``."""
        which = np.flatnonzero(self.length > n)
        at = self.first[which]
        before = np.where(at > 0, self.sums[at - 1], np.uint64(0))
        return which, mixed(self.sums[at + n - 1] - before + np.uint64(n))

    @property
    def first(self) -> np.ndarray:
        """Of each word, the number of its first byte among all bytes of words."""
        return np.cumsum(self.length) - self.length


def words(texts: list[bytes], lower: bool = False) -> Words:
    """Words as in ``common.words``; ``lower`` folds ASCII letters for the hashes."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    own = (raw != 0x20) & (raw - np.uint8(0x09) > 4)  # 9 to 13 and the blank stand between words
    begins = own.copy()
    begins[1:] &= ~own[:-1]
    inner = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < len(raw))]
    begins[inner] = own[inner]
    start = np.flatnonzero(begins)
    value = raw[own]
    first = np.cumsum(own)[start] - 1
    length = np.diff(np.append(first, len(value)))
    if lower:
        value = value + ((value >= 65) & (value <= 90)) * np.uint8(32)
    place = np.arange(len(value)) - np.repeat(first, length)
    value = (value.astype(np.uint64) + np.uint64(1)) * powers(int(length.max(initial=0)))[place]
    sums = np.cumsum(value, dtype=np.uint64)
    total = sums[first + length - 1] - np.where(first > 0, sums[first - 1], np.uint64(0)) if len(start) else np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, offsets)))
    return Words(raw, offsets, start, length, text, mixed(total + length.astype(np.uint64) * _BASE), sums)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words of one text, and the number of their first word."""
    if len(w.hash) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(len(w.hash) - n + 1, np.uint64)
    for i in range(n):
        h = h * _BASE + w.hash[i : len(w.hash) - n + 1 + i]
    at = np.flatnonzero(w.text[: len(h)] == w.text[n - 1 :])
    return mixed(h[at]), at
