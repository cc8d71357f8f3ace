"""Hashed words and shingles of whole texts, as arrays."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """64-bit hash by word (bytes); emptied when it holds too many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words of a text in order, A-Z read as a-z."""
        words = (text or "").encode().lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """An independent hash of each value."""
    x = values ^ np.uint64((seed * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words: products with odd powers, summed modulo 2^64."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    if width <= 16:
        for k in range(width):
            total = total * _ODD + words[k : k + count]
        return mixed(total, width)
    half = width // 2
    first = rolling(words, half)
    second = rolling(words, width - half)
    return mixed(mixed(first[:count], 1) + mixed(second[half : half + count], 2), width)


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places that are the leftmost minimum of some window of ``width`` values; of all values if there are fewer."""
    if not len(values):
        return np.zeros(0, np.int64)
    width = min(width, len(values))
    windows = np.lib.stride_tricks.sliding_window_view(values, width)
    return np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
