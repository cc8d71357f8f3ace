"""The binary Golay code with words of 23 bits, as a fuzzy hash.

Every 23-bit word is within 3 bits of exactly one code word. A word's index is the message of that code
word: 12 bits. Two words that differ in one bit share an index if the indices of one word's neighbours
are taken too: those are one index for words within 2 bits of their code word and six for the others.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

BITS = 23
#: Fixed value: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def _remainders(words: np.ndarray) -> np.ndarray:
    """Words modulo the generator polynomial: 11-bit syndromes."""
    rest = words.astype(np.int64)
    for bit in range(BITS - 1, 10, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


@lru_cache(1)
def _errors() -> np.ndarray:
    """Error pattern of at most 3 bits by syndrome; the code is perfect, so each syndrome has one."""
    patterns = [sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(BITS), n)]
    patterns = np.array(patterns, np.int64)
    table = np.zeros(2048, np.int64)
    table[_remainders(patterns)] = patterns
    return table


def nearest_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the code word nearest to each word."""
    words = words.astype(np.int64)
    return (words ^ _errors()[_remainders(words)]) >> 11


@lru_cache(2)
def index_table(bits: int) -> np.ndarray:
    """Index of every word of ``bits`` bits, the other bits being 0."""
    return nearest_index(np.arange(1 << bits)).astype(np.uint16)


def neighbour_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """(words, bits + 1) indices: of the word itself and of the words one bit away, -1 where one repeats."""
    table = index_table(bits)
    words = words.astype(np.int64)
    near = np.concatenate([words[:, None], words[:, None] ^ (1 << np.arange(bits))[None, :]], axis=1)
    found = np.sort(table[near].astype(np.int32), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
