"""The binary Golay code of length 23: every word is within three bits of one codeword."""

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainders() -> np.ndarray:
    """x^n modulo the generator, for each bit n of a word."""
    rest, value = [], 1
    for _ in range(LENGTH):
        rest.append(value)
        value <<= 1
        if value >> CHECKS:
            value ^= GENERATOR
    return np.array(rest, np.uint32)


@lru_cache(maxsize=1)
def indices() -> np.ndarray:
    """For each word of 23 bits the number (12 bits) of the codeword it is decoded to."""
    rest = _remainders()
    errors = np.zeros(1 << CHECKS, np.uint32)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            errors[np.bitwise_xor.reduce(rest[list(bits)])] = sum(1 << bit for bit in bits)
    words = np.arange(1 << LENGTH, dtype=np.uint32)
    syndrome = np.zeros(1 << LENGTH, np.uint32)
    for bit in range(LENGTH):
        syndrome ^= np.where(words >> bit & 1, rest[bit], 0).astype(np.uint32)
    return ((words ^ errors[syndrome]) >> CHECKS).astype(np.uint16)


def near(words: np.ndarray, bits: int) -> np.ndarray:
    """The codewords of each word and of its neighbours at one bit among the lower `bits`.

    A row each, in rising order, with -1 in place of repetitions; there are six different ones at
    most. Words one bit apart hold each other's codeword; words two bits apart share that of a word
    between them.
    """
    flips = np.append(0, 1 << np.arange(bits)).astype(np.int64)
    found = np.sort(indices()[words[:, None] ^ flips].astype(np.int64), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
