"""Keys that near bit strings share, from the perfect binary Golay code of 23 bits.

Every string of 23 bits is within three bits of exactly one codeword. Its keys are the
codewords within four bits: the nearest one, and five more where that is three bits away.
Two strings that differ in two bits or fewer always share a key.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

#: Fixed: the code's generator, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
LENGTH, CHECKS = 23, 11


def remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the values of each of three bytes; by syndrome, six masks to codewords."""
    bits = [remainder(1 << bit) for bit in range(LENGTH)]
    syndromes = np.zeros((3, 256), np.int64)
    for byte in range(3):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1 and 8 * byte + bit < LENGTH:
                    syndromes[byte, value] ^= bits[8 * byte + bit]
    masks = np.full((1 << CHECKS, 6), -1, np.int64)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            syndrome, mask = 0, 0
            for place in places:
                syndrome ^= bits[place]
                mask |= 1 << place
            free = np.flatnonzero(masks[syndrome] < 0)
            masks[syndrome, free[0]] = mask
    return syndromes, masks


def keys(words: np.ndarray) -> np.ndarray:
    """For each word of 23 bits, six columns of 12-bit codeword indices; -1 where there are fewer."""
    syndromes, masks = tables()
    syndrome = syndromes[0][words & 255] ^ syndromes[1][words >> 8 & 255] ^ syndromes[2][words >> 16 & 255]
    found = masks[syndrome]
    return np.where(found < 0, -1, (words[:, None] ^ found) >> CHECKS)
