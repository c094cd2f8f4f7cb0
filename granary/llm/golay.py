"""The extended binary Golay code (24, 12, 8) as a fuzzy hash.

Every 24-bit word lies within distance 3 of exactly one codeword or at distance 4 from exactly six
of them. A segment of a fingerprint is decoded to several codewords close to it, least
reliable bits tried both ways, so two segments with few errors share a codeword; its 12 message
bits serve as a key.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np

GENERATOR = 0xC75  # fixed value: x^11+x^10+x^6+x^5+x^4+x^2+1 generates the (23, 12, 7) code
FLIPS = 4  # least reliable bits tried both ways
NONE = np.uint32(0xFFFFFFFF)


def _remainder(x: int) -> int:
    for i in range(22, 10, -1):
        if x >> i & 1:
            x ^= GENERATOR << (i - 11)
    return x


def codeword(message: int) -> int:
    """12 message bits, 11 check bits, a parity bit."""
    c = message << 11
    c |= _remainder(c)
    return c << 1 | bin(c).count("1") & 1


@functools.lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes by byte (3, 256); the nearest error patterns by syndrome (4096, 6), one repeated where it is the only one."""
    unit = [_remainder(1 << (i - 1)) << 1 | 1 if i else 1 for i in range(24)]
    syndromes = np.zeros((3, 256), np.uint32)
    for part, value in itertools.product(range(3), range(256)):
        for i in range(8):
            if value >> i & 1:
                syndromes[part, value] ^= unit[part * 8 + i]
    leaders: list[list[int]] = [[] for _ in range(4096)]
    for weight in range(5):
        for places in itertools.combinations(range(24), weight):
            s = functools.reduce(lambda a, i: a ^ unit[i], places, 0)
            if weight < 4 or not leaders[s] or bin(leaders[s][0]).count("1") == 4:
                leaders[s].append(sum(1 << i for i in places))
    nearest = np.array([x + x[:1] * (6 - len(x)) for x in leaders], np.uint32)
    return syndromes, nearest


def syndrome(words: np.ndarray) -> np.ndarray:
    t = tables()[0]
    return t[0][words & 255] ^ t[1][words >> 8 & 255] ^ t[2][words >> 16]


def nearby(y: np.ndarray, keys: int) -> np.ndarray:
    """Message bits of the ``keys`` codewords found closest to each row of ``y`` (n, 24), the closest first.

    A bit is the sign of its value, its reliability the magnitude; closeness is the sum of the
    reliabilities of the bits that a codeword contradicts. Rows are filled up with ``NONE``.
    """
    nearest = tables()[1]
    n = len(y)
    trust = np.abs(y).astype(np.float32)
    words = ((y > 0) << np.arange(24)).sum(axis=1).astype(np.uint32)
    weak = np.uint32(1) << np.argpartition(trust, FLIPS, axis=1)[:, :FLIPS].astype(np.uint32)
    flips = np.zeros((n, 1), np.uint32)
    for i in range(FLIPS):
        flips = np.concatenate([flips, flips | weak[:, i : i + 1]], axis=1)
    errors = (nearest[syndrome(words[:, None] ^ flips)] ^ flips[:, :, None]).reshape(n, -1)
    sums = np.zeros((n, 3, 256), np.float32)  # of the reliabilities that each byte of an error takes
    for i in range(8):
        np.add(sums[:, :, : 1 << i], trust.reshape(n, 3, 8)[:, :, i, None], out=sums[:, :, 1 << i : 2 << i])
    flat, row = sums.reshape(-1), (np.arange(n, dtype=np.int64) * 768)[:, None]
    cost = flat[row + (errors & np.uint32(255))]
    cost += flat[row + 256 + (errors >> np.uint32(8) & np.uint32(255))]
    cost += flat[row + 512 + (errors >> np.uint32(16))]
    # costs aren't negative, so their bits sort as they do; equal errors come side by side
    both = cost.view(np.uint32).astype(np.uint64) << np.uint64(32) | errors
    both.sort(axis=1)
    new = np.ones(both.shape, bool)
    new[:, 1:] = both[:, 1:] != both[:, :-1]
    place = np.cumsum(new, axis=1)
    row, column = np.nonzero(new & (place <= keys))
    out = np.full((n, keys), NONE, np.uint32)
    out[row, place[row, column] - 1] = (words[row] ^ both[row, column].astype(np.uint32)) >> np.uint32(12)
    return out
