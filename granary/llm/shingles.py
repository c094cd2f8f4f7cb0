"""Token shingles of many texts at once, as 64-bit hashes in flat arrays.

Tokens are the maximal runs of [A-Za-z0-9_] and every other single character that isn't white
space; a shingle is ``width`` consecutive tokens. A run's hash is a polynomial over its characters,
read off a running sum, so no Python loop touches a character or a token.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_B1, _B2 = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_SPACES = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_OTHER = 0x3001  # code points from here on are tokens of their own
_KIND = np.full(_OTHER + 1, 2, np.uint8)  # 0 white space, 1 word, 2 a token of its own
_KIND[_SPACES] = 0
_KIND[[*range(48, 58), *range(65, 91), 95, *range(97, 123)]] = 1
_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xA0761D6478BD642F)]
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = _powers[base] = np.cumprod(known)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _spans(total: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    inverse = powers(pow(base, -1, 1 << 64), len(total))
    return (total[ends] - total[starts]) * inverse[starts]


def _running(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


@dataclass
class Shingled:
    """``first[i]:first[i+1]`` are the distinct shingles of text i, in ascending order."""

    n_tokens: np.ndarray
    sequence: np.ndarray  # (n, 2): 128 bits that stand for the whole token sequence
    first: np.ndarray
    shingles: np.ndarray


def shingle(texts: list[str], width: int = 5, least_tokens: int = 0) -> Shingled:
    """Shingles of at most 4,096 texts; those of fewer than ``least_tokens`` tokens get none."""
    n = len(texts)
    if n > 4096:
        raise ValueError("at most 4,096 texts at once")
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, n)
    chars = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _KIND[np.minimum(chars, _OTHER)]
    word = kind == 1
    own = kind == 2
    opens = own.copy()
    opens[0] |= word[0]
    opens[1:] |= word[1:] & ~word[:-1]
    closes = own
    closes[:-1] |= word[:-1] & ~word[1:]  # the last character is a line feed
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    edges = np.concatenate([[0], np.cumsum(lengths)])
    tokens = starts.searchsorted(edges)
    n_tokens = np.diff(tokens)
    with np.errstate(over="ignore"):
        h = mix(_spans(_running(chars.astype(np.uint64) + np.uint64(1), _B1), starts, ends, _B1))
        sequence = np.stack([mix(_spans(_running(h | np.uint64(1), b), tokens[:-1], tokens[1:], b)) for b in (_B1, _B2)], axis=1)
        count = np.maximum(n_tokens - width + 1, 0)
        count[n_tokens < least_tokens] = 0
        text = np.repeat(np.arange(n, dtype=np.uint64), count)
        at = np.arange(len(text)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.repeat(tokens[:-1], count)
        s = h[at] * _STEPS[0]
        for k in range(1, width):
            s += h[at + k] * _STEPS[k % len(_STEPS)]
            s ^= s >> np.uint64(29)
            s *= np.uint64(0xBF58476D1CE4E5B9)
        s = (text << np.uint64(52)) | (mix(s) >> np.uint64(12))
    s.sort()
    if len(s):
        s = s[np.concatenate([[True], s[1:] != s[:-1]])]
    first = s.searchsorted(np.arange(n, dtype=np.uint64) << np.uint64(52)) if n else np.zeros(0, np.int64)
    return Shingled(n_tokens, sequence, np.concatenate([first, [len(s)]]).astype(np.int64), s & np.uint64((1 << 52) - 1))


def portions(texts: list[str], chars: int = 500_000, most: int = 2048):
    """Slices of ``texts`` of about ``chars`` characters, so that working arrays stay small."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and (size + len(t) > chars or i - begin >= most):
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))
