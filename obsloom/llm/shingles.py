"""Sets of hashed word shingles, in NumPy.

Words are runs of bytes other than space and tab to carriage return, A-Z lower-cased. A word's hash is a
polynomial in random byte values modulo 2**64, so that all words of a text come from running sums; a shingle
mixes the hashes of its words.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a text that are worked on at once.
PART = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, size=256, dtype=np.uint64) * _U(2) + _U(1)
_TO_SPACE = bytes(32 if 9 <= b <= 13 else b for b in range(256))
_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` of the base and of its inverse."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        _powers = tuple(
            np.concatenate([np.ones(1, dtype=np.uint64), np.multiply.accumulate(np.full(size, x, dtype=np.uint64))]) for x in (_BASE, _INVERSE)
        )
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _part_hashes(raw: bytes) -> np.ndarray:
    codes = np.frombuffer(raw, dtype=np.uint8)
    space = codes == 32
    edge = np.ones(1, dtype=bool)
    starts = np.flatnonzero(~space & np.concatenate([edge, space[:-1]]))
    ends = np.flatnonzero(~space & np.concatenate([space[1:], edge])) + 1
    power, inverse = powers(len(codes))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTES[codes] * power[: len(codes)], dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    raw = text.encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE)
    parts, start = [], 0
    while start < len(raw):
        end = raw.find(b" ", start + PART)
        end = len(raw) if end < 0 else end
        parts.append(_part_hashes(raw[start:end]))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def shingle_set(text: str, size: int = 3) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``size`` words; a text of fewer words is one shingle."""
    words = word_hashes(text)
    n = min(size, len(words))
    if not n:
        return words
    total = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total = mix(total * _BASE + words[i : len(words) - n + 1 + i])
    return np.unique(total)


def identity(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    low = int(np.sum(mix(tokens ^ _U(0x1234567)), dtype=np.uint64))
    high = int(np.sum(mix(tokens ^ _U(0x7654321)), dtype=np.uint64))
    return signed(low), signed(high)


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x
