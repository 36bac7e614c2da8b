"""Hashed word shingles of a text, in numpy."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64, endpoint=False)
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Powers:
    """Powers of the base and of its inverse, as far as the longest text so far."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if n > len(self.up):
            m = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(m, np.uint64(base))
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_hashes(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch ``first`` to ``end`` of the bytes."""
    _POWERS.to(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _POWERS.up[:len(raw)], out=total[1:])
    return (total[end] - total[first]) * _POWERS.down[first] + (end - first).astype(np.uint64)


def word_hashes(text: str | bytes) -> np.ndarray:
    """64-bit hash of each word ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lowered."""
    raw = np.frombuffer((text.encode() if isinstance(text, str) else text).lower(), np.uint8)
    gap = np.concatenate([[True], _IS_SPACE[raw], [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    first, end = edge[::2], edge[1::2]
    return mix(byte_hashes(raw, first, end)) if len(first) else np.empty(0, np.uint64)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of all words if there are fewer."""
    words = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, np.uint64(size))
    for i in range(size):
        total += words[i:len(words) - size + 1 + i] * _PLACE[i % len(_PLACE)]
    return np.unique(mix(total))


def signature(shingles: np.ndarray, k: int) -> np.ndarray:
    """MinHash of ``k`` coordinates (32 bits each) of a non-empty set."""
    a, b = _coefficients(k)
    out = np.empty(k, np.uint32)
    step = max(1, 65536 // max(1, len(shingles)))
    for i in range(0, k, step):
        h = shingles[None, :] * a[i:i + step, None] + b[i:i + step, None]
        out[i:i + step] = (h >> np.uint64(32)).min(axis=1)
    return out


_COEFFICIENTS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _coefficients(k: int) -> tuple[np.ndarray, np.ndarray]:
    if k not in _COEFFICIENTS:
        rng = np.random.default_rng(k)
        _COEFFICIENTS[k] = (rng.integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
                            rng.integers(0, 2**64, k, dtype=np.uint64, endpoint=False))
    return _COEFFICIENTS[k]
