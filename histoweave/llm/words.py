"""Vectorised words and word shingles on UTF-8 bytes, shared by the text operators.

Words are maximal runs of bytes outside a delimiter set. Their 64-bit hashes come
from one prefix sum of a polynomial over the whole buffer, so there is no Python
work per word.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
#: Delimiters of `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64
_rng = np.random.default_rng(20240817)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_pow = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
#: Bytes hashed at once; longer buffers are cut between words.
BLOCK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> _U(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow["up"]) < n:
        size = max(n, 1 << 16)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _pow[key] = np.multiply.accumulate(factors)
    return _pow["up"], _pow["down"]


def _block(buf: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edge = np.diff((~gap[buf]).view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=total[1:])
    return start, end, mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def spans(buf: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of a byte array."""
    if len(buf) <= BLOCK:
        return _block(buf, gap)
    out, at = [], 0
    while at < len(buf):
        to = min(len(buf), at + BLOCK)
        while to < len(buf) and not (cut := np.flatnonzero(gap[buf[at:to]])).size:
            to = min(len(buf), to + BLOCK)  # one word longer than a block
        if to < len(buf):
            to = at + int(cut[-1]) + 1
        s, e, h = _block(buf[at:to], gap)
        out.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*out))


def text_bytes(text: str | None) -> np.ndarray:
    """UTF-8 bytes with A-Z in lower case; null is empty."""
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k word hashes, k up to 64."""
    n = len(hashes) - k + 1
    h = np.full(max(n, 0), k, np.uint64)
    for i in range(k if n > 0 else 0):
        h += hashes[i : n + i] * _STEP[i % len(_STEP)]
    return mix(h)


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a whole text.

    Fewer than k words count as one shingle of all of them; no words give an
    empty array.
    """
    h = spans(text_bytes(text))[2]
    return np.unique(grams(h, min(k, len(h)))) if len(h) else h
