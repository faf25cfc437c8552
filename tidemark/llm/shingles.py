"""Word shingles of a text as 64-bit hashes, in vectorised numpy.

Words are runs of bytes other than 0x20 and 0x09 to 0x0D, which is the same in
UTF-8 as in code points. A word's hash is a difference of prefix sums, so no
Python object is made per word.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CHUNK = 1 << 20
_powers: dict[int, np.ndarray] = {}


def _power(base: int, length: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < length:
        size = max(4096, 1 << (length - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:length]


_SHIFT, _M1, _M2 = np.uint64(33), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _SHIFT)
    h *= _M1
    h ^= h >> _SHIFT
    h *= _M2
    h ^= h >> _SHIFT
    return h


def _hashes(raw: np.ndarray) -> np.ndarray:
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    values = raw.astype(np.uint64)
    values += np.uint64(1)
    values *= _power(_BASE, len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(raw))[starts])


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """One hash per word, in order. Letters A to Z count as a to z if ``lower``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if lower:
        data = data.translate(_LOWER)
    if len(data) <= _CHUNK:
        return _hashes(np.frombuffer(data, np.uint8))
    raw, parts, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(raw):  # long texts: chunks that end at white space
        end = min(len(raw), at + _CHUNK)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        parts.append(_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; of fewer words, one for the whole sequence."""
    if not len(words):
        return words
    width = min(n, len(words))
    count = len(words) - width + 1
    h = words[:count] + np.uint64(width)
    for i in range(1, width):
        h *= np.uint64(_BASE)
        h += words[i : i + count]
    return mix(h)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    h = shingle_hashes(word_hashes(text), n)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h
