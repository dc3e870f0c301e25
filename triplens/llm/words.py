"""Words and rolling hashes of word windows, as numpy arrays of unsigned 64-bit integers."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, count: int) -> np.ndarray:
    if len(_powers[base]) < count:
        steps = np.full(max(count, 4096), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:count]


def split(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; bytes are parted at exactly space, tab, LF, VT, FF and CR."""
    return text.encode().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every window of ``width`` words, modulo 2**64, with its bits mixed.

    With sums of hash * base**-place, a window is the difference of two sums moved to place 0.
    """
    count = len(hashes)
    if count < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(count + 1, np.uint64)
    np.cumsum(hashes * _power(_INVERSE, count), out=sums[1:])
    mixed = (sums[width:] - sums[:-width]) * _power(_BASE, count - width + 1)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the upper half of the hash; sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
