"""Word windows in numpy, for use inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

STEP = np.uint64(0x9E3779B97F4A7C15)
LOW = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
TO_LOWER = bytes.maketrans(*LOW)
# Everything that is no letter, digit or non-ASCII byte becomes a space, A-Z becomes a-z.
ALNUM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ as UTF-8; bytes.split() parts at just these six characters."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    return text.encode().translate(TO_LOWER).split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the lower-cased text."""
    return text.encode().translate(ALNUM).split() if text else []


def word_hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words; empty where there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return hashes[:0]
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= STEP
        out += hashes[j : n + j]
    out ^= out >> np.uint64(29)
    out *= STEP
    return out


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values, by doubling."""
    least, done = values, 1
    while done * 2 <= width:
        least, done = np.minimum(least[:-done], least[done:]), done * 2
    more = width - done
    return np.minimum(least[:-more], least[more:]) if more else least
