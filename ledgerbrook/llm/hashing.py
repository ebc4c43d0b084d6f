"""Hashes of words and of word sequences as numpy arrays; used inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd constants of the mixing steps.
A, B, C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
#: Distinct words whose hash a task keeps; a memory bound only.
CACHE = 250_000


class _Words(dict):
    """64-bit hash of each word, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        key = self[word] = xxhash.xxh3_64_intdigest(word)
        return key


_WORDS = _Words()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(32))) * C
    x = (x ^ (x >> np.uint64(29))) * B
    return x ^ (x >> np.uint64(32))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two sequences one after the other."""
    return mixed(left * A + ((right << np.uint64(31)) | (right >> np.uint64(33))))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive words, doubling the runs as far as they fit."""
    if len(hashes) < length:
        return hashes[:0]
    now, out = 1, hashes
    while now * 2 <= length:
        out = joined(out[:-now], out[now:])
        now *= 2
    if now < length:
        out = joined(out[: len(out) - (length - now)], out[length - now :])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)
