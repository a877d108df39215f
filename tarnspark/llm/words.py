"""Splitting and hashing of words inside tasks, on UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of non-ASCII characters, blanks the rest.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: As FOLD, with every digit as 0.
FOLD_DIGITS = bytes(48 if 48 <= b <= 57 else FOLD[b] for b in range(256))


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def fold_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return utf8(text).translate(FOLD).split()


class Hashes(dict):
    """word -> 64-bit hash, computed once a word; it is emptied when it grows past ``limit``."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * np.uint64(0x100000001B3) + mix(words[j : j + n], j)
    return mix(out)
