"""Word shingles as sorted 64-bit hashes, and MinHash signatures of them.

A word's hash is a keyed 64-bit BLAKE2b; a shingle's is a sum of its words' hashes, each
times a factor of its place, put through a finaliser that loses nothing. Under a key that
is not known in advance (:func:`new_key`) no two texts can be made to share a shingle that
they do not have in common: any two differing runs of words meet with probability 2**-62.
"""

from __future__ import annotations

import hashlib
import secrets
from itertools import starmap

import numpy as np

WORDS, CACHED = 5, 200_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def new_key() -> bytes:
    """A key that nobody knows before the run that uses it."""
    return secrets.token_bytes(16)


class _Hashes(dict):
    """Hashes of the words met so far, forgotten when there are many."""

    def __init__(self, key: bytes) -> None:
        super().__init__()
        self.key = key

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[word] = value = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=self.key).digest(), "little")
        return value


class Shingler:
    """Shingle sets of texts under one key."""

    def __init__(self, key: bytes, words: int = WORDS) -> None:
        self.words, self._hashes = words, _Hashes(key)
        draws = starmap(int.from_bytes, ((hashlib.blake2b(b"place", digest_size=8, key=key, salt=i.to_bytes(8, "little")).digest(), "little") for i in range(2 * words)))
        found = np.array(list(draws), np.uint64) | np.uint64(1)
        self._factors, self._counts = found[:words], found[words:]

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles.

        A-Z are lower-cased; words are what ASCII white space separates. With fewer words the
        whole sequence is one shingle; without words the set is empty.
        """
        found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
        if not found:
            return np.zeros(0, np.uint64)
        marks = np.fromiter(map(self._hashes.__getitem__, found), np.uint64, len(found))
        width = min(self.words, len(found))
        n = len(found) - width + 1
        h = np.full(n, self._counts[width - 1])  # tells short sequences of different lengths apart
        for i in range(width):
            h += marks[i : i + n] * self._factors[i]
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
        return np.unique(h ^ (h >> np.uint64(33)))


class MinHash:
    """Signatures of ``size`` coordinates, 32 bits each."""

    def __init__(self, size: int, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        self.factor = (rng.integers(0, 1 << 63, size, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(self.factor), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(hashes), 512):
            np.minimum(out, ((hashes[i : i + 512, None] ^ self.flip) * self.factor).min(0), out=out)
        return (out >> np.uint64(32)).astype(np.uint32)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
