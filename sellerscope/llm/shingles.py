"""Word shingles as sorted arrays of 64-bit hashes, computed per document inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
#: words whose hashes a task keeps
MEMO = 400_000
_ODD = np.random.default_rng(1).integers(1 << 40, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2, _S = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(31)


class WordHashes(dict):
    """64-bit hash of a word; forgets all when full, so memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> _S)


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased (bytes.lower and bytes.split do exactly that)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, memo: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle; no words, no shingle."""
    words = words_of(text) if text else []
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = max(1, len(ids) - WORDS + 1)
    total = np.full(n, min(len(ids), WORDS), np.uint64)
    for i in range(min(len(ids), WORDS)):
        total += mixed(ids[i:i + n] + np.uint64(i)) * _ODD[i]
    return np.unique(mixed(total))
