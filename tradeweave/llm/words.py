"""Words and 64-bit hashes of them, for operators on word sequences."""

from __future__ import annotations

import numpy as np
import xxhash

#: Entries of a task's table of word hashes, about 40 MB.
TABLE_ENTRIES = 300_000


class WordHashes:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text in UTF-8."""

    def __init__(self) -> None:
        self.table: dict[bytes, int] = {}

    def _make(self, word: bytes) -> int:
        if len(self.table) >= TABLE_ENTRIES:
            self.table.clear()
        value = self.table[word] = xxhash.xxh3_64_intdigest(word) or 1
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        find, make = self.table.get, self._make
        return np.fromiter((find(w) or make(w) for w in words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of a public hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
