"""Hashes of the words of whole texts."""

from __future__ import annotations

import numpy as np

from tarmac.llm.kept import kept

MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, remembered between texts."""

    def __init__(self, most: int = 200_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def of(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        known = self.known
        found = [known.get(word) for word in words]
        if None in found:
            if len(known) > self.most:
                known.clear()
            for at, value in enumerate(found):
                if value is None:
                    word = words[at]
                    found[at] = known[word] = xxh3_64_intdigest(word)
        return np.array(found, np.uint64)


def word_hashes(text: str | None) -> np.ndarray:
    """A hash for every word: runs of bytes other than ASCII white space, A-Z in lower case."""
    return kept(WordHashes, WordHashes).of((text or "").encode("utf-8", "surrogatepass").lower().split())
