"""Words of texts as arrays of hashes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import xxhash

# Characters of the texts that are worked on together.
GROUP_CHARS = 1 << 20


def groups(texts: list[str], most: int = GROUP_CHARS) -> Iterator[slice]:
    """Consecutive texts of about ``most`` characters together."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > most:
            yield slice(start, i)
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def word_hashes(tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word of all token lists in a row, and the number of words of each."""
    words = list(chain.from_iterable(tokens))
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    flat = hashes[np.fromiter(map(number.__getitem__, words), np.int64, len(words))]
    return flat, np.array([len(t) for t in tokens], np.int64)
