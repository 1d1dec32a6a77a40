"""Hashes of words and of word n-grams, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SLICE_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers whose every output bit depends on every input bit (splitmix64)."""
    x = x.astype(np.uint64, copy=True) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def hash_words(data: np.ndarray, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of every word of the bytes, A-Z taken as a-z.

    A polynomial hash from running sums; long inputs are cut between words.
    """
    letter = mixed(np.arange(256, dtype=np.uint64) + np.uint64(salt * 256 + 1))
    inverse = pow(BASE, -1, 1 << 64)
    blank = BLANKS[data]
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edges[0::2], edges[1::2]
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, "right")))
        first, last = starts[at], ends[stop - 1]
        n = int(last - first)
        term = letter[LOWER[data[first:last]]] * _powers(BASE, n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
        a, b = starts[at:stop] - first, ends[at:stop] - first
        back = _powers(inverse, n)[a]
        hashes[at:stop] = mixed((sums[b] - sums[a]) * back + (b - a).astype(np.uint64))
        at = stop
    return starts, hashes


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; shorter by n - 1 than ``words``."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = np.full(size, n, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(BASE) + words[k : k + size])
    return out


def words_by_text(texts: list[str | None], salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and where each text's words end."""
    encoded = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"\n".join(encoded), np.uint8)
    ends = np.cumsum([len(e) + 1 for e in encoded])
    starts, hashes = hash_words(data, salt)
    return hashes, np.searchsorted(starts, ends)


def ngram_sets(texts: list[str | None], n: int, salt: int = 0) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; of fewer than n words, of the whole sequence."""
    words, ends = words_by_text(texts, salt)
    every = ngram_hashes(words, n)
    at = 0
    for end in ends.tolist():
        size = end - at
        if size >= n:
            yield np.unique(every[at : end - n + 1])
        else:
            yield ngram_hashes(words[at:end], size) if size else np.empty(0, np.uint64)
        at = end
