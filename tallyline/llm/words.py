"""Hashes of the words and word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
UPPER_TO_LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.default_rng(20240607)
PLACES = 64
BYTE_CODES = _random.integers(0, 2**64, (PLACES, 256), dtype=np.uint64, endpoint=False)
SHINGLE_CODES = _random.integers(0, 2**64, 64, dtype=np.uint64, endpoint=False) | np.uint64(1)


def byte_class(excluded: bytes) -> np.ndarray:
    """The bytes words are made of: all but the excluded ones."""
    table = np.ones(256, bool)
    table[list(excluded)] = False
    return table


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly (the finaliser of splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of many texts: where they stand in ``data`` (lower-cased in A-Z), their 64-bit hashes,
    and how many each text has.

    Characters beyond ASCII are word characters, so that words can be told by bytes. A byte's code
    depends on its place in the word; the sum of the codes is mixed.
    """

    def __init__(self, texts: list[str], word_bytes: np.ndarray):
        encoded = [text.encode("utf-8", "surrogatepass") for text in texts]
        self.data = UPPER_TO_LOWER[np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)]
        inside = word_bytes[self.data]
        edges = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
        self.starts, self.lengths = edges[::2], edges[1::2] - edges[::2]
        bounds = np.cumsum([0] + [len(e) + 1 for e in encoded])
        self.counts = np.diff(np.searchsorted(self.starts, bounds))
        self.hashes = np.empty(0, np.uint64)
        if len(self.starts):
            first = np.cumsum(self.lengths) - self.lengths
            place = np.arange(first[-1] + self.lengths[-1]) - np.repeat(first, self.lengths)
            codes = BYTE_CODES.ravel()[(place % PLACES) * 256 + self.data[inside]]
            if self.lengths.max() > PLACES:
                codes *= (2 * (place // PLACES) + 1).astype(np.uint64)
            self.hashes = mixed(np.add.reduceat(codes, first) + self.lengths.astype(np.uint64))


def word_hashes(texts: list[str], word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts, word_bytes)
    return words.hashes, words.counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of ``size`` words of a text, and their number per text.

    A text with fewer words has its whole sequence as its only one; one without words has none.
    Repeated shingles are not removed.
    """
    if not len(words):
        return words, counts
    padded = np.r_[words, np.zeros(size - 1, np.uint64)]
    sums = np.zeros(len(words), np.uint64)
    for j in range(size):
        sums += padded[j : j + len(words)] * SHINGLE_CODES[j]
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(len(words))  # words from here to the text's end
    short = (counts > 0) & (counts < size)
    for text in np.flatnonzero(short).tolist():  # fewer words than a shingle: a few additions each
        first = ends[text] - counts[text]
        own = words[first : ends[text]]
        sums[first] = (own * SHINGLE_CODES[: len(own)]).sum() + np.uint64(len(own))
    keep = left >= size
    keep[(ends - counts)[short]] = True
    return mixed(sums[keep]), np.where(short, 1, np.maximum(counts - size + 1, 0))
