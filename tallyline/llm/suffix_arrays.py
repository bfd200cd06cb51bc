"""Suffix arrays over the words of many texts, and the longest matches of other texts in them.

A word is its 64-bit hash. Suffixes are ordered by the codes of their words (the upper ``CODE_BITS`` bits of
the hashes), by prefix doubling: each round sorts by the ranks of two halves, packed with the place
itself into one number. Ordering ends at the first power of two that reaches the windows asked for;
how far a match goes beyond that is measured at its places, on whole hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallyline.llm.words import byte_class, word_hashes

CODE_BITS = 21  # two codes or ranks and a place share 63 bits
TEXT_END, ITEM_END = np.uint64(0), np.uint64(1)  # stand behind texts and items: never equal to each other or to a word
PAIRS_AT_ONCE = 1 << 20

# The bytes that end words: ASCII but for digits and letters.
BETWEEN_WORDS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
WORD_BYTES = byte_class(BETWEEN_WORDS)


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) and their number per text."""
    hashes, counts = word_hashes(texts, WORD_BYTES)
    return np.maximum(hashes, np.uint64(2)), counts


def with_ends(hashes: np.ndarray, counts: np.ndarray, end: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """All words with ``end`` before the first and behind each text, and where each text begins."""
    starts = np.cumsum(counts) - counts + np.arange(1, len(counts) + 1)
    words = np.full(len(hashes) + len(counts) + 1, end, np.uint64)
    words[np.arange(len(hashes)) + np.repeat(np.arange(1, len(counts) + 1), counts)] = hashes
    return words, starts


def codes_of(words: np.ndarray) -> np.ndarray:
    codes = np.maximum(words >> np.uint64(64 - CODE_BITS), np.uint64(1)).astype(np.int64)
    codes[words == TEXT_END] = 0
    return codes


class Items:
    """The texts that are looked for. Each suffix of at least ``window`` words is a query; a shorter text is
    one query as a whole."""

    def __init__(self, texts: list[str], window: int):
        hashes, counts = words_of(texts)
        self.words, starts = with_ends(hashes, counts, ITEM_END)
        self.codes = codes_of(self.words)
        need = np.minimum(counts, window)
        queries = np.where(need > 0, counts - need + 1, 0)
        self.item = np.repeat(np.arange(len(counts)), queries)
        self.offset = np.arange(len(self.item)) - np.repeat(np.cumsum(queries) - queries, queries)
        self.place = starts[self.item] + self.offset
        self.need = need[self.item]
        self.depth = int(need.max()) if len(need) else 0


class SuffixArray:
    """The places of all words of some texts, in the order of the words that follow there."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, depth: int):
        self.words, self.starts = with_ends(hashes, counts, TEXT_END)
        codes = codes_of(self.words)
        self.codes = np.append(codes, np.zeros(max(depth, 1), np.int64))  # whatever follows the last place
        size = len(codes)
        order, same = self._order(codes, self.codes[1 : size + 1])
        known = 2
        while known < depth:
            ranks = np.empty(size, np.int64)
            ranks[order] = np.cumsum(~same)
            later = np.zeros(size, np.int64)
            later[:-known] = ranks[known:]
            order, same = self._order(ranks, later)
            known *= 2
        self.order = order

    @staticmethod
    def _order(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places sorted by two numbers, and whether both are those of the place before."""
        size = len(first)
        if size < 1 << CODE_BITS:
            place = np.int64((1 << CODE_BITS) - 1)
            keys = first << np.int64(2 * CODE_BITS) | second << np.int64(CODE_BITS) | np.arange(size)
            keys.sort()
            order = keys & place
            keys >>= np.int64(CODE_BITS)
            same = np.append(False, keys[1:] == keys[:-1])
        else:  # one text alone may be longer than a shard
            order = np.lexsort((second, first))
            a, b = first[order], second[order]
            same = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1]))
        return order, same

    def ranges(self, items: Items, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query, the range of suffixes that begin with the codes of the words it needs, by
        binary search word after word."""
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), len(self.order))
        for k in range(int(items.need[queries].max()) if len(queries) else 0):
            going = np.flatnonzero((low < high) & (k < items.need[queries]))
            wanted = items.codes[items.place[queries[going]] + k]
            a, b = low[going], high[going]
            low[going], high[going] = self._bound(a, b, k, wanted), self._bound(a, b, k, wanted + 1)
        return low, high

    def _bound(self, low: np.ndarray, high: np.ndarray, k: int, wanted: np.ndarray) -> np.ndarray:
        """The first place of each range whose suffix has a code of at least ``wanted`` at its ``k``-th word."""
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            less = self.codes[self.order[middle] + k] < wanted[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        return low

    def matches(self, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Verbatim matches that can't be extended at either end: query, place of the first word, words."""
        found = [[np.empty(0, np.int64)] * 3]
        queries = np.arange(len(items.place))
        low, high = self.ranges(items, queries)
        sizes = high - low
        upto = np.cumsum(sizes)
        start = 0
        while start < len(queries) and upto[-1] > (upto[start - 1] if start else 0):
            before = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + PAIRS_AT_ONCE, side="right")))
            own = queries[start:end]
            step = np.arange(sizes[own].sum()) - np.repeat(upto[own] - sizes[own] - before, sizes[own])
            query = np.repeat(own, sizes[own])
            found.append(self._extended(items, query, self.order[low[query] + step]))
            start = end
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    def _extended(self, items: Items, query: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """Those pairs that no word before extends, with their whole lengths, if these are enough."""
        at = items.place[query]
        new = items.words[at - 1] != self.words[place - 1]  # place 0 is an end and begins no match
        query, place, at = query[new], place[new], at[new]
        length = np.zeros(len(query), np.int64)
        going = np.arange(len(query))
        while len(going):
            going = going[items.words[at[going] + length[going]] == self.words[place[going] + length[going]]]
            length[going] += 1
        long = length >= items.need[query]
        return [query[long], place[long], length[long]]


def shard_matches(pieces: Iterator[list[str]], items: Items) -> tuple[np.ndarray, ...]:
    """Word counts of the texts of one shard, and its matches: text, first word there, query, words."""
    parts = [words_of(texts) for texts in pieces]
    hashes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    array = SuffixArray(hashes, counts, items.depth)
    query, place, length = array.matches(items)
    order = np.argsort(place, kind="stable")
    query, place, length = query[order], place[order], length[order]
    text = np.searchsorted(array.starts, place, side="right") - 1
    return counts, text, place - array.starts[text], query, length
