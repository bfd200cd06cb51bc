"""SentencePiece encoding (byte-pair models) and decoding.

A byte-pair model without pieces across word starts lets every word (a run of ``▁`` and what
follows it) be encoded alone. The words of many texts lie in one flat numpy array of symbols; each
round takes the best pair of every word at once, merges its leftmost occurrences and compacts the
array, until no pair is left. Words seen before come from a bounded table per worker.

Exactness: merging every occurrence of a word's best pair in one round equals the library's order
unless a better pair can begin or end with the merged piece. For such pieces (found when the model
is read) only the leftmost occurrence is merged per round. Words of more than ``LONG_WORD`` symbols
go through an ordered agenda instead, whose cost does not grow with their square.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from tallyline.llm.common import give_back_memory, in_chunks, read_bytes, ship_package, whole_text

SPACE = "▁"
LONG_WORD = 512
KNOWN_WORDS = 200_000
NO_RANK = np.iinfo(np.int32).max
PROBES = ("", " ", "Two  spaces, 3 words\n", "é日本 x" + SPACE + "y", "\x00<s>")


class PairTable:
    """Open addressing from a pair of symbols to the piece they form, looked up by arrays."""

    def __init__(self, pairs: dict[int, int]):
        bits = max(10, (len(pairs) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        for key, slot, value in zip(keys.tolist(), self._slots(keys).tolist(), pairs.values(), strict=True):
            while self.keys[slot] != -1:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.values[slot] = key, value

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = pair_key(left, right)
        slots = self._slots(keys)
        held = self.keys[slots]
        found = np.where(held == keys, self.values[slots], -1)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            held = self.keys[slots[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return found


def pair_key(left, right):
    return (left.astype(np.int64) << 21) | right


class PieceModel:
    """A byte-pair model read through the sentencepiece library, with its own encoder."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.size = size = library.get_piece_size()
        self.begin, self.end = library.bos_id(), library.eos_id()
        plain = [
            i for i in range(size)
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
        ]
        self.id_of = {library.id_to_piece(i): i for i in plain}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.id_of):
            raise ValueError("the model has pieces across word starts: its words can't be encoded alone")
        scores = np.array([library.get_score(i) for i in range(size)])
        self.rank = np.full(size + 1, NO_RANK, np.int32)  # the last entry stands for "no piece"
        self.rank[plain] = np.unique(-scores[plain], return_inverse=True)[1]
        self.byte_ids = np.array([library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        # A character without a piece gets a symbol beyond all pieces.
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + size
        for piece, i in self.id_of.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        self._read_pairs()
        self.forget()
        for text in PROBES:
            if np.frombuffer(self.encode([text])[0], np.int32).tolist() != library.encode(text, add_bos=True, add_eos=True):
                raise ValueError("the model's settings (normalisation, prefix) are not supported")

    def _read_pairs(self) -> None:
        pairs: dict[int, int] = {}
        longer = np.full(self.size, NO_RANK, np.int64)
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                left, right = (self.id_of.get(part) for part in (piece[:cut], piece[cut:]))
                for part in (left, right):
                    if part is not None:
                        longer[part] = min(longer[part], self.rank[i])
                if left is not None and right is not None:
                    pairs[(left << 21) | right] = i
        self.pairs = PairTable(pairs)
        self.pair_of = pairs
        self.one_at_a_time = longer <= self.rank[:-1]

    def forget(self) -> None:
        """Empty the table of known words."""
        self.known: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)

    # Words

    def _formed(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.pairs.find(symbols[at], symbols[at + 1])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has."""
        short = [w if len(w) <= LONG_WORD else "" for w in words]
        lengths = np.fromiter(map(len, short), np.int64, len(short))
        points = np.frombuffer("".join(short).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols, word = self._merge(self.symbol_of[points], np.repeat(np.arange(len(short)), lengths))
        for at, text in enumerate(words):
            if len(text) > LONG_WORD:
                own = self._merge_long(text)
                place = np.searchsorted(word, at)
                symbols = np.insert(symbols, place, own)
                word = np.insert(word, place, np.full(len(own), at))
        return self._with_bytes(symbols, word, len(words))

    def _merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        finished = []
        formed = np.full(len(symbols), -1, np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        formed[inside] = self._formed(symbols, inside)
        rank = self.rank[formed]
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, starts)
            active = best != NO_RANK
            sizes = np.diff(np.r_[starts, len(symbols)])
            if 2 * active.sum() <= len(starts):
                stay = np.repeat(active, sizes)
                finished.append((symbols[~stay], word[~stay]))
                symbols, word, formed, rank = symbols[stay], word[stay], formed[stay], rank[stay]
                continue
            at = np.flatnonzero((rank == np.repeat(best, sizes)) & (rank != NO_RANK))
            at = at[self._leftmost(at, word[at], formed[at])]
            symbols[at] = formed[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            now = at - np.arange(len(at))  # one symbol is gone for each merge further left
            symbols, word, formed, rank = symbols[keep], word[keep], formed[keep], rank[keep]
            changed = np.zeros(len(symbols), bool)
            changed[now] = changed[now[now > 0] - 1] = True
            touched = np.flatnonzero(changed)
            formed[touched], rank[touched] = -1, NO_RANK
            touched = touched[touched + 1 < len(word)]
            touched = touched[word[touched] == word[touched + 1]]
            formed[touched] = self._formed(symbols, touched)
            rank[touched] = self.rank[formed[touched]]
        if not finished:
            return symbols, word
        symbols, word = (np.concatenate(parts) for parts in zip(*finished, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _leftmost(self, at: np.ndarray, word: np.ndarray, formed: np.ndarray) -> np.ndarray:
        """Which of the best pairs are merged now: of overlapping ones every second, counted from the left."""
        new_word = np.r_[True, word[1:] != word[:-1]]
        new_run = new_word | np.r_[True, at[1:] != at[:-1] + 1]
        index = np.arange(len(at))
        in_run = index - np.maximum.accumulate(np.where(new_run, index, 0))
        first = np.maximum.accumulate(np.where(new_word, index, 0))
        # Pieces of one word in a round have one rank; equal ranks of different pieces go one at a time too.
        careful = np.logical_or.reduceat(self.one_at_a_time[formed] | (formed != formed[first]), np.flatnonzero(new_word))
        return np.where(np.repeat(careful, np.diff(np.r_[np.flatnonzero(new_word), len(at)])), new_word, in_run % 2 == 0)

    def _merge_long(self, text: str) -> np.ndarray:
        """One long word: an agenda of pairs ordered by rank, then place."""
        symbols = self.symbol_of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].tolist()
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(symbols):
                piece = self.pair_of.get((symbols[left] << 21) | symbols[right])
                if piece is not None:
                    heapq.heappush(agenda, (int(self.rank[piece]), left, symbols[left], symbols[right]))

        for left in range(len(symbols) - 1):
            offer(left, left + 1)
        while agenda:
            _, left, first, second = heapq.heappop(agenda)
            right = after[left]
            if symbols[left] != first or right >= len(symbols) or symbols[right] != second:
                continue
            symbols[left], symbols[right] = self.pair_of[(first << 21) | second], -1
            after[left] = after[right]
            if after[right] < len(symbols):
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return np.array([s for s in symbols if s >= 0], np.int32)

    def _with_bytes(self, symbols: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become their bytes' ids."""
        odd = np.flatnonzero(symbols >= self.size)
        if len(odd):
            texts = [chr(s - self.size).encode("utf-8", "replace") for s in symbols[odd].tolist()]
            width = np.ones(len(symbols), np.int64)
            width[odd] = [len(t) for t in texts]
            place = np.flatnonzero(np.repeat(symbols >= self.size, width))
            symbols, word = np.repeat(symbols, width), np.repeat(word, width)
            symbols[place] = self.byte_ids[np.frombuffer(b"".join(texts), np.uint8)]
        return symbols.astype(np.int32), np.bincount(word, minlength=words)

    # Texts

    @staticmethod
    def split(text: str) -> list[str]:
        """The words of a text as keys of the table: a word after one ``▁`` without it, others with one more."""
        if not text:
            return []
        if "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        words = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + text.replace(" ", SPACE))
        return [w[1:] if len(w) > 1 and w[1] != SPACE else SPACE + w for w in words]

    def _learn(self, keys: list[str]) -> None:
        ids, counts = self.encode_words([k[1:] if k[0] == SPACE else SPACE + k for k in keys])
        old = len(self.known)
        used = self.ends[old]
        if old + len(keys) >= len(self.ends):
            self.ends = np.resize(self.ends, 2 * (old + len(keys)))
        if used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (used + len(ids)))
        self.flat[used : used + len(ids)] = ids
        self.ends[old + 1 : old + 1 + len(keys)] = used + np.cumsum(counts)
        self.known.update(zip(keys, range(old, old + len(keys)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text between the begin and end ids."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        words: list[str] = []
        ends = []
        for text in texts:
            words += self.split(text)
            ends.append(len(words))
        index = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(index < 0).tolist()
        if new:
            self._learn(list(dict.fromkeys(words[i] for i in new)))
            index[new] = [self.known[words[i]] for i in new]
        begins = self.ends[index]
        counts = self.ends[index + 1] - begins
        total = np.r_[0, np.cumsum(counts)]
        ids = self.flat[np.repeat(begins - total[:-1], counts) + np.arange(total[-1])].astype("<i4")
        head, tail = (np.array([i], "<i4").tobytes() for i in (self.begin, self.end))
        bounds = total[np.r_[0, ends]].tolist()
        return [head + ids[a:b].tobytes() + tail for a, b in zip(bounds, bounds[1:], strict=False)]

    def decode(self, rows: list[bytes]) -> list[str]:
        return self.library.decode([np.frombuffer(row, "<i4").tolist() for row in rows])


@lru_cache(maxsize=2)
def model_of(proto: bytes) -> PieceModel:
    return PieceModel(proto)


def encode_pieces(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the column ``ids``: the ids of the whole text as little-endian 32-bit integers in a binary value.

    Null and empty texts have the begin and end ids alone. Rows are independent, so repeated rows
    and any other columns stay as they are; a column already named ``ids`` is replaced.
    """
    ship_package(df.sparkSession)
    proto = read_bytes(model_path)

    @arrow_udf("binary")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_of(proto)
        for batch in batches:
            yield pa.array((row for texts in in_chunks(batch) for row in model.encode(texts)), pa.binary())

    return df.withColumn(ids, encoded(whole_text(text)))


def decode_pieces(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the column ``text`` decoded from ids as ``encode_pieces`` writes them; null ids give null."""
    ship_package(df.sparkSession)
    proto = read_bytes(model_path)

    @arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_of(proto)
        for batch in batches:
            filled = batch.fill_null(b"")
            texts = [text for rows in in_chunks(filled) for text in model.decode(rows)]
            yield pa.array(texts, pa.string(), mask=batch.is_null().to_numpy(zero_copy_only=False))

    return df.withColumn(text, decoded(F.col(ids)))


DIGEST_TYPE = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digest_pieces(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of ``encode_pieces`` and ``decode_pieces``
    without sending ids and decoded texts back: a worker holds about a megabyte of text at a time.
    Input columns of these names are replaced."""
    ship_package(df.sparkSession)
    proto = read_bytes(model_path)

    @arrow_udf(DIGEST_TYPE)
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_of(proto)
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for texts in in_chunks(batch):
                rows = model.encode(texts)
                counts += [len(row) // 4 for row in rows]
                encoded += [hashlib.sha256(row).hexdigest() for row in rows]
                decoded += [hashlib.sha256(t.encode()).hexdigest() for t in model.decode(rows)]
            parts = pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())
            yield pa.StructArray.from_arrays(parts, ["n_tokens", "ids_sha256", "decoded_sha256"])
        model.forget()
        give_back_memory()

    out = df.withColumn("__digests", digests(whole_text(text)))
    for name in ("n_tokens", "ids_sha256", "decoded_sha256"):
        out = out.withColumn(name, F.col("__digests")[name])
    return out.drop("__digests")
