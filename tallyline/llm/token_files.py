"""Token ids in files: documents compressed one by one with a shared zstandard dictionary.

A file is a table of blocks in ascending order of documents. A block holds up to ``BLOCK_DOCS``
documents: their ids and numbers of tokens, the compressed frames one after another, the offsets at
which each begins, how many ids the part of the range holds before them, and the hash of the
dictionary they need, so that one short document is read by its block's row and one frame. Blocks are Parquet rows and written by Spark's committer: a lost
task leaves nothing behind. A one-row table holds the dictionary itself.

The dictionary is trained on the serialized ids of a bounded sample (``SAMPLE_DOCS`` documents of at
most ``SAMPLE_CHARS`` characters, the ones with the smallest hashes); every document is encoded whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.llm.common import digest, in_chunks, read_bytes, row_key, ship_package, whole_text

SAMPLE_DOCS, SAMPLE_CHARS = 1000, 8000
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
BLOCK_DOCS, BLOCK_BYTES = 512, 4 << 20
KNOWN_WORDS = 300_000

# Texts with other white space than this, or with control characters that one library splits at and
# the other does not, go to the tokenizer whole; so do texts that may hold a special token.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]|<\\|")
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e\u0180-\u01bf\u01cd-\u024f"
SIGNS = "\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7\u2010-\u2027\u2030-\u205e"
SIMPLE = re.compile(f"[\t-\r\x20-\x7e{LETTERS}{SIGNS}]*")
# The tokenizer file's own split pattern, for the characters of SIMPLE.
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s0-9{LETTERS}]+")
# Bytes as characters, as byte-level tokenizers write them: printable ones stand for themselves, the others
# in their order for the characters from 256 on.
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_NAMES = {byte: 256 + n for n, byte in enumerate(sorted(set(range(256)) - set(PRINTED)))}
RAW = "\0"  # marks a chunk that is not split further here


class IdEncoder:
    """Ids as the tokenizers library gives them, with a bounded table of known words.

    The tokenizer drops white space and encodes word by word, so that a text's ids are those of its
    words. Words of common characters are split and lower-cased here, and unknown ones go to the library's
    model alone. Chunks with other characters go to the library as they are.
    """

    def __init__(self, tokenizer: bytes):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(tokenizer)
        settings = json.loads(tokenizer)
        steps = [step["type"] for step in settings["normalizer"]["normalizers"]]
        splits = [step["type"] for step in settings["pre_tokenizer"]["pretokenizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or splits != ["Split", "ByteLevel"]:
            raise ValueError("only byte-level tokenizers of lower-cased words are supported")
        self.model = self.library.model
        self.known: dict[str, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        """Words are lower-cased and split as the tokenizer does it, so that its model alone is asked."""
        for word in words:
            named = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_NAMES)
            self.known[word] = b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(named)])

    @staticmethod
    def split(text: str) -> list[str]:
        chunks = text.split()
        return [w for c in chunks for w in (WORDS.findall(c.lower()) if SIMPLE.fullmatch(c) else (RAW + c,))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers, without special ones."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        words: list[str] = []
        ends, whole = [], {}
        for at, text in enumerate(texts):
            if SIMPLE.fullmatch(text) and "<|" not in text:  # most texts: one look at their characters is enough
                words += WORDS.findall(text.lower())
            elif ODD_SPACE.search(text) or RAW in text:
                whole[at] = self._encode(text).tobytes()
            else:
                words += self.split(text)
            ends.append(len(words))
        found = list(map(self.known.get, words))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        new = dict.fromkeys(words[i] for i in unknown)
        self._learn([w for w in new if w[0] != RAW])
        self.known.update({w: self._encode(w[1:]).tobytes() for w in new if w[0] == RAW})
        for i in unknown:
            found[i] = self.known[words[i]]
        starts = [0, *ends]
        return [whole[at] if at in whole else b"".join(found[starts[at] : end]) for at, end in enumerate(ends)]


@lru_cache(maxsize=2)
def encoder_of(tokenizer: bytes) -> IdEncoder:
    return IdEncoder(tokenizer)


@lru_cache(maxsize=2)
def compressor_of(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


@lru_cache(maxsize=2)
def decompressor_of(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def train_dictionary(docs: DataFrame, tokenizer: bytes, end_id: int, doc_id: str = "doc_id", text: str = "text") -> bytes:
    """A dictionary from the bounded sample; empty (frames then need none) if the sample is too small."""
    short = docs.where(F.length(text) <= SAMPLE_CHARS).select(F.xxhash64(row_key(doc_id, text)).alias("key"), text)
    chosen = short.select("key").distinct().orderBy("key").limit(SAMPLE_DOCS)  # keys first: tasks send no texts that don't count
    texts = short.join(F.broadcast(chosen), "key").groupBy("key").agg(F.any_value(text).alias("text"))
    sample = [row["text"] for row in sorted(texts.collect())]
    end = end_id.to_bytes(4, "little")
    ids = [row + end for row in encoder_of(tokenizer).encode(sample)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, ids).as_bytes()
    except zstandard.ZstdError:
        return b""


BLOCK_TYPE = (
    "part int, block int, dictionary_sha256 string, doc_ids array<bigint>, n_tokens array<bigint>, "
    "offsets array<bigint>, frames binary, before bigint, total bigint"
)
BLOCK_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("dictionary_sha256", pa.string()), ("doc_ids", pa.list_(pa.int64())),
    ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("frames", pa.binary()), ("before", pa.int64()), ("total", pa.int64()),
])


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    partitions: int | None = None,
) -> None:
    """Writes the ids of every whole text, ``end_id`` after each, to ``folder`` in ascending order of ids.

    A null or empty text has the end id alone. Rows without an id come first. Rows that share an id
    are all written, in the order of their texts' hashes; an empty table gives files without blocks.
    """
    spark = docs.sparkSession
    ship_package(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    tokenizer = read_bytes(tokenizer_path)
    dictionary = train_dictionary(docs, tokenizer, end_id)
    name, end = digest(dictionary), end_id.to_bytes(4, "little")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, compressor = encoder_of(tokenizer), compressor_of(dictionary)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        ids, counts, frames, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            offsets = np.cumsum([0] + [len(f) for f in frames[:-1]]).tolist()
            row = [part, number, name, ids, counts, offsets, b"".join(frames), before, sum(counts)]
            return pa.RecordBatch.from_pylist([dict(zip(BLOCK_SCHEMA.names, row, strict=True))], BLOCK_SCHEMA)

        for batch in batches:
            numbers = iter(batch.column(0).to_pylist())
            for texts in in_chunks(batch.column(1)):
                for row in encoder.encode(texts):
                    frames.append(compressor.compress(row + end))
                    ids.append(next(numbers))
                    counts.append(len(row) // 4 + 1)
                    held += len(frames[-1])
                    if len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                        yield block()
                        before, number = before + sum(counts), number + 1
                        ids, counts, frames, held = [], [], [], 0
        if ids:
            yield block()

    order = ["doc_id", F.xxhash64("text")]
    ordered = docs.select("doc_id", whole_text("text").alias("text")).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(blocks, BLOCK_TYPE).write.mode("overwrite").parquet(f"{folder}/blocks")
    row = spark.createDataFrame([(name, bytearray(dictionary))], "dictionary_sha256 string, dictionary binary")
    row.write.mode("overwrite").parquet(f"{folder}/dictionary")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document in the files: its id, the number of ids before it in the whole order, its
    number of ids, and the ids as little-endian 32-bit integers. A block whose dictionary is another
    one than the files' fails."""
    ship_package(spark)
    name, dictionary = spark.read.parquet(f"{folder}/dictionary").first()
    dictionary = bytes(dictionary)
    blocks = spark.read.parquet(f"{folder}/blocks")
    # One row per part of the range: as many as the files were written in.
    totals = sorted(blocks.groupBy("part").agg(F.sum("total")).collect())
    before = np.cumsum([0] + [total for _, total in totals]).tolist()
    parts = spark.createDataFrame([(part, at) for (part, _), at in zip(totals, before, strict=False)], "part int, earlier bigint")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = decompressor_of(dictionary)
        for batch in batches:
            for row in range(batch.num_rows):
                values = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                if values["dictionary_sha256"] != name:
                    raise ValueError("a block needs another dictionary than the files hold")
                ends = [*values["offsets"][1:], len(values["frames"])]
                frames = [values["frames"][a:b] for a, b in zip(values["offsets"], ends, strict=True)]
                ids = [decompressor.decompress(frame) for frame in frames]
                counts = np.array(values["n_tokens"], np.int64)
                begins = values["earlier"] + values["before"] + np.cumsum(counts) - counts
                columns = [pa.array(values["doc_ids"], pa.int64()), pa.array(begins), pa.array(counts), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    return blocks.join(F.broadcast(parts), "part").mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
