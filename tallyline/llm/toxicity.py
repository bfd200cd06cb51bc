"""Toxicity scores: a recurrent network over all overlapping windows of a text.

A word enters the network as numbers from two sides: as a whole (its log-odds between toxic and other
training texts, and a learned vector of its hash bucket) and by its characters (the largest and the mean
log-odds of its runs of ``GRAM`` characters, and the mean of their learned vectors), so that unseen
forms of a known word are known by their parts. A text's score is that of its worst window.

Labels are learned from a bounded sample of the training rows (``SAMPLE`` of either label, of at most
``LONGEST`` characters), the ones with the smallest hashes. Log-odds of a training text's words come
from the other folds, so that the network learns how far to trust them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from tallyline.llm.common import give_back_memory, in_chunks, ship_package, whole_text
from tallyline.llm.recurrent import Adam, Weights, gradients, initial, logits, sigmoid
from tallyline.llm.words import BYTE_CODES, Words, mixed

WINDOW, STEP = 64, 48  # words
GRAM = 4  # bytes, of a word between end marks
SAMPLE, LONGEST = 1500, 20_000
FOLDS = 4
SEEN, PRIOR = 3, 1.0  # fewest texts for log-odds, and what is added to both counts
BUCKETS, LEARNED = 4096, 4
FIXED = 3
HIDDEN, ATTENTION = 8, 8
STEPS, TRAIN_BATCH, RATE, SLOW_RATE = 300, 64, 0.01, 0.001  # the slow rate is that of the learned vectors
SCORE_BATCH = 2048

WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
END_MARK = 95


class Odds:
    """Log-odds by hash; 0 for hashes seen too seldom."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        self.hashes, self.values = hashes, values.astype(np.float32)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.float32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.values[at], 0)

    @classmethod
    def counted(cls, texts: list[np.ndarray], labels: np.ndarray) -> Odds:
        """From the distinct hashes of each text."""
        hashes = np.concatenate([np.empty(0, np.uint64), *texts])
        label = np.repeat(labels, [len(t) for t in texts]).astype(bool)
        keys, inverse = np.unique(hashes, return_inverse=True)
        ones = np.bincount(inverse[label], minlength=len(keys))
        zeros = np.bincount(inverse[~label], minlength=len(keys))
        often = ones + zeros >= SEEN
        ones, zeros = ones[often], zeros[often]
        rates = (ones + PRIOR) / (labels.sum() + 2 * PRIOR), (zeros + PRIOR) / ((1 - labels).sum() + 2 * PRIOR)
        return cls(keys[often], np.log(rates[0] / rates[1]))


class Read:
    """The words of some texts as the network takes them: distinct words, their grams, and windows."""

    def __init__(self, texts: list[str]):
        words = Words(texts, WORD_BYTES)
        self.counts = words.counts
        self.hashes, first, self.index = np.unique(words.hashes, return_index=True, return_inverse=True)
        lengths = words.lengths[first]
        self.grams_of = np.maximum(lengths + 2 - GRAM + 1, 1)
        self.gram_starts = np.cumsum(self.grams_of) - self.grams_of
        word = np.repeat(np.arange(len(first)), self.grams_of)
        place = np.arange(len(word)) - self.gram_starts[word]
        codes = np.zeros(len(word), np.uint64)
        for j in range(GRAM):
            at = place + j - 1  # the end mark comes before the first byte
            inside = (at >= 0) & (at < lengths[word])
            byte = np.where(inside, words.data[np.where(inside, words.starts[first][word] + at, 0)], END_MARK)
            codes += np.where(at <= lengths[word], BYTE_CODES[j][byte], np.uint64(0))
        self.grams = mixed(codes)
        self._lay_windows()

    def _lay_windows(self) -> None:
        """Every window as a row of word numbers, padded with the number after the last."""
        count = 1 + np.maximum(0, -(-(self.counts - WINDOW) // STEP))
        self.text = np.repeat(np.arange(len(self.counts)), count)
        first = np.cumsum(count) - count
        begin = (np.arange(len(self.text)) - first[self.text]) * STEP
        self.lengths = np.clip(self.counts[self.text] - begin, 0, WINDOW)
        at = (np.cumsum(self.counts) - self.counts)[self.text] + begin
        cells = at[:, None] + np.arange(WINDOW)
        padded = np.append(self.index, len(self.hashes))
        self.windows = padded[np.where(np.arange(WINDOW) < self.lengths[:, None], cells, len(self.index))].astype(np.int32)

    def by_word(self, values: np.ndarray, how: np.ufunc) -> np.ndarray:
        return how.reduceat(values, self.gram_starts, axis=0) if len(self.hashes) else values

    def fixed_inputs(self, words: Odds, grams: Odds) -> np.ndarray:
        own = grams.of(self.grams)
        columns = words.of(self.hashes), self.by_word(own, np.maximum), self.by_word(own, np.add) / self.grams_of
        return np.column_stack(columns).astype(np.float32)

    def inputs(self, fixed: np.ndarray, weights: Weights, some: np.ndarray | None = None) -> np.ndarray:
        """One row per distinct word (or some of them) and one of zeros for padding."""
        some = np.arange(len(self.hashes)) if some is None else some
        cells, starts = self.gram_cells(some)
        word_vectors = weights["words"][self.hashes[some] % np.uint64(BUCKETS)]
        gram_vectors = weights["grams"][self.grams[cells] % np.uint64(BUCKETS)]
        means = np.add.reduceat(gram_vectors, starts, axis=0) / self.grams_of[some, None] if len(some) else gram_vectors
        rows = np.hstack([fixed[some], word_vectors, means])
        return np.vstack([rows, np.zeros((1, FIXED + 2 * LEARNED))]).astype(np.float32)

    def gram_cells(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of some words' grams, one word after another, and where each word's begin among them."""
        counts = self.grams_of[some]
        starts = np.cumsum(counts) - counts
        return np.repeat(self.gram_starts[some] - starts, counts) + np.arange(counts.sum()), starts

    def window_scores(self, rows: np.ndarray, weights: Weights, windows: np.ndarray) -> np.ndarray:
        out = np.empty(len(windows), np.float32)
        for start in range(0, len(windows), SCORE_BATCH):
            some = windows[start : start + SCORE_BATCH]
            longest = max(1, int(self.lengths[some].max()))
            out[start : start + SCORE_BATCH] = logits(weights, rows, self.windows[some, :longest], self.lengths[some])
        return out


class Model:
    """Fitted on texts and labels; without both labels it scores every text alike."""

    def __init__(self, texts: list[str], labels: list[int]):
        self.labels = np.array(labels, int)
        self.constant = None if 0 < self.labels.sum() < len(self.labels) else float(len(labels) > 0 and bool(labels[0]))
        if self.constant is None:
            self._fit(texts)

    def _fit(self, texts: list[str]) -> None:
        read = Read(texts)
        word_text = np.repeat(np.arange(len(texts)), read.counts)
        bounds = np.searchsorted(word_text, np.arange(len(texts) + 1))
        distinct = [np.unique(read.index[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        words = [read.hashes[d] for d in distinct]
        grams = []
        for d in distinct:
            grams.append(np.unique(read.grams[read.gram_cells(d)[0]]))
        fold = np.where(self.labels == 1, np.cumsum(self.labels), np.cumsum(1 - self.labels)) % FOLDS  # each label in all folds
        self.words, self.grams = Odds.counted(words, self.labels), Odds.counted(grams, self.labels)
        fixed = []
        for f in range(FOLDS):
            others = np.flatnonzero(fold != f)
            pick = [Odds.counted([x[i] for i in others], self.labels[others]) for x in (words, grams)]
            fixed.append(read.fixed_inputs(*pick))
        random = np.random.default_rng(11)
        weights = initial(FIXED + 2 * LEARNED, HIDDEN, ATTENTION)
        weights |= {k: np.zeros((BUCKETS, LEARNED), np.float32) for k in ("words", "grams")}
        share = self.labels.mean()
        weights["oc"][:] = np.log(share / (1 - share))  # what a window without words starts from
        self.weights, adam = weights, Adam(weights, RATE, {"words": SLOW_RATE, "grams": SLOW_RATE})
        weight = np.where(self.labels == 1, np.sqrt((1 - share) / share), 1.0)
        while adam.steps < STEPS:
            worst, spare = self._windows_to_learn(read, fixed, fold, random)
            chosen = random.permutation(np.concatenate([worst, spare]))
            batches = [part[at : at + TRAIN_BATCH] for f in range(FOLDS) for part in [chosen[fold[read.text[chosen]] == f]]
                       for at in range(0, len(part), TRAIN_BATCH)]
            for at in random.permutation(len(batches)).tolist()[: STEPS - adam.steps]:
                f = fold[read.text[batches[at][0]]]
                self._learn(read, fixed[f], batches[at], weight, adam)

    def _windows_to_learn(self, read: Read, fixed: list, fold: np.ndarray, random) -> tuple[np.ndarray, np.ndarray]:
        """The worst window of every text by the present weights, and one more of each text that is not toxic."""
        scores = np.empty(len(read.text), np.float32)
        for f in range(FOLDS):
            own = np.flatnonzero(fold[read.text] == f)
            scores[own] = read.window_scores(read.inputs(fixed[f], self.weights), self.weights, own)
        order = np.lexsort((-scores, read.text))
        worst = order[np.r_[True, read.text[order][1:] != read.text[order][:-1]]]
        counts = np.bincount(read.text)
        first = np.cumsum(counts) - counts
        spare = first + (random.random(len(counts)) * counts).astype(int)
        return worst, spare[self.labels == 0]

    def _learn(self, read: Read, fixed: np.ndarray, chosen: np.ndarray, weight: np.ndarray, adam: Adam) -> None:
        used, index = np.unique(read.windows[chosen], return_inverse=True)
        index, used = index.reshape(-1, WINDOW), used[used < len(read.hashes)]
        lengths, text = read.lengths[chosen], read.text[chosen]
        longest = max(1, int(lengths.max()))
        rows, index = read.inputs(fixed, self.weights, used), index[:, :longest]
        out, kept = logits(self.weights, rows, index, lengths, keep=True)
        error = ((sigmoid(out) - self.labels[text]) * weight[text] / len(chosen)).astype(np.float32)
        slopes, d_rows = gradients(self.weights, rows, index, kept, error)
        d_rows = d_rows[:-1]
        cells, _ = read.gram_cells(used)
        share = np.repeat(d_rows[:, FIXED + LEARNED :] / read.grams_of[used, None], read.grams_of[used], axis=0)
        for name, hashes, slope in (("words", read.hashes[used], d_rows[:, FIXED : FIXED + LEARNED]), ("grams", read.grams[cells], share)):
            slopes[name] = np.zeros_like(self.weights[name])
            np.add.at(slopes[name], (hashes % np.uint64(BUCKETS)).astype(int), slope)
        adam.step(slopes)

    def scores(self, texts: list[str]) -> np.ndarray:
        """The score of each text: that of its worst window, all of them looked at."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        read = Read(texts)
        rows = read.inputs(read.fixed_inputs(self.words, self.grams), self.weights)
        every = read.window_scores(rows, self.weights, np.arange(len(read.text)))
        starts = np.flatnonzero(np.r_[True, read.text[1:] != read.text[:-1]])
        return sigmoid(np.maximum.reduceat(every, starts).astype(np.float64))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept out of training: one in five by its id; rows without an id are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from the labelled rows that are not held out.

    Null labels and rows without an id teach nothing; of a repeated id each text is learned with its
    label. Fitting runs on the driver, on the bounded sample alone.
    """
    ids = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    ids = ids.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id")).distinct()
    texts = docs.select(F.col(doc_id).alias("id"), whole_text(text).alias("text")).where(F.length("text") <= LONGEST)
    known = texts.select("id", F.xxhash64("id", "text").alias("hash")).join(ids, "id")
    chosen = [known.where(F.col("label") == value).orderBy("hash", "id").limit(SAMPLE) for value in (0, 1)]
    picked = chosen[0].unionByName(chosen[1])  # at most 2 x SAMPLE rows of three numbers
    picked = picked.toPandas()
    some = docs.sparkSession.createDataFrame(picked, "id bigint, hash bigint, label int")
    keyed = texts.withColumn("hash", F.xxhash64("id", "text")).join(F.broadcast(some.select("id", "hash")), ["id", "hash"])
    found = {(row["id"], row["hash"]): row["text"] for row in keyed.toLocalIterator()}
    rows = [(found[id_, hash_], label) for id_, hash_, label in picked.itertuples(index=False)]
    return Model([text for text, _ in rows], [label for _, label in rows])


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Adds the score of the whole text, from 0 to 1; null and empty texts have that of a window without
    words. Rows are independent; an input column named as the new one is replaced."""

    ship_package(docs.sparkSession)

    @arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [model.scores(texts) for texts in in_chunks(batch)]
            yield pa.array(np.concatenate([np.empty(0), *parts]), pa.float64())
        give_back_memory()

    return docs.withColumn(score, scored(whole_text(text)))
