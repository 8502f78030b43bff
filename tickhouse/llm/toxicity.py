"""Toxicity scores from subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with marks at both ends) and itself, hashed to a
fixed number of embedding rows; a misspelling never seen shares most of its n-grams with the word
it comes from. The vectors of the n-grams are averaged to a word, the distinct words to a stretch
of ``STRETCH`` consecutive words (missing ones count as zero vectors), and a softmax over two classes reads the stretch. A document is as
toxic as its most toxic stretch, so a few words count in a text of any length; training looks at
that stretch, too. The final score is a logistic curve of that stretch's logit, fitted to a part of the
sample that the embeddings have not seen; where they have learned nothing it is the base rate.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm.arrays import Rolling, lower, ranges, text_blocks, word_spans

# Documented bounds of the training sample: about so many labelled documents, at most so many bytes.
TRAIN_DOCS = 10_000
TRAIN_BYTES = 48 << 20

BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (3, 4, 5)
STRETCH = 16
EPOCHS = 30
MAX_EPOCHS = 40
MIN_TEXTS = 5
RATE = 0.1
# Share of the largest root mean square that every gradient's is raised by: rare buckets learn less.
FLOOR = 0.05
DECAY = 1e-4


class Words:
    """The distinct words of a block of texts as bags of buckets, and where they stand."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, buckets: int = BUCKETS):
        data = lower(data)
        first, end, self.per_text = word_spans(data, starts, alnum=True)
        hashes = Rolling(data, 1).between(first, end)
        self.hashes, where, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.bag, self.bag_start = bags(data, first[where], end[where], buckets)

    def values(self, per_bucket: np.ndarray) -> np.ndarray:
        """The mean of the buckets' values for every distinct word."""
        return bag_means(per_bucket, self.bag, self.bag_start)


def bag_means(per_bucket, bag, bag_start):
    if not len(bag_start) - 1:
        return np.empty(0)
    return np.add.reduceat(per_bucket[bag], bag_start[:-1]) / np.diff(bag_start)


def bags(data: np.ndarray, first: np.ndarray, end: np.ndarray, buckets: int):
    """The buckets of every word: (buckets, where each word's start, and their total)."""
    length = end - first
    if not len(length):
        return np.empty(0, np.int64), np.zeros(1, np.int64)
    marked = np.full(int((length + 2).sum()), ord("<"), np.uint8)
    begin = np.cumsum(length + 2) - length - 2
    marked[ranges(begin + 1, length)] = data[ranges(first, length)]
    marked[begin + length + 1] = ord(">")
    rolling = Rolling(marked, 4)
    names = [rolling.between(begin, begin + length + 2)]
    owners = [np.arange(len(length))]
    for n in GRAMS:
        per_word = np.maximum(length + 2 - n + 1, 0)
        at = ranges(begin, per_word)
        names.append(rolling.between(at, at + n))
        owners.append(np.repeat(np.arange(len(length)), per_word))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    bag = (np.concatenate(names)[order] % np.uint64(buckets)).astype(np.int64)
    counts = np.bincount(owner, minlength=len(length))
    return bag, np.concatenate([[0], np.cumsum(counts)])


def stretches(per_text: np.ndarray, word: np.ndarray, size: int = STRETCH):
    """Each word once per stretch: (its stretch, the word), ascending, and the text of each stretch."""
    n = -(-per_text // size)
    text = np.repeat(np.arange(len(per_text)), n)
    place = np.arange(len(word)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    stretch = np.repeat(np.cumsum(n) - n, per_text) + place // size
    words = int(word.max(initial=0)) + 1
    key = np.unique(stretch * words + word)
    return key // words, key % words, text


class Model:
    """Embeddings, the softmax over (clean, toxic) and the curve from logit to score."""

    def __init__(self, embeddings, weights, bias, slope=1.0, shift=0.0, prior=None):
        self.embeddings, self.weights, self.bias = embeddings, weights, bias
        self.slope, self.shift, self.prior = slope, shift, prior
        self.per_bucket = (embeddings @ (weights[:, 1] - weights[:, 0])).astype(np.float64)

    def peaks(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The logit of the most toxic stretch of every text; of no words, the bias alone."""
        words = Words(data, starts, len(self.embeddings))
        bias = float(self.bias[1] - self.bias[0])
        out = np.full(len(starts) - 1, bias)
        if len(words.word):
            stretch, word, text = stretches(words.per_text, words.word)
            total = np.bincount(stretch, words.values(self.per_bucket)[word], len(text))
            top = np.full(len(out), -np.inf)
            np.maximum.at(top, text, total / STRETCH + bias)
            out = np.where(words.per_text > 0, top, out)
        return out

    def scores(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(starts) - 1, self.prior)
        return sigmoid(self.slope * self.peaks(data, starts) + self.shift)

    def to_bytes(self) -> bytes:
        held = io.BytesIO()
        prior = np.array([] if self.prior is None else [self.prior])
        curve = np.array([self.slope, self.shift])
        np.savez(held, e=self.embeddings, w=self.weights, b=self.bias, c=curve, p=prior)
        return held.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "Model":
        got = np.load(io.BytesIO(raw))
        prior = float(got["p"][0]) if len(got["p"]) else None
        return cls(got["e"], got["w"], got["b"], *map(float, got["c"]), prior)

    @classmethod
    def constant(cls, prior: float) -> "Model":
        return cls(np.zeros((1, DIMENSIONS), np.float32), np.zeros((DIMENSIONS, 2)), np.zeros(2), prior=prior)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Adam:
    def __init__(self, value, rate=RATE):
        self.value, self.rate, self.step = value, rate, 0
        self.mean, self.square = np.zeros_like(value), np.zeros_like(value)

    def descend(self, gradient):
        self.step += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.01 * (gradient**2 - self.square)
        mean = self.mean / (1 - 0.9**self.step)
        size = np.sqrt(self.square / (1 - 0.99**self.step))
        self.value -= self.rate * mean / (size + FLOOR * size.max() + 1e-12)


class Sample:
    """The training texts as numbers, gathered block by block to keep no text."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.labels = np.empty(0)
        self.blocks: list[tuple[np.ndarray, ...]] = []
        self.texts = self.stretches = 0

    def add(self, data: np.ndarray, starts: np.ndarray, labels: np.ndarray):
        words = Words(data, starts, self.buckets)
        stretch, word, text = stretches(words.per_text, words.word)
        seen = np.unique(np.repeat(np.arange(len(labels)), words.per_text) * (len(words.hashes) + 1) + words.word)
        self.blocks.append(
            (
                words.hashes,
                words.bag.astype(np.int32),
                np.diff(words.bag_start).astype(np.int32),
                np.bincount(seen % (len(words.hashes) + 1), minlength=len(words.hashes)),
                (stretch + self.stretches).astype(np.int32),
                word.astype(np.int32),
                (text + self.texts).astype(np.int32),
            )
        )
        self.texts += len(labels)
        self.stretches += len(text)
        self.labels = np.concatenate([self.labels, labels])

    def close(self, min_texts: int):
        """Merge the blocks; buckets seen in fewer than ``min_texts`` texts leave the bags."""
        hashes, bag, size, texts, stretch, word, text = zip(*self.blocks)
        self.blocks.clear()
        names, first, where = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        n = len(names)
        edges = np.cumsum([0, *map(len, hashes)])
        self.word = np.concatenate([where[e + w] for e, w in zip(edges, word)]).astype(np.int32)
        self.stretch, self.text = np.concatenate(stretch), np.concatenate(text)
        texts_of_word = np.bincount(where, np.concatenate(texts), n)
        size, bag = np.concatenate(size), np.concatenate(bag)
        begin = np.cumsum(size, dtype=np.int64) - size
        self.size = size[first]
        self.bag = bag[ranges(begin[first], self.size.astype(np.int64))]
        self.owner = np.repeat(np.arange(n, dtype=np.int32), self.size)
        self.common = np.bincount(self.bag, texts_of_word[self.owner], self.buckets) >= min_texts
        kept = self.common[self.bag]
        self.bag, self.owner = self.bag[kept], self.owner[kept]
        return self

    def word_values(self, per_bucket):
        return np.bincount(self.owner, per_bucket[self.bag], len(self.size)) / self.size

    def to_buckets(self, per_word):
        return np.bincount(self.bag, (per_word / self.size)[self.owner], self.buckets)

    def stretch_values(self, per_word):
        return np.bincount(self.stretch, per_word[self.word], len(self.text)) / STRETCH

    def to_words(self, per_stretch):
        return np.bincount(self.word, per_stretch[self.stretch], len(self.size)) / STRETCH


def train(
    texts, buckets=BUCKETS, epochs=EPOCHS, max_epochs=MAX_EPOCHS, seed=0, min_texts=MIN_TEXTS
) -> Model:
    """Fit embeddings and softmax together on blocks (data, starts, labels) of labelled texts.

    First every stretch carries the label of its text; then each text is represented by the
    stretch that the model finds most toxic. Both classes weigh the same. Every fifth text only
    fits the curve, if both classes are in either part.
    """
    sample, apart = Sample(buckets), []
    for data, starts, labels in texts:
        labels = np.asarray(labels, float)
        fifth = (np.arange(len(labels)) + sample.texts + sum(len(x[2]) for x in apart)) % 5 == 4
        sample.add(*take(data, starts, ~fifth), labels[~fifth])
        apart.append((*take(data, starts, fifth), labels[fifth]))
    labels = sample.labels
    judged = np.concatenate([x[2] for x in apart]) if apart else np.empty(0)
    both = np.concatenate([labels, judged])
    if len(set(labels)) < 2 or not sample.stretches:
        return Model.constant(float(both.mean()) if len(both) else 0.0)
    sample.close(min_texts)
    random = np.random.default_rng(seed)
    table = Adam(random.normal(0, 0.1, (buckets, DIMENSIONS)) * sample.common[:, None])
    softmax = Adam(random.normal(0, 0.1, (DIMENSIONS, 2)))
    bias = Adam(np.zeros(2))

    def balanced(y):
        positive = max(y.mean(), 1e-9)
        return np.where(y > 0, 0.5 / positive, 0.5 / max(1 - positive, 1e-9)) / len(y)

    for epoch in range(epochs + max_epochs):
        direction = softmax.value[:, 1] - softmax.value[:, 0]
        values = sample.word_values(table.value @ direction)
        logit = sample.stretch_values(values) + bias.value[1] - bias.value[0]
        if epoch < epochs:
            chosen = np.arange(len(logit))
        else:
            order = np.lexsort((-logit, sample.text))
            chosen = order[np.r_[True, np.diff(sample.text[order]) > 0]]
        y = labels[sample.text[chosen]]
        error = np.zeros(len(logit))
        error[chosen] = (sigmoid(logit[chosen]) - y) * balanced(y)
        per_bucket = sample.to_buckets(sample.to_words(error))
        down = per_bucket @ table.value
        table.descend(per_bucket[:, None] * direction + DECAY / buckets * table.value)
        softmax.descend(np.stack([-down, down], 1) + DECAY * softmax.value)
        bias.descend(np.array([-error.sum(), error.sum()]))
    model = Model(table.value.astype(np.float32), softmax.value, bias.value)
    if len(set(judged)) == 2:
        peaks = np.concatenate([model.peaks(data, starts) for data, starts, _ in apart])
        model.slope, model.shift = curve(peaks, judged)
    else:
        top = np.full(len(labels), model.bias[1] - model.bias[0], float)
        values = sample.word_values(model.per_bucket)
        np.maximum.at(top, sample.text, sample.stretch_values(values) + top[0])
        model.slope, model.shift = curve(top, labels)
    return model


def take(data: np.ndarray, starts: np.ndarray, rows: np.ndarray):
    """The bytes and starts of the chosen texts."""
    size = np.diff(starts)[rows]
    return data[ranges(starts[:-1][rows], size)], np.concatenate([[0], np.cumsum(size)])


def curve(peaks: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (at least a little upwards) and shift of a logistic curve, by Newton's method."""
    centre, spread = peaks.mean(), peaks.std() + 1e-9
    x = (peaks - centre) / spread
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * x + b)
        w = p * (1 - p) + 1e-9
        ga, gb = ((p - labels) * x).mean() + 1e-3 * a, (p - labels).mean()
        haa, hab, hbb = (w * x * x).mean() + 1e-3, (w * x).mean(), w.mean() + 1e-9
        det = haa * hbb - hab * hab
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    a = max(a, 1e-3)
    return a / spread, b - a * centre / spread


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> Model:
    """A model of ``labels`` (doc_id, toxic) on the texts of ``docs`` (doc_id, text).

    The sample is chosen by a hash of doc_id: about ``train_docs`` labelled documents, of which
    one task reads up to ``train_bytes`` of text. Null labels and doc_ids are left out, several
    labels of one document count as their largest. Without both classes the model is constant.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = train_docs / max(known.count(), train_docs)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    chosen = place < F.lit(int(share * (1 << 20)))
    sample = (
        docs.select("doc_id", "text")
        .where(chosen & F.col("text").isNotNull())
        .join(known.where(chosen), "doc_id")
        .select(F.xxhash64("doc_id").alias("place"), "text", F.col("toxic").cast("int").alias("toxic"))
        .repartition(1)
        .sortWithinPartitions("place", "text")
        .select("text", "toxic")
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0

        def texts():
            nonlocal held
            for batch in batches:
                for first, last, data, starts in text_blocks(batch):
                    if held + len(data) <= train_bytes:
                        held += len(data)
                        yield data, starts, batch.column(1).slice(first, last - first).to_pylist()

        yield pa.RecordBatch.from_arrays(
            [pa.array([train(texts()).to_bytes()], pa.binary())], names=["model"]
        )

    rows = sample.mapInArrow(learn, "model binary").collect()
    return Model.from_bytes(bytes(rows[0]["model"])) if rows else Model.constant(0.0)


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text and others) with ``score``, from 0 to 1, of every whole text.

    Null and empty texts get the score of no words; a column named ``score`` is replaced; every
    row is kept.
    """
    source = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model.to_bytes())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.from_bytes(shared.value)
        for batch in batches:
            for first, last, data, starts in text_blocks(batch):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(own.scores(data, starts), pa.float64())],
                    names=[*batch.schema.names, "score"],
                )

    schema = T.StructType([*source.schema, T.StructField("score", T.DoubleType())])
    return source.mapInArrow(score, schema)
