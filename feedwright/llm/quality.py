"""Quality classifier with supervised subword embeddings.

A document's features are its words and the character 3-, 4- and 5-grams of
each word with its edges marked, all hashed to buckets; a pair of neighbouring
words is a feature only by whether both are equal. Every bucket has a learned
vector; the document's vector is the mean over all its features, and a softmax
over two outputs gives the score. Vectors and outputs are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled documents.

Scoring needs only each bucket's difference of the two outputs, so a document
costs one look per distinct word. Null and empty texts have no features and get
the score of a zero vector, which is the learned share of label 1. Whole texts
count; lang, source and labels are never read for a score. Documents that carry
both labels learn from the larger share; a tie counts as 1. Repeated rows and
null ids are scored row by row. An empty table gives no rows, without labels
every score is 0.5, and columns other than ``doc_id`` and ``text`` are not read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import Words, doc_columns, mixed, slices, stored, text_crc, utf8_texts

BUCKETS = 1 << 16
DIMENSION = 10
NGRAMS = (3, 4, 5)
EPOCHS = 3
RATE = 0.2
#: Labelled documents that the model learns from, drawn by hash.
SAMPLE_DOCS = 4_000
#: A score from here on predicts label 1.
THRESHOLD = 0.3

_EDGE = np.uint8(0x20)


def word_features(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the chosen words' features, and where each word's begin."""
    data = np.frombuffer(words.raw, np.uint8)
    begin, length = words.begin[chosen], (words.end - words.begin)[chosen]
    padded = length + 2
    starts = np.concatenate([[0], np.cumsum(padded)])
    # Words side by side, each between two edge marks.
    flat = np.full(int(starts[-1]), _EDGE, np.uint8)
    inner = np.arange(int(length.sum())) + np.repeat(2 * np.arange(len(chosen)) + 1, length)
    source = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    flat[inner] = data[source]
    owner = np.repeat(np.arange(len(chosen)), padded)
    buckets = [(words.hashes[chosen] >> np.uint64(40)).astype(np.int64) % (BUCKETS - 1) + 1]
    owners = [np.arange(len(chosen))]
    code = flat.astype(np.uint64)
    for n in NGRAMS:
        size = max(0, len(code) - n + 1)
        grams = np.full(size, n, np.uint64)
        for i in range(n):
            grams = grams * np.uint64(263) + code[i : i + size]
        inside = owner[:size] == owner[n - 1 :] if size else np.zeros(0, bool)
        buckets.append((mixed(grams[inside]) >> np.uint64(40)).astype(np.int64) % (BUCKETS - 1) + 1)
        owners.append(owner[:size][inside])
    owners_flat, buckets_flat = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owners_flat, kind="stable")
    counts = np.bincount(owners_flat, minlength=len(chosen))
    return buckets_flat[order], np.concatenate([[0], np.cumsum(counts)])


def equal_neighbours(words: Words) -> np.ndarray:
    """For each document, how many neighbouring words are equal."""
    same = np.concatenate([[False], words.hashes[1:] == words.hashes[:-1]]) if len(words.hashes) else np.zeros(0, bool)
    heads = words.first[:-1][np.diff(words.first) > 0]
    same[heads] = False
    return np.diff(np.concatenate([[0], np.cumsum(same)])[words.first])


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and the weight of each in its mean."""
    words = Words([text])
    if not len(words.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    _, first, times = np.unique(words.hashes, return_index=True, return_counts=True)
    buckets, starts = word_features(words, first)
    weights = np.repeat(times, np.diff(starts)).astype(np.float64)
    same = float(equal_neighbours(words)[0])
    count = np.bincount(np.concatenate([buckets, [0]]), np.concatenate([weights, [same]]), minlength=1)
    total = count.sum()
    at = np.flatnonzero(count)
    return at, (count[at] / total).astype(np.float32)


def train(examples: list[tuple[bytes, int]], epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """For each bucket the difference of the two outputs, and the difference of their biases."""
    random = np.random.default_rng(10)
    vectors = random.uniform(-1, 1, (BUCKETS, DIMENSION)).astype(np.float32) / DIMENSION
    outputs = np.zeros((DIMENSION, 2), np.float32)
    bias = np.zeros(2, np.float32)
    features = [document_features(t) for t, _ in examples]
    labels = np.array([y for _, y in examples], np.int64)
    steps, done = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        for i in random.permutation(len(examples)):
            at, weight = features[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = weight @ vectors[at] if len(at) else np.zeros(DIMENSION, np.float32)
            logits = mean @ outputs + bias
            share = np.exp(logits - logits.max())
            error = -share / share.sum()
            error[labels[i]] += 1
            back = outputs @ error
            outputs += step * np.outer(mean, error)
            bias += step * 0.1 * error
            if len(at):
                vectors[at] += (step * len(at) * weight)[:, None].clip(max=step * 4) * back[None, :]
    difference = vectors @ (outputs[:, 1] - outputs[:, 0])
    return difference.astype(np.float64), float(bias[1] - bias[0])


def score_texts(parts: list[bytes], difference: np.ndarray, bias: float) -> np.ndarray:
    words = Words(parts)
    documents = len(parts)
    total, size = np.zeros(documents), np.zeros(documents)
    if len(words.hashes):
        _, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        buckets, starts = word_features(words, first)
        sums = np.concatenate([[0.0], np.cumsum(difference[buckets])])
        by_word = (sums[starts[1:]] - sums[starts[:-1]])[back]
        n_by_word = np.diff(starts)[back]
        # bincount adds each document's words on its own, so a score does not depend on its neighbours.
        owner = np.repeat(np.arange(documents), np.diff(words.first))
        total = np.bincount(owner, np.round(by_word, 9), minlength=documents)
        size = np.bincount(owner, n_by_word, minlength=documents)
        same = equal_neighbours(words)
        total += same * difference[0]
        size += same
    return 1 / (1 + np.exp(-(total / np.maximum(size, 1) + bias)))


def held_out(name: str = "doc_id") -> Column:
    """Documents kept from learning: crc32 of the id as text is divisible by 5."""
    return F.pmod(text_crc(name), F.lit(5)) == 0


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, float]:
    """Train on at most about ``sample_docs`` labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    share = min(1.0, sample_docs / max(1, known.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1 << 30)) / float(1 << 30)
    # The sample is bounded by its parameter, so it may be broadcast and its texts come to the driver.
    sample = F.broadcast(stored(known.where(draw < share), "labelled"))
    texts = doc_columns(docs).join(sample, "doc_id").select("doc_id", F.col("text").cast("binary").alias("text"), "label")
    found = sorted((r["doc_id"], bytes(r["text"] or b""), r["label"]) for r in texts.collect())
    return train([(t, y) for _, t, y in found])


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        difference, bias = shared.value
        for whole in batches:
            for b in slices(whole, limit=1_000_000):
                found = score_texts(utf8_texts(b), difference, bias)
                columns = [b.column("doc_id"), b.column("held_out"), pa.array(found)]
                columns += [pa.array((found >= THRESHOLD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    asked = doc_columns(docs).withColumn("held_out", held_out())
    return asked.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
