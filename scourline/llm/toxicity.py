"""Toxicity by a bag of subword embeddings, averaged into a linear softmax.

A text is the bag of its character n-grams (as bytes, 3 to 6 long, with the blanks at both
ends of a word as its borders), each hashed to a row of an embedding table.  The rows are
averaged and go through a linear softmax; both are trained together in numpy.  An unseen
misspelling shares most n-grams, and so most of its vector, with the word it comes from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .grams import grams
from .work import stored

BITS = 18
BUCKETS = 1 << BITS
SIZES = (3, 4, 5, 6)
WIDTH = 4  # of an embedding
SAMPLE = {0: 3500, 1: 1500}  # the most rows of each label that are learned from
EPOCHS = 10
BATCH = 128
RATE = 0.15

def bag_of(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    bucket, _ = grams([text], SIZES, BITS)
    bucket, count = np.unique(bucket, return_counts=True)
    return bucket.astype(np.int32), (count / max(count.sum(), 1)).astype(np.float32)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Score of each bucket and the bias; rows are weighted to a ``prior`` share of ones.

    The embeddings and the softmax are learned by Adagrad over shuffled batches.  For two
    labels a text's log odds are the mean of its buckets' scores plus the bias.
    """
    random = np.random.default_rng(5)
    table = (random.random((BUCKETS, WIDTH), np.float32) - 0.5) / WIDTH
    output = (random.random((WIDTH, 2), np.float32) - 0.5) / WIDTH
    bias = np.zeros(2, np.float32)
    held = [np.full_like(table, 1e-8), np.full_like(output, 1e-8), np.full_like(bias, 1e-8)]
    ones = max(labels.mean(), 1e-9)
    weight = np.where(labels == 1, prior / ones, (1 - prior) / max(1 - ones, 1e-9))
    if not 0 < labels.mean() < 1:
        weight = np.ones(len(labels))
    gain = np.float32(64)  # averages over whole texts are small
    for epoch in range(EPOCHS):
        order = random.permutation(len(bags))
        rate = RATE * (1 - epoch / EPOCHS)
        for low in range(0, len(order), BATCH):
            rows = order[low : low + BATCH]
            bucket = np.concatenate([bags[i][0] for i in rows])
            share = np.concatenate([bags[i][1] for i in rows]) * gain
            owner = np.repeat(np.arange(len(rows)), [len(bags[i][0]) for i in rows])
            near = table[bucket] * share[:, None]
            mean = np.stack([np.bincount(owner, near[:, d], len(rows)) for d in range(WIDTH)], 1)
            logits = mean @ output + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            odds[np.arange(len(rows)), labels[rows]] -= 1
            odds *= weight[rows, None] / len(rows)
            back = (odds @ output.T).astype(np.float32)
            flow = back[owner] * share[:, None]
            grad = np.stack([np.bincount(bucket, flow[:, d], BUCKETS) for d in range(WIDTH)], 1)
            steps = ((table, grad, held[0]), (output, mean.T @ odds, held[1]), (bias, odds.sum(axis=0), held[2]))
            for value, g, h in steps:
                h += np.square(g)
                value -= (rate * g / np.sqrt(h)).astype(np.float32)
    scores = table @ (output[:, 1] - output[:, 0]) * gain
    return scores.astype(np.float32), float(bias[1] - bias[0])


def log_odds(texts: list[bytes | None], scores: np.ndarray, bias: float) -> np.ndarray:
    bucket, owner = grams(texts, SIZES, BITS)
    total = np.bincount(owner, scores[bucket], len(texts))
    return bias + total / np.maximum(np.bincount(owner, minlength=len(texts)), 1)


def _label_sample(labels: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` rows of each label, the first by a hash of their id."""
    picked = [
        labels.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for label, most in SAMPLE.items()
    ]
    return picked[0].unionByName(picked[1])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = [bag_of(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"],
                "label": batch["label"],
                "bucket": pa.array([b.tobytes() for b, _ in bags], pa.binary()),
                "share": pa.array([s.tobytes() for _, s in bags], pa.binary()),
            }
        )


def _trained(prior: float):
    """Trains on the bags of one partition: a row of scores and the bias."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for doc, label, bucket, share in zip(*(c.to_pylist() for c in batch.columns)):
                bag = np.frombuffer(bucket, np.int32), np.frombuffer(share, np.float32)
                rows.append((doc, label, bag))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2][0])))
        truth = np.array([label for _, label, _ in rows], np.int64)
        if not len(truth) or truth.min() == truth.max():
            scores, bias = np.zeros(BUCKETS, np.float32), 30.0 if truth.any() else -30.0
        else:
            scores, bias = train([bag for _, _, bag in rows], truth, prior)
        yield pa.RecordBatch.from_pydict({"scores": pa.array([scores.tobytes()]), "bias": [bias]})

    return learn


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Learn from ``labels`` (``doc_id``, ``label`` 0 or 1) and the texts of ``docs``.

    One task trains on a bounded sample: at most ``SAMPLE`` bags of each label, each of at
    most ``BUCKETS`` entries.  The driver gets one score per bucket.  The share of ones is
    taken over all labels.  With labels of one kind all texts get that label, with none the
    label 0.
    """
    labels = labels.where("doc_id is not null and label in (0, 1)")
    sample = stored(_label_sample(labels), "labelled")  # thousands of ids at most
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # An id may stand for many rows: the bound holds for what is trained on.
    most = F.when(F.col("label") == 1, SAMPLE[1]).otherwise(SAMPLE[0])
    for by in (Window.partitionBy("label", F.pmod(F.xxhash64("doc_id", "text"), F.lit(64))), Window.partitionBy("label")):
        order = by.orderBy(F.xxhash64("doc_id", "text"), "doc_id")
        texts = texts.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most).drop("n")
    bags = texts.select("doc_id", "label", "text").mapInArrow(
        _bags, "doc_id long, label int, bucket binary, share binary"
    )
    prior = labels.agg(F.avg("label")).first()[0] or 0.0
    one = stored(bags, "bags").coalesce(1)
    model = one.mapInArrow(_trained(float(prior)), "scores binary, bias double").first()
    return np.frombuffer(model.scores, np.float32), model.bias


def toxicity(docs: DataFrame, scores: np.ndarray, bias: float) -> DataFrame:
    """``doc_id`` and ``score`` (the probability of label 1) of each row of ``docs``.

    Whole texts are scored.  A null or empty text, or one without n-grams, has the score of
    the bias alone.  Rows are scored one by one, equal ids or not; further columns are
    ignored and an empty table gives an empty one.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                piece = batch.slice(low, 256)
                odds = log_odds(piece["text"].cast(pa.binary()).to_pylist(), scores, bias)
                value = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
                yield pa.RecordBatch.from_pydict({"doc_id": piece["doc_id"], "score": value})

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
