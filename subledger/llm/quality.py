"""Quality classifier: supervised subword embeddings.

Every text becomes hashed n-grams: byte 3- to 5-grams, words, and word pairs (a
word repeated right after itself falls into one bucket of its own, whatever the
word). Each bucket has a learnt vector; the vectors of a text are averaged, a
softmax layer turns the average into class probabilities. Both layers are
trained together by numpy stochastic gradient descent (with per-bucket step
sizes) on a bounded sample of labelled documents outside the held-out fold.

Since the softmax of two classes depends on one difference of logits and the
average is linear, scoring needs one number per bucket: the mean of those
numbers over a text's n-grams, plus a bias.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import held_out, labelled_sample

#: Hash buckets (a power of two) and the length of their vectors.
BUCKETS, WIDTH = 1 << 15, 8
#: Bytes of a text whose n-grams are held at a time.
CHUNK = 1 << 20
_P, _MIX = np.uint32(0x01000193), np.uint32(0x9E3779B1)
_POWERS = np.cumprod(np.full(4096, _P, np.uint32), dtype=np.uint32)
#: The bucket of a word pair whose words are equal.
REPEAT = 0
#: Shares of the three kinds of n-grams in a text's average.
SHARES = {"char": 0.5, "word": 0.2, "pair": 0.3}


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint32(salt * 0x85EBCA6B & 0xFFFFFFFF)) * _MIX
    h ^= h >> np.uint32(15)
    return (h * _MIX >> np.uint32(32 - 15)).astype(np.int32) % (BUCKETS - 1) + 1


def ngrams(text: str | None) -> Iterator[tuple[str, np.ndarray]]:
    """(kind, bucket numbers) of a text, in pieces of whole words of some CHUNK bytes;
    what crosses from one piece to the next is counted once, where it starts."""
    words = " ".join((text or "").split()).encode("utf-8", "replace")
    data = b" " + words + b" " if words else b""
    at, last = 0, np.empty(0, np.uint32)
    while at < len(data) - 1:
        end = data.find(b" ", at + CHUNK, len(data) - 1)
        end = len(data) - 1 if end < 0 else end
        # A blank, whole words and a blank, and the longest n-gram that starts before it.
        b = np.frombuffer(data[at : end + 4], np.uint8).astype(np.uint32)
        h = b[:-1] * _P + b[1:]
        for n in (3, 4, 5):
            if len(b) < n:
                break
            h = h[: len(b) - n + 1] * _P + b[n - 1 :]
            yield "char", _bucket(h[: end - at], n)
        b = b[: end - at + 1]
        starts = np.flatnonzero(b[:-1] == 32) + 1
        lengths = np.diff(np.append(starts, len(b)))
        place = np.arange(1, len(b)) - np.repeat(starts, lengths)
        word = np.add.reduceat(b[1:] * _POWERS[place & 4095], starts - 1)
        yield "word", _bucket(word, 1)
        word = np.concatenate((last, word))
        if len(word) > 1:
            yield "pair", np.where(word[1:] == word[:-1], REPEAT, _bucket(word[:-1] * _P + word[1:], 2))
        at, last = end, word[-1:]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of a text: the weights of each kind add up to its share."""
    counts = {k: np.zeros(BUCKETS, np.float64) for k in SHARES}
    for kind, ids in ngrams(text):
        counts[kind] += np.bincount(ids, minlength=BUCKETS)
    total = sum(SHARES[k] * c / max(1.0, c.sum()) for k, c in counts.items())
    at = np.flatnonzero(total)
    return at.astype(np.int32), total[at].astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Logit of class 1: bias + weighted mean of ``bucket`` over the n-grams."""

    bucket: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        sums, sizes = dict.fromkeys(SHARES, 0.0), dict.fromkeys(SHARES, 0)
        for kind, ids in ngrams(text):
            sums[kind] += float(self.bucket[ids].sum(dtype=np.float64))
            sizes[kind] += len(ids)
        logit = self.bias + sum(SHARES[k] * sums[k] / max(1, sizes[k]) for k in SHARES)
        return float(1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, prior: float, epochs: int = 6, rate: float = 0.5, seed: int = 7) -> Model:
    """Train bucket vectors and the softmax layer; ``prior`` is the share of class
    1 among all labels, which the classes' sample sizes are corrected to."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / WIDTH, 1.0 / WIDTH, (BUCKETS, WIDTH))
    soft, bias = rng.uniform(-0.5, 0.5, (WIDTH, 2)), np.zeros(2)
    seen_v, seen_s, seen_b = np.full(BUCKETS, 1e-8), np.full((WIDTH, 2), 1e-8), np.full(2, 1e-8)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, weight = rows[i]
            hidden = weight @ vectors[at] if len(at) else np.zeros(WIDTH)
            logits = hidden @ soft + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[y[i]] -= 1.0
            to_hidden = soft @ error
            if len(at):
                seen_v[at] += (weight**2) * (to_hidden @ to_hidden) / WIDTH
                vectors[at] -= (rate * weight / np.sqrt(seen_v[at]))[:, None] * to_hidden * 0.1
            grad = np.outer(hidden, error)
            seen_s += grad**2
            soft -= 0.1 * rate * grad / np.sqrt(seen_s)
            seen_b += error**2
            bias -= 0.1 * rate * error / np.sqrt(seen_b)
    share = y.mean()
    shift = np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Model((vectors @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0] + shift))


def learn_model(documents: DataFrame, labels: DataFrame, per_class: int = 1500) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class outside the
    held-out fold. Only their hashed n-gram weights (at most BUCKETS numbers a
    document) reach the driver. With labels of one class or none, every score is
    that class's share, or one half."""
    columns = "at array<int>, weight array<float>"

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([features(t) for t in texts], columns=["at", "weight"])

    sample = labelled_sample(documents, labels, "quality", per_class)
    hashed = sample.select("y", F.xxhash64("text").alias("h"), F.pandas_udf(run, columns)(F.col("text")).alias("x"))
    got = hashed.select("y", "h", "x.at", "x.weight").toArrow().sort_by([("h", "ascending"), ("y", "ascending")])
    y = got.column("y").to_numpy().astype(np.int64)
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).agg(F.avg("quality")).first()[0]
    if len(y) == 0 or y.min() == y.max():
        share = 0.5 if known is None else min(max(known, 0.001), 0.999)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    rows = [
        (a.values.to_numpy(zero_copy_only=False), w.values.to_numpy(zero_copy_only=False))
        for a, w in zip(got.column("at"), got.column("weight"), strict=True)
    ]
    return fit(rows, y, min(max(known, 0.01), 0.99))


def score_quality(documents: DataFrame, model: Model, text_col: str = "text"):
    """Column: probability that the whole text is of quality 1."""
    shared = documents.sparkSession.sparkContext.broadcast((model.bucket, model.bias))

    def run(texts: pd.Series) -> pd.Series:
        own = Model(*shared.value)
        return pd.Series([own.score(t if isinstance(t, str) else None) for t in texts], dtype="float64")

    return F.pandas_udf(run, "double")(F.col(text_col))


#: Score from which a document is kept (fixed by the contract).
THRESHOLD = 0.7


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have no n-grams and score the bias alone. Rows that
    repeat stay; other columns are passed over. No shuffle of the documents; the
    model (BUCKETS numbers) is broadcast.
    """
    model = learn_model(documents, labels)
    scored = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_quality(documents, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all their columns, that the classifier does not reject."""
    return documents.where(score_quality(documents, learn_model(documents, labels)) >= THRESHOLD)
