"""Quality classifier by supervised subword embeddings.

A document is the average of learned vectors, one for each hashed feature: every
word, the word repeating the one before it, and the 3-grams and 5-grams of characters (code points) of
every word with a space at either end. A softmax over two outputs reads the average.
Vectors and outputs are trained together by stochastic gradient descent in numpy, on a
sample of at most ``SAMPLE_EACH`` labelled rows of either label; outputs are corrected
for the labels' true shares. As the model is linear above the average, scoring needs
one number for each feature (its vector's part in the difference of the outputs), and
a document's score is one pass over its bytes, without a shuffle.

A training column with one label only (or none) gives the share of label 1 as every
score (0.5 without rows). Nulls: a null text is empty and scores by the bias alone; a
null doc_id is not held out and not trained on. Repeated rows get equal scores; a score equal to the threshold
predicts 1. Very long texts are scored whole, and up to 16 of either label are trained on whole besides the
sample of shorter ones. Empty tables give no rows. Of the input only the named columns are read: others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import SPACE, mix64, pick, steps, table, text_bytes, word_hashes, word_spans
from quayside.llm.learning import fold, labelled_sample

BUCKETS = 1 << 16
DIM = 8
SAMPLE_EACH = 2_500
EPOCHS = 8
RATE = 0.5
FOLDS = 5
THRESHOLD = 0.3

_REPEAT = 0  # bucket of a word that repeats the one before
_SLICE = 1 << 20  # feature places of long texts are worked on in slices of so many bytes


def _bucket(h: np.ndarray) -> np.ndarray:
    return (1 + (h >> np.uint64(20)) % np.uint64(BUCKETS - 1)).astype(np.int64)


def _characters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each character of UTF-8 bytes begins, and its bytes as one number."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    code, size = buf[at].astype(np.uint64), np.diff(np.append(at, len(buf)))
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        code[more] = code[more] << np.uint64(8) | buf[at[more] + k]
    return at, code


def _grams(code: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and buckets of the n-grams of characters of which the inner ones are no white space."""
    if len(code) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = ~SPACE[np.minimum(code, 255).astype(np.uint8)]
    ok = inner[1 : len(code) - n + 2].copy()
    for k in range(2, n - 1):
        ok &= inner[k : len(code) - n + 1 + k]
    at = np.flatnonzero(ok[: len(code) - n + 1])
    plain = np.where(inner, code, np.uint64(32))
    h = np.full(len(at), n, np.uint64)
    for k in range(n):
        h = mix64((h + plain[at + k]) * np.uint64(0x9E3779B97F4A7C15))
    return at, _bucket(h)


def features(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(document, bucket)`` of every feature of the documents, in several parts."""
    starts, ends, woff = word_spans(buf, offs)
    h = word_hashes(buf, starts, ends)
    doc = np.searchsorted(woff, np.arange(len(h)), "right") - 1
    yield doc, _bucket(h)
    again = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1])) + 1
    yield doc[again], np.full(len(again), _REPEAT)
    # a space before and after each document, so that first and last words have both ends
    n = len(offs) - 1
    padded = np.full(len(buf) + n + 1, 32, np.uint8)
    shift = np.repeat(np.arange(1, n + 1), np.diff(offs))
    padded[np.arange(len(buf)) + shift] = buf
    begins = offs + np.arange(n + 1)
    for lo in range(0, len(padded), _SLICE):
        where, code = _characters(padded[lo : lo + _SLICE + 24])  # a 5-gram ends within 20 bytes
        for size in (3, 5):
            at, bucket = _grams(code, size)
            at = where[at]
            keep = at < _SLICE
            at, bucket = at[keep] + lo, bucket[keep]
            yield np.minimum(np.searchsorted(begins, at, "right") - 1, n - 1), bucket


def margins(buf: np.ndarray, offs: np.ndarray, value: np.ndarray, bias: float) -> np.ndarray:
    """Each document's difference of the outputs: the mean of its features' values, and the bias."""
    n = len(offs) - 1
    total, count = np.zeros(n), np.zeros(n)
    for doc, bucket in features(buf, offs):
        total += np.bincount(doc, value[bucket], n)[:n]
        count += np.bincount(doc, minlength=n)[:n]
    return total / np.maximum(count, 1) + bias


def fit(texts: list[bytes], labels: list[int], shares: dict[int, int], seed: int = 7) -> tuple[np.ndarray, float]:
    """Value of every bucket, and the bias."""
    n0, n1 = shares.get(0, 0), shares.get(1, 0)
    if not n0 or not n1 or len(set(labels)) < 2:
        share = min(max(n1 / (n0 + n1), 1e-6), 1 - 1e-6) if n0 + n1 else 0.5
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    docs = []
    for text in texts:
        buf = np.frombuffer(text, np.uint8)
        all_ = np.concatenate([b for _, b in features(buf, np.array([0, len(buf)]))])
        ids, count = np.unique(all_, return_counts=True)
        docs.append((ids, (count / max(1, len(all_))).astype(np.float32)))
    y = np.array(labels)
    vec = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    turns, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(docs)):
            rate = np.float32(RATE * (1 - done / turns))
            done += 1
            ids, w = docs[k]
            mean = w @ vec[ids]
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[k]] -= 1
            back = p @ out
            out -= rate * np.outer(p, mean)
            bias -= np.float32(0.1) * rate * p
            # each feature steps by its share of the average, scaled to the document's distinct features
            vec[ids] -= (rate * w * len(ids))[:, None] * back[None, :]
    s1 = int(y.sum())
    prior = np.log(n1 / n0) - np.log(s1 / (len(y) - s1))
    return (vec @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0] + prior)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, bias = model.value
        for rb in steps(batches):
            z = margins(*text_bytes(rb.column("text")), value, bias)
            score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held: int = 0, sample_each: int = SAMPLE_EACH) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; rows of fold ``held`` are not trained on."""
    texts, marks, shares = labelled_sample(docs, labels, "quality", fold("doc_id", folds) != held, sample_each)
    model = docs.sparkSession.sparkContext.broadcast(fit(texts, marks, shares))
    scored = pick(docs, doc_id="long", text="string").mapInArrow(_score(model), "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def q_op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
