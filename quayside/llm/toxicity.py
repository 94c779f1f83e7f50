"""Toxicity by a linear-chain conditional random field over tokens.

Tokens (lower-cased runs of ASCII letters, digits and characters from 0x80) are
tagged clean or toxic. A token's features are hashed: the token, its prefixes of 3 to 5
bytes and its suffix of 3; the neighbours come in by the chain's transitions.
Training tokens are labelled from the documents' labels: a token of a toxic document
is toxic when the token or one of its prefixes is typical of toxic documents; all
other tokens are clean. Weights are trained by stochastic gradient descent on the
chain's likelihood; forward-backward marginals give each token's probability, and a
document's score is a logistic function of the largest marginal and of their largest
sum over ``STRETCH`` tokens in a row, fitted on the same sample. Stretches of tokens above 0.5 are the offending spans.

A batch of documents is one chain, cut at document starts by the transition itself;
products of 2 x 2 matrices over lanes of it are carried over, so the marginals are
exact whatever a document's length. The sample has at most ``SAMPLE_EACH`` rows of
either label; scoring is one pass over all whole texts, without a shuffle.

With one label only (or none) every score is the share of label 1 (0.5 without rows).
Nulls: a null text is empty, without tokens; such documents score as if all their
marginals were 0. A null doc_id is neither held out nor trained on. Repeated rows get equal scores; a score equal to
the threshold predicts 1 and is rejected. Very long texts are scored whole, and up to 16 of either label are trained on
whole besides the sample of shorter ones. Empty tables give no rows. ``toxicity`` reads only doc_id and text,
``without_toxic`` returns all columns unchanged whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import bounded_batches, mix64, pick, steps, table, text_bytes, word_hashes, word_spans
from quayside.llm.learning import fold, labelled_sample

BITS = 18
SAMPLE_EACH = 1_500
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
EPOCHS = 5
#: Successive tokens whose marginals are summed up for a document.
STRETCH = 20
RATE = 0.5
LANE = 128
#: A token or prefix is typical: in so many toxic sample documents, that share of them, and so many times likelier there.
TYPICAL_DOCS, TYPICAL_SHARE, TYPICAL_RATIO = 4, 0.01, 25.0

_TOKEN = np.full(256, 0x20, np.uint8)
for _c in range(256):
    if 0x41 <= _c <= 0x5A:
        _TOKEN[_c] = _c + 32
    elif 0x30 <= _c <= 0x39 or 0x61 <= _c <= 0x7A or _c >= 0x80:
        _TOKEN[_c] = _c
_SALTS = [np.uint64(0x9E3779B97F4A7C15 * k & (2**64 - 1)) for k in range(1, 6)]


class Tokens:
    """Tokens of a batch of texts, and their hashed features."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.plain = _TOKEN[buf]
        self.starts, self.ends, self.woff = word_spans(self.plain, offs)
        self.first = np.zeros(len(self.starts), bool)
        self.first[self.woff[:-1][np.diff(self.woff) > 0]] = True

    def parts(self) -> list[np.ndarray]:
        """Hashes: the token, its prefixes of 5, 4 and 3 bytes, its suffix of 3."""
        s, e = self.starts, self.ends
        out = [word_hashes(self.plain, s, e)]
        out += [word_hashes(self.plain, s, np.minimum(e, s + n)) for n in (5, 4, 3)]
        return [*out, word_hashes(self.plain, np.maximum(s, e - 3), e)]

    def features(self) -> np.ndarray:
        """One row of buckets for each of the five features."""
        return np.stack([(mix64(h + salt) >> np.uint64(64 - BITS)).astype(np.int32) for h, salt in zip(self.parts(), _SALTS)])


# ---------------------------------------------------------------- the chain
def _lanes(x: np.ndarray, fill) -> np.ndarray:
    """As (LANE, n): column k holds the k-th run of LANE tokens."""
    n = max(1, -(-len(x) // LANE))
    out = np.full(n * LANE, fill, x.dtype)
    out[: len(x)] = x
    return np.ascontiguousarray(out.reshape(n, LANE).T)


def odds(u: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float) -> np.ndarray:
    """For every token the ratio of the two states' forward sums, toxic over clean. ``u``: exp of the
    tokens' score differences; where ``first`` is set a chain begins, with odds ``start`` beforehand."""
    (a00, a01), (a10, a11) = trans
    e, f = _lanes(u, 1.0), _lanes(first, False)
    n = e.shape[1]
    p00, p01, p10, p11 = np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)  # [state now][state before the lane]
    for t in range(LANE):
        x, cut = e[t], f[t]
        q00, q01 = a00 * p00 + a10 * p10, a00 * p01 + a10 * p11
        q10, q11 = x * (a01 * p00 + a11 * p10), x * (a01 * p01 + a11 * p11)
        if cut.any():
            q00[cut], q01[cut] = 1.0, 1.0
            q10[cut] = q11[cut] = x[cut] * start
        norm = 1 / (q00 + q01 + q10 + q11)
        p00, p01, p10, p11 = q00 * norm, q01 * norm, q10 * norm, q11 * norm
    carried, r = np.empty(n), start
    for k, (w00, w01, w10, w11) in enumerate(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist())):
        carried[k] = r
        r = min((w10 + w11 * r) / max(w00 + w01 * r, 1e-300), 1e300)
    out, r = np.empty_like(e), carried
    for t in range(LANE):
        r = e[t] * (a01 + a11 * r) / (a00 + a10 * r)
        cut = f[t]
        if cut.any():
            r[cut] = e[t][cut] * start
        out[t] = r
    return out.T.reshape(-1)[: len(u)]


def forward_backward(score: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float):
    """``(marginal, forward odds, backward odds)``: the last without the token's own score."""
    u = np.exp(np.clip(score, -25, 25))
    ahead = odds(u, first, trans, start)
    last = np.roll(first, -1)
    if len(last):
        last[-1] = True
    back = odds(u[::-1], last[::-1], trans.T, 1.0)[::-1] / u
    both = ahead * back
    return both / (1 + both), ahead, back


# ---------------------------------------------------------------- training
def copy_groups(token: np.ndarray, doc: np.ndarray, n: int, bands: int = 8, rows: int = 6) -> np.ndarray:
    """For each of n sample documents a group shared with its near copies: equal minima of the tokens'
    hashes in one of the bands."""
    root = np.arange(n)
    if not len(token):
        return root
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    has = doc[first]
    for band in range(bands):
        key = np.zeros(len(has), np.uint64)
        for row in range(rows):
            salt = np.uint64((band * rows + row + 1) * 0xD6E8FEB86659FD93 & (2**64 - 1))
            key = mix64(key ^ np.minimum.reduceat(mix64(token ^ salt), first))
        _, lead, at = np.unique(key, return_index=True, return_inverse=True)
        for a, b in zip(has, has[lead[at]]):
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)
    for k in range(n):
        root[k] = root[root[k]]
    return root


def token_labels(tokens: Tokens, toxic: np.ndarray) -> np.ndarray:
    """Labels of the sample's tokens from the labels of its documents: typical tokens and prefixes, near
    copies of a document counting once."""
    doc = np.searchsorted(tokens.woff, np.arange(len(tokens.starts)), "right") - 1
    parts = tokens.parts()[:3]
    group = copy_groups(parts[0], doc, len(toxic))
    n1 = max(1, len(np.unique(group[toxic])))
    n0 = max(1, len(np.unique(group[~toxic])))
    out = np.zeros(len(doc), bool)
    for part in parts:
        kinds, at = np.unique(part, return_inverse=True)
        counts = []
        for wanted in (toxic, ~toxic):
            of = wanted[doc]
            pairs = np.unique(at[of].astype(np.int64) * len(toxic) + group[doc[of]])
            counts.append(np.bincount(pairs // max(1, len(toxic)), minlength=len(kinds)))
        bad, good = counts
        typical = (bad >= max(TYPICAL_DOCS, TYPICAL_SHARE * n1)) & (bad / n1 >= TYPICAL_RATIO * (good + 0.1) / n0)
        out |= typical[at]
    return out & toxic[doc]


class Model:
    def __init__(self):
        self.weights = np.zeros(1 << BITS, np.float32)
        self.log_trans, self.log_start = np.zeros((2, 2)), 0.0
        self.curve: tuple[float, ...] | None = None  # of the marginals' maximum and largest sum of a stretch
        self.constant = 0.5

    def marginals(self, tokens: Tokens) -> np.ndarray:
        if not len(tokens.starts):
            return np.zeros(0)
        score = self.weights[tokens.features()].sum(axis=0, dtype=np.float64)
        return forward_backward(score, tokens.first, np.exp(self.log_trans), float(np.exp(self.log_start)))[0]

    @staticmethod
    def summary(p: np.ndarray, woff: np.ndarray) -> np.ndarray:
        """For each document: 1, log odds of its largest marginal, log of their largest sum over STRETCH tokens in a
        row. The sum of all would grow with a clean text's length, their mean hide a toxic passage of a long one."""
        n = len(woff) - 1
        most, total = np.zeros(n), np.zeros(n)
        full = np.flatnonzero(np.diff(woff))
        if len(full):
            most[full] = np.maximum.reduceat(p, woff[full])
            upto = np.concatenate(([0.0], np.cumsum(p)))
            at = np.arange(1, len(p) + 1)
            since = np.maximum(at - STRETCH, np.repeat(woff[:-1], np.diff(woff)))
            total[full] = np.maximum.reduceat(np.maximum(upto[at] - upto[since], 0), woff[full])
        most = np.clip(most, 1e-4, 1 - 1e-4)
        return np.stack([np.ones(n), np.log(most / (1 - most)), np.log(total + 0.01)])

    def scores(self, p: np.ndarray, woff: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(woff) - 1, self.constant)
        return 1 / (1 + np.exp(-np.clip(np.array(self.curve) @ self.summary(p, woff), -40, 40)))


def _batch(texts: list[bytes]) -> Tokens:
    return Tokens(np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))))


def fit(texts: list[bytes], labels: list[int], shares: dict[int, int], seed: int = 11) -> Model:
    model, n0, n1 = Model(), shares.get(0, 0), shares.get(1, 0)
    if not n0 or not n1 or len(set(labels)) < 2:
        model.constant = n1 / (n0 + n1) if n0 + n1 else 0.5
        return model
    toxic, rng = np.array(labels, bool), np.random.default_rng(seed)
    truth = token_labels(whole := _batch(texts), toxic)
    feats, first, woff = whole.features(), whole.first, whole.woff
    squares, tr_squares, st_square = np.full(1 << BITS, 0.05, np.float32), np.ones((2, 2)), 1.0
    groups = np.array_split(np.arange(len(texts)), max(1, len(texts) // 40))
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for group in groups:
            docs = order[group]
            size = woff[docs + 1] - woff[docs]
            if not size.sum():
                continue
            at = np.repeat(woff[docs] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            f, y, b = feats[:, at], truth[at], first[at]
            trans, start = np.exp(model.log_trans), float(np.exp(model.log_start))
            score = model.weights[f].sum(axis=0, dtype=np.float64)
            p, ahead, back = forward_backward(score, b, trans, start)
            err = (p - y).astype(np.float32)
            step = np.bincount(f.ravel(), np.tile(err, len(f)), 1 << BITS).astype(np.float32)
            touched = np.flatnonzero(step)
            squares[touched] += step[touched] ** 2
            model.weights[touched] -= RATE * step[touched] / np.sqrt(squares[touched])
            inner = np.flatnonzero(~b)
            prev, own = ahead[inner - 1], np.exp(np.clip(score[inner], -25, 25)) * back[inner]
            pair = np.array([[np.ones(len(inner)) * trans[0, 0], own * trans[0, 1]], [prev * trans[1, 0], prev * own * trans[1, 1]]])
            seen = np.array([[((y[inner - 1] == i) & (y[inner] == j)).sum() for j in (0, 1)] for i in (0, 1)])
            grad = (pair / pair.sum(axis=(0, 1))).sum(axis=2) - seen
            tr_squares += grad**2
            model.log_trans -= RATE * grad / np.sqrt(tr_squares)
            st = float(p[b].sum() - y[b].sum())
            st_square += st**2
            model.log_start -= RATE * st / np.sqrt(st_square)
    score = model.weights[feats].sum(axis=0, dtype=np.float64)
    p = forward_backward(score, first, np.exp(model.log_trans), float(np.exp(model.log_start)))[0]
    model.curve = _logistic(Model.summary(p, woff), toxic, np.log(n1 / n0) - np.log(toxic.sum() / (~toxic).sum()))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, ...]:
    """Newton steps with a little shrinkage; ``prior`` moves the intercept to the true shares."""
    w = np.zeros(len(x))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(w @ x, -40, 40)))
        shrink = 1e-2 * np.array([0, *[1] * (len(x) - 1)]) * len(y) / 100
        w -= np.linalg.solve((x * (p * (1 - p) + 1e-9)) @ x.T + np.diag(shrink + 1e-6), x @ (p - y) + shrink * w)
    return (float(w[0] + prior), *map(float, w[1:]))


# ---------------------------------------------------------------- scoring
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])
_DDL = "doc_id long, score double, spans array<struct<start:long,end:long,score:double>>"


def spans(tokens: Tokens, p: np.ndarray, offs: np.ndarray) -> list[list[dict]]:
    """For each document its stretches of tokens above 0.5: code-point offsets and the largest marginal."""
    out: list[list[dict]] = [[] for _ in range(len(offs) - 1)]
    hot = p > 0.5
    if not hot.any():
        return out
    begin = np.flatnonzero(hot & ~(np.concatenate(([False], hot[:-1])) & ~tokens.first))
    stop = np.flatnonzero(hot & ~(np.concatenate((hot[1:], [False])) & ~np.concatenate((tokens.first[1:], [True]))))
    points = np.concatenate(([0], np.cumsum((tokens.plain < 0x80) | (tokens.plain >= 0xC0))))
    doc = np.searchsorted(tokens.woff, begin, "right") - 1
    for d, a, b in zip(doc.tolist(), begin.tolist(), stop.tolist()):
        base = points[offs[d]]
        out[d].append({"start": int(points[tokens.starts[a]] - base), "end": int(points[tokens.ends[b]] - base), "score": float(p[a : b + 1].max())})
    return out


def tag(model: Model, rb: pa.RecordBatch, with_spans: bool) -> tuple[np.ndarray, list]:
    buf, offs = text_bytes(rb.column("text"))
    tokens = Tokens(buf, offs)
    p = model.marginals(tokens)
    return model.scores(p, tokens.woff), spans(tokens, p, offs) if with_spans else []


def train(docs: DataFrame, labels: DataFrame, sample_each: int = SAMPLE_EACH) -> Model:
    return fit(*labelled_sample(docs, labels, "toxic", fold("doc_id", FOLDS) != HELD, sample_each))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, spans`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in steps(batches):
            score, found = tag(shared.value, rb, True)
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), pa.array(score), pa.array(found, _SCHEMA.field("spans").type)], schema=_SCHEMA)

    return pick(docs, doc_id="long", text="string").mapInArrow(run, _DDL)


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score under the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in steps(batches):
            yield rb.filter(pa.array(tag(shared.value, rb, False)[0] < threshold))

    bounded_batches(docs.sparkSession)
    rows = docs.withColumn("text", F.col("`text`").cast("string"))
    return rows.mapInArrow(run, rows.schema)


def q_op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("spans").alias("n_spans"),
    )
