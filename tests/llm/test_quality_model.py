import math
import random

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import quality_model as qm
from quayside.llm.common import table
from tests.llm.conftest import awkward_rows, frame, prose, words

SF = "/root/testdata/sf0.01"


def test_held_out_rows_are_told_apart(spark):
    out = qm.q_op1_quality_model(spark, SF)
    rows = out.join(table(spark, SF, "labels"), "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc >= 0.95 and sum(r["predicted"] == r["quality"] for r in rows) / len(rows) >= 0.9
    assert out.count() == table(spark, SF, "documents").count()
    assert out.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)).count() == 0


def test_features_of_a_text():
    def of(*texts):
        data = b"".join(texts)
        offs = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        got = [[] for _ in texts]
        for doc, bucket in qm.features(np.frombuffer(data, np.uint8), offs):
            for d, b in zip(doc, bucket):
                got[d].append(int(b))
        return [sorted(x) for x in got]

    one, two, none, again = of(b"ab cde", b"cde  ab", b"", b"ab ab")
    # words 2; 3-grams " ab", "ab ", " cd", "cde", "de "; 5-grams " cde "
    assert len(one) == 2 + 5 + 1 and one == two and none == []
    assert again.count(qm._REPEAT) == 1 and len(again) == 2 + 4 + 1
    assert of(b"ab cde")[0] == one


def naive_features(text):
    """Words, repeats, and n-grams of characters of words between spaces, by name."""
    w, out = words(text), []
    for k, x in enumerate(w):
        out.append(("word", x))
        if k and w[k - 1] == x:
            out.append("repeat")
        for n in (3, 5):
            padded = f" {x} "
            out += [(n, padded[i : i + n]) for i in range(len(padded) - n + 1)]
    return out


def test_features_match_brute_force(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "b", "é", "日", "\U0001f600", " ", "\n", "xy "]) for _ in range(rng.randrange(60))) for _ in range(60)] + [prose(2, 50), "", " "]
    bucket_of, taken = {}, {}
    for size in (1 << 20, 64, 7):  # slices of long texts change nothing
        monkeypatch.setattr(qm, "_SLICE", size)
        data = [t.encode() for t in texts]
        offs, got = np.concatenate(([0], np.cumsum([len(d) for d in data]))), [[] for _ in texts]
        for doc, bucket in qm.features(np.frombuffer(b"".join(data), np.uint8), offs):
            for d, b in zip(doc, bucket):
                got[d].append(int(b))
        for t, have in zip(texts, got):
            names = naive_features(t)
            assert len(names) == len(have)
            for name in set(names):  # one feature alone gives its bucket
                if name not in bucket_of and isinstance(name, tuple) and name[0] == "word":
                    bucket_of[name] = qm._bucket(qm.word_hashes(*(lambda b: (b, np.array([0]), np.array([len(b)])))(np.frombuffer(name[1].encode(), np.uint8))))[0]
                elif name not in bucket_of:
                    bucket_of[name] = 0 if name == "repeat" else qm._grams(qm._characters(np.frombuffer(name[1].encode(), np.uint8))[1], name[0])[1][0]
            assert sorted(int(bucket_of[x]) for x in names) == sorted(have), t


def naive_fit(docs, y, shares, seed=7):
    """The same descent, one number at a time."""
    rng = np.random.default_rng(seed)
    vec = rng.uniform(-1 / qm.DIM, 1 / qm.DIM, (qm.BUCKETS, qm.DIM)).astype(np.float32).astype(float)
    out, bias, done = [[0.0] * qm.DIM for _ in (0, 1)], [0.0, 0.0], 0
    for _ in range(qm.EPOCHS):
        for k in rng.permutation(len(docs)):
            rate, done = qm.RATE * (1 - done / (qm.EPOCHS * len(docs))), done + 1
            counts = {b: docs[k].count(b) / len(docs[k]) for b in sorted(set(docs[k]))}
            mean = [sum(w * vec[b][d] for b, w in counts.items()) for d in range(qm.DIM)]
            z = [sum(o * m for o, m in zip(out[c], mean)) + bias[c] for c in (0, 1)]
            e = [math.exp(x - max(z)) for x in z]
            p = [x / sum(e) - (c == y[k]) for c, x in enumerate(e)]
            back = [sum(p[c] * out[c][d] for c in (0, 1)) for d in range(qm.DIM)]
            for c in (0, 1):
                bias[c] -= 0.1 * rate * p[c]
                out[c] = [o - rate * p[c] * m for o, m in zip(out[c], mean)]
            for b, w in counts.items():
                vec[b] -= [rate * w * len(counts) * x for x in back]
    prior = math.log(shares[1] / shares[0]) - math.log(sum(y) / (len(y) - sum(y)))
    return vec @ (np.array(out[1]) - np.array(out[0])), bias[1] - bias[0] + prior


def test_descent_matches_a_naive_one():
    texts, y = [prose(k, 4 + k % 3) + (" good good" if k % 2 else " bad word") for k in range(8)], [k % 2 for k in range(8)]
    docs = []
    for t in texts:
        buf = np.frombuffer(t.encode(), np.uint8)
        docs.append([int(b) for _, part in qm.features(buf, np.array([0, len(buf)])) for b in part])
    shares = {0: 30, 1: 10}
    value, bias = qm.fit([t.encode() for t in texts], y, shares)
    want, want_bias = naive_fit(docs, y, shares)
    assert np.allclose(value, want, atol=2e-4) and abs(bias - want_bias) < 1e-4


def test_long_texts_are_trained_on(spark):
    long = [(k, " ".join(["short", "lively", "words"] if k % 2 else ["dull", "spam", "spam"]) + " " + prose(k, 7_000), "en", "a", 0) for k in range(40)]
    docs = frame(spark, long)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    texts, marks, shares = qm.labelled_sample(docs, labels, "quality", F.lit(True), 100, long_rows=5)
    assert min(map(len, texts)) > 32_768 and sorted(marks) == [0] * 5 + [1] * 5 and shares == {0: 20, 1: 20}


def test_awkward_rows(awkward, nothing, label_rows):
    out = qm.quality_scores(awkward, label_rows).collect()
    assert sorted((r["doc_id"] for r in out), key=str) == sorted((r[0] for r in awkward_rows()), key=str)
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in out)
    assert qm.quality_scores(nothing, label_rows).collect() == []
    alone = qm.quality_scores(awkward, label_rows.filter("quality = 1")).collect()
    assert all(r["predicted"] == 1 for r in alone)
