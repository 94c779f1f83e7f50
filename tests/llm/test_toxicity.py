import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import toxicity as tx
from quayside.llm.common import table
from tests.llm.conftest import awkward_rows

SF = "/root/testdata/sf0.01"


def enumerate_marginals(score, trans, start):
    n, total, out = len(score), 0.0, np.zeros(len(score))
    for y in itertools.product((0, 1), repeat=n):
        w = np.exp(start * y[0] + sum(s for s, k in zip(score, y) if k) + sum(trans[a, b] for a, b in zip(y, y[1:])))
        total += w
        out += w * np.array(y)
    return out / total


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    sizes = [1, 9, 2, 11, 1, 1, 7, 10]
    score = rng.normal(0, 2, sum(sizes))
    first = np.zeros(len(score), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    trans = rng.normal(0, 1, (2, 2))
    p = tx.forward_backward(score, first, np.exp(trans), float(np.exp(0.3)))[0]
    at = 0
    for n in sizes:
        assert p[at : at + n] == pytest.approx(enumerate_marginals(score[at : at + n], trans, 0.3))
        at += n


def test_lanes_do_not_matter(monkeypatch):
    rng = np.random.default_rng(2)
    score, first = rng.normal(-1, 3, 5000), rng.random(5000) < 0.01
    first[0] = True
    trans = np.exp(rng.normal(0, 1, (2, 2)))
    a = tx.forward_backward(score, first, trans, 0.2)[0]
    for lane in (1, 7, 5000):
        monkeypatch.setattr(tx, "LANE", lane)
        assert np.allclose(a, tx.forward_backward(score, first, trans, 0.2)[0])


def test_held_out_rows_are_told_apart(spark):
    from quayside.llm.toxicity import q_op5_toxicity

    out = q_op5_toxicity(spark, SF)
    rows = out.join(table(spark, SF, "labels"), "doc_id").filter("held_out").select("predicted", "toxic").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows) / len(rows)
    caught = [r["predicted"] for r in rows if r["toxic"]]
    assert right >= 0.9 and sum(caught) >= 0.6 * len(caught)  # 38 toxic rows to learn from
    assert out.count() == table(spark, SF, "documents").count()
    wrong = out.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)).count()
    assert wrong == 0


def test_held_out_rows_at_a_larger_size(spark):
    sf = "/root/testdata/sf0.1"
    rows = tx.q_op5_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").filter("held_out").select("predicted", "toxic").collect()
    caught, rejected = ([r["predicted"] for r in rows if r["toxic"] == k] for k in (1, 0))
    assert sum(caught) >= 0.9 * len(caught) and sum(rejected) <= 0.05 * len(rejected)


def test_spans_point_at_the_words(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = tx.train(docs, labels)
    text = "Ünder the café you idiot, and ä worthless moron there"
    frame = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in tx.toxicity(frame, model).collect()}
    found = [text[s["start"] : s["end"]] for s in out[1]["spans"]]
    assert "idiot" in " ".join(found) and "moron" in " ".join(found) and "café" not in found
    assert out[1]["score"] > 0.3 > out[2]["score"] == out[3]["score"]


def test_awkward_rows(spark, awkward, nothing, label_rows):
    model = tx.train(awkward, label_rows)
    out = tx.toxicity(awkward, model).collect()
    assert sorted((r["doc_id"] for r in out), key=str) == sorted((r[0] for r in awkward_rows()), key=str)
    assert all(0 <= r["score"] <= 1 for r in out)
    kept = tx.without_toxic(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == sum(r["score"] < tx.THRESHOLD for r in out)
    assert tx.toxicity(nothing, model).collect() == [] and tx.without_toxic(nothing, model).collect() == []
    empty = tx.train(awkward, label_rows.filter("false"))
    assert {r["score"] for r in tx.toxicity(awkward, empty).collect()} == {0.5}


def test_a_long_clean_text_is_judged_like_a_short_one():
    calm, passage = np.full(60, 0.004), np.full(12, 0.6)
    docs = [calm, np.tile(calm, 2_000), np.concatenate((calm, passage, calm)), np.concatenate((np.tile(calm, 900), passage, np.tile(calm, 900)))]
    x = tx.Model.summary(np.concatenate(docs), np.concatenate(([0], np.cumsum([len(d) for d in docs]))))
    assert np.allclose(x[:, 0], x[:, 1], atol=1e-6) and np.allclose(x[:, 2], x[:, 3], atol=1e-6)
    assert x[2, 2] > x[2, 0] + 1 and tx.Model.summary(np.zeros(0), np.array([0, 0])).shape == (3, 1)
