"""Labelled samples and held-out folds, shared by the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts above so many characters are long, and of these a sample has at most so many rows of either label, whole.
LONG_CHARS, LONG_ROWS = 32_768, 16


def fold(doc_id: str | Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; of a null doc_id, null."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % n


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, each: int, long_rows: int = LONG_ROWS
) -> tuple[list, list, dict]:
    """Texts and labels of at most ``each`` training rows of either label (those of the smallest hash of doc_id) and of at most
    ``long_rows`` more whose texts are long, all of them whole; and the number of all training rows by label. ``train`` is a
    condition on ``doc_id``. Of several rows of one doc_id the least text counts."""
    marks = labels.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    marks = marks.filter(train & F.col("label").isin(0, 1)).distinct()
    counts = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").cast("string").alias("text")).filter("text IS NOT NULL")
    sizes = texts.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    fit = marks.join(sizes, "doc_id")
    picked = None
    for value in (0, 1):
        for long_, most in ((F.col("n") <= LONG_CHARS, each), (F.col("n") > LONG_CHARS, long_rows)):
            part = fit.filter((F.col("label") == value) & long_).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "label")
            picked = part if picked is None else picked.union(part)
    label_of = {r["doc_id"]: r["label"] for r in picked.collect()}
    wanted = docs.sparkSession.createDataFrame([(k,) for k in label_of], "doc_id long")
    rows = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"].encode() for r in rows], [label_of[r["doc_id"]] for r in rows], counts
