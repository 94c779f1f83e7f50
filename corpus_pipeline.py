"""A training-data pipeline over ``documents``: each stage's rows are written and read by the next.

Toxic documents go; of each group of SimHash near-copies the smallest doc_id stays; documents that leak a benchmark item
go; sources are mixed to their targets, documents repeated as often as they are taken; the rest is written as token ids.

Nulls: a null text counts as empty, a null doc_id is a name like any other (last among near-copies, first in the files).
Empty texts are near-copies of each other, and the mix takes none of them (they have no words). Repeated rows are near-copies: one
stays. Ties and very long texts are treated as each stage's module says, whole. An empty table gives no rows. All columns of the
input but the last stage's come through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import decontaminate, mixing, simhash, token_files, toxicity
from quayside.llm.common import run_dir, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, fill=True)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_output(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("token-ids", write_ids),
]

#: Not to be had in SQL: the tagger, XXH64 fingerprints with connected components, and the token files.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, in order."""
    path, docs = run_dir(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(spark, docs, f"{path}/{k}-{name}")
    return docs
