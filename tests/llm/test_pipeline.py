from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from quayside.llm import queries, toxicity
from quayside.llm.common import table
from tests.llm.conftest import awkward_rows, frame
from tests.llm.test_decontaminate import brute as leaks_of

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near-duplicates", "decontamination", "mixing", "token-ids"]
    tidy = corpus_pipeline.drop_toxic(spark, docs, SF).cache()
    model = toxicity.train(docs, table(spark, SF, "labels"))
    assert tidy.count() == toxicity.toxicity(docs, model).filter(F.col("score") < toxicity.THRESHOLD).count() < docs.count()
    single = corpus_pipeline.drop_near_copies(spark, tidy, SF).cache()
    assert single.select("text").distinct().count() == single.count() < tidy.count()
    clean = corpus_pipeline.drop_leaks(spark, single, SF).cache()
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    rows = [(r["doc_id"], r["text"]) for r in single.collect()]
    bad = {d for d, _ in leaks_of(rows, items)}
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - bad and bad
    assert tidy.columns == single.columns == clean.columns == docs.columns


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and sum(r["n_tokens"] for r in out) == max(r["start"] + r["n_tokens"] for r in out)


def written(spark, tmp_path, docs):
    """A folder of tables whose documents are ``docs``."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_awkward_repeated_and_empty_tables(spark, tmp_path):
    rows = awkward_rows() + [(50, "the same row again and again", "en", "hot", 5)] * 60
    extra = "'i' AS _leak_id", "'m' AS _mix_hash", "'k' AS _keep_id", "'u' AS _id", "'n' AS _turn", "'s' AS _share"
    for k, docs in enumerate((frame(spark, rows).selectExpr("*", *extra), frame(spark, [], 1))):
        path = written(spark, tmp_path / str(k), docs)
        out = corpus_pipeline.run(spark, path).collect()
        assert sorted(out[0].asDict() if out else []) == (["doc_id", "ids_crc32", "n_tokens", "start"] if k == 0 else [])
        assert {r["doc_id"] for r in out} <= {r[0] for r in rows}
    for _, stage in corpus_pipeline.STAGES[:-1]:  # columns come back as they were
        df = frame(spark, rows).selectExpr("*", *extra)
        kept = stage(spark, df, SF)
        assert kept.columns == df.columns
        assert {tuple(r) for r in kept.select("_leak_id", "_mix_hash", "_keep_id", "_id", "_turn", "_share").collect()} <= {("i", "m", "k", "u", "n", "s")}


def test_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values()) and all(map(callable, entry.queries().values()))
