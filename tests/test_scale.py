"""What grows with the files or rows of a run, and what must not."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quayside.operators import copy as copying
from quayside.operators import parts
from quayside.schema import STATUS_SUCCESS
from quayside.sources import ledger as ledgers
from quayside.sources import listing
from quayside.sources import standins as st
from tests.conftest import write_file
from tests.test_placement import content, pending, tree


def test_tiny_parts_and_tasks_share_spark_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "task_limit", lambda *a: 4)
    monkeypatch.setattr(copying, "task_limit", lambda *a: 4)
    rows = tree(tmp_path, {**{f"l{k}": 40_000 + 1_000 * k for k in range(6)}, **{f"s{k}": 300 * k for k in range(60)}})
    rows = [(s, os.path.getsize(s[5:]) / 2**20, t) for s, _, t in rows]
    counters = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    got = copying.copy_files(spark, pending(spark, rows), f"{tmp_path}/audit", mb_per_task=0.016, part_mb=0.004, verify="content", counters=counters)
    assert {r["source_path"]: r["status"] for r in got.collect()} == {s: STATUS_SUCCESS for s, _, _ in rows}
    assert [c.value for c in counters] == [len(rows), 0]
    for source, _, target in rows:
        assert content(target) == content(source[5:])
    done = spark.read.parquet(f"{tmp_path}/audit-parts").select("source_path", F.input_file_name().alias("file"))
    assert done.count() > 50 and done.select("file").distinct().count() <= 4
    assert min(r["n"] for r in done.groupBy("source_path").agg(F.count_distinct("file").alias("n")).collect()) > 1


@pytest.mark.parametrize("n,limit", [(1, 8), (2, 8), (13, 64), (100, 8), (101, 101), (5000, 128)])
def test_neighbouring_tasks_run_apart(spark, n, limit):
    task, n_tasks = copying.apart(F.col("id"), n, limit)
    at = [r[0] for r in spark.range(n).select(task).orderBy("id").collect()]
    assert n_tasks == min(n, limit) and sorted(set(at)) == list(range(n_tasks))
    runs = [a for a, b in zip(at, [None, *at]) if a != b]
    assert len(runs) == n_tasks  # neighbours share a Spark task
    if n_tasks > 8:
        assert min(abs(a - b) for a, b in zip(runs, runs[1:])) > 1


def test_a_run_of_many_files_is_dealt_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(copying, "FEW_FILES", 10)
    rows = tree(tmp_path, {f"s{k}": 100 + k for k in range(40)})
    got = copying.copy_files(spark, pending(spark, rows), f"{tmp_path}/audit")
    assert got.count() == 40 and os.path.isdir(f"{tmp_path}/audit-order")
    assert all(content(t) == content(s[5:]) for s, _, t in rows)


def test_landed_content_is_read_in_the_tasks(spark, tmp_path):
    write_file(f"{tmp_path}/a #%41", b"the content")
    rows = [("s1", 0.0, f"file:{tmp_path}/a #%41"), ("s2", 0.0, f"{tmp_path}/gone"), ("s3", 0.0, None)]
    got = st.landed_content(pending(spark, rows).repartition(2))
    assert got.rdd.getNumPartitions() == 2
    found = {r["source_path"]: (r["target_bytes"], r["content_md5"]) for r in got.collect()}
    assert found == {"s1": (11, hashlib.md5(b"the content").hexdigest()), "s2": (None, None), "s3": (None, None)}


def test_texts_are_written_in_small_batches(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, kind = spark.conf.get(name), type(spark.range(1))
    run = kind.mapInPandas
    monkeypatch.setattr(kind, "mapInPandas", lambda self, *a, **k: (seen.append(spark.conf.get(name)), run(self, *a, **k))[1])
    rows = [(k, "src", "en", f"text {k}") for k in range(30)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = st.documents_tree(spark, str(tmp_path), f"{tmp_path}/tree")
    assert got.count() == 30 and content(f"{tmp_path}/tree/raw/src/en/7.txt") == b"text 7"
    assert seen == [str(st.TEXT_ROWS)] and spark.conf.get(name) == before


def test_a_flat_folder_is_cut_evenly(tmp_path):
    for k in range(1_200):
        write_file(f"{tmp_path}/d/{k:05d}.txt", b"x")
    ranges = list(listing.local_entries(f"{tmp_path}/d", None, None, 100, 8))
    sizes = [len(list(listing.local_entries(f"{tmp_path}/d", a, b, 100, 8))) for _, a, b, _ in ranges]
    assert len(sizes) == 8 and sum(sizes) == 1_200 and max(sizes) <= 151


def test_a_flat_folder_has_a_range_for_each_core(spark, tmp_path):
    for k in range(600):
        write_file(f"{tmp_path}/d/{k:05d}.txt", b"x")
    got = listing.list_files(spark, f"{tmp_path}/d", f"{tmp_path}/staged", page_limit=10)
    assert got.count() == got.distinct().count() == 600
    ranges = spark.read.parquet(f"{tmp_path}/staged/level-00000").filter("kind = 'dir'").count()
    assert ranges == max(2, spark.sparkContext.defaultParallelism)


def test_appends_of_the_stand_in_ledger_are_sized_by_their_rows(spark, monkeypatch):
    seen, append = [], entry.append_ledger
    monkeypatch.setattr(entry, "append_ledger", lambda s, rows, *a, **k: (seen.append((k["row_count"], rows.count())), append(s, rows, *a, **k))[1])
    entry._runs_ledger(spark, entry.SMOKE_DIR, "sized")
    assert len(seen) == 5 and all(given == there > 1 for given, there in seen)


def test_an_append_counts_in_one_pass(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def once(batches):
        for pdf in batches:
            reads.add(len(pdf))
            yield pdf

    ledger = ledgers.Ledger(path=f"{tmp_path}/ledger", layout="runs")
    ledgers.ensure_ledger(spark, ledger)
    audit = copying.audit_records(pending(spark, [("s", 0.1, "t")]).withColumn("source_modified_at", F.current_timestamp()))
    audit = audit.mapInPandas(once, audit.schema)
    assert ledgers.append_ledger(spark, audit, ledger, run_id="r") == 1
    assert reads.value == 2  # count and check, write
    assert ledgers.read_ledger(spark, ledger).count() == 1
