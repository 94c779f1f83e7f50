"""Atomic appends, snapshots of the newest versions, and runs completed after a lost driver."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quayside.operators import copy as copying
from quayside.operators.detect import latest_versions, newest
from quayside.operators.manifest import PathRules
from quayside.plans import landing
from quayside.plans.landing import LandingConfig, run_landing
from quayside.schema import STATUS_ERROR, STATUS_SUCCESS, ledger_schema
from quayside.session import new_run_dir
from quayside.sources import ledger as led
from quayside.sources.ledger import Ledger, append_ledger, committed_runs, compact_ledger, ensure_ledger, read_ledger, versions
from tests.conftest import write_file


def rows(spark, items):
    """(path, minute, status) -> audit rows"""
    t0 = dt.datetime(2024, 1, 1)
    data = [(p, t0 + dt.timedelta(minutes=m), 0.1, "b", f"/t/{p}", t0, s, None) for p, m, s in items]
    return spark.createDataFrame(data, ledger_schema())


def runs_ledger(spark, tmp_path):
    ledger = Ledger(path=f"{tmp_path}/ledger", layout="runs")
    ensure_ledger(spark, ledger)
    return ledger


def test_an_append_without_its_marker_is_invisible_and_repeatable(spark, tmp_path, monkeypatch):
    ledger = runs_ledger(spark, tmp_path)
    assert read_ledger(spark, ledger).count() == 0
    append_ledger(spark, rows(spark, [("a", 1, STATUS_SUCCESS)]), ledger, run_id="r1")
    with monkeypatch.context() as m:
        m.setattr(led, "write_marker", lambda *a: (_ for _ in ()).throw(OSError("the driver is gone")))
        with pytest.raises(OSError):
            append_ledger(spark, rows(spark, [("b", 1, STATUS_SUCCESS), ("c", 1, STATUS_ERROR)]), ledger, run_id="r2")
    assert os.path.isdir(f"{tmp_path}/ledger/runs/r2") and read_ledger(spark, ledger).count() == 1
    for _ in range(2):  # the second time it is there already
        append_ledger(spark, rows(spark, [("b", 1, STATUS_SUCCESS), ("c", 1, STATUS_ERROR)]), ledger, run_id="r2")
        assert sorted(r["source_path"] for r in read_ledger(spark, ledger).collect()) == ["a", "b", "c"]
    assert committed_runs(spark, ledger) == ["r1", "r2"]


def test_layout_needs_a_parquet_path():
    for bad in ({"name": "t"}, {"path": "/x", "fmt": "orc"}):
        with pytest.raises(ValueError, match="runs"):
            Ledger(layout="runs", **bad)


@pytest.mark.parametrize("retry", [False, True])
def test_snapshot_and_later_runs_equal_the_full_scan(spark, tmp_path, retry):
    ledger = runs_ledger(spark, tmp_path)
    for k in range(6):
        items = [(f"p{(k * i) % 7}", (k * 7 + i * 3) % 50, STATUS_ERROR if (k + i) % 3 else STATUS_SUCCESS) for i in range(9)]
        append_ledger(spark, rows(spark, items), ledger, run_id=f"r{k}")
        if k in (1, 3):
            assert compact_ledger(spark, ledger) is not None and compact_ledger(spark, ledger) is None
        full, quick = latest_versions(read_ledger(spark, ledger), retry), newest(versions(spark, ledger), retry)
        assert full.exceptAll(quick).count() == 0 and quick.exceptAll(full).count() == 0
    files = {f.split("/ledger/")[1].rsplit("/", 1)[0] for f in versions(spark, ledger).inputFiles()}
    assert {f.split("/")[0] for f in files} == {"runs", "snapshots"} and {f for f in files if f.startswith("runs")} == {"runs/r4", "runs/r5"}


def test_a_snapshot_without_its_marker_is_not_read(spark, tmp_path, monkeypatch):
    ledger = runs_ledger(spark, tmp_path)
    append_ledger(spark, rows(spark, [("a", 1, STATUS_SUCCESS)]), ledger)
    with monkeypatch.context() as m:
        m.setattr(led, "write_marker", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            compact_ledger(spark, ledger)
    assert all("/runs/" in f for f in versions(spark, ledger).inputFiles())
    assert compact_ledger(spark, ledger, after=2) is None and compact_ledger(spark, ledger) is not None


def config(spark, tmp_path, layout, **kw):
    rules = PathRules(root=f"file:{tmp_path}/landed", bucket_marker="/bucket/", landing_marker="/raw/")
    return LandingConfig(source=f"{tmp_path}/bucket", ledger=Ledger(path=f"{tmp_path}/ledger", layout=layout), rules=rules, **kw)


def run(spark, cfg):
    return run_landing(spark, replace(cfg, staging_dir=new_run_dir(spark, "test-durable")))


@pytest.mark.parametrize("layout", ["table", "runs"])
def test_a_run_lost_before_its_append_is_completed(spark, tmp_path, monkeypatch, layout):
    for k in range(8):
        write_file(f"{tmp_path}/bucket/raw/f{k}.txt", b"1")
    cfg = config(spark, tmp_path, layout)
    with monkeypatch.context() as m:
        m.setattr(landing, "append_ledger", lambda *a, **k: (_ for _ in ()).throw(OSError("the driver is gone")))
        with pytest.raises(OSError):
            run(spark, cfg)
    assert len(os.listdir(f"{tmp_path}/ledger/_intents")) >= 1
    before = {f: os.stat(f"{tmp_path}/landed/{f}").st_mtime_ns for f in os.listdir(f"{tmp_path}/landed")}
    write_file(f"{tmp_path}/bucket/raw/new.txt", b"2")
    second = run(spark, cfg)
    assert second.stats["resumed"] == 8 and [r["source_path"].rsplit("/", 1)[1] for r in second.pending.collect()] == ["new.txt"]
    assert {f: os.stat(f"{tmp_path}/landed/{f}").st_mtime_ns for f in before} == before
    assert read_ledger(spark, cfg.ledger).count() == 9 and run(spark, cfg).count == 0


@pytest.mark.parametrize("layout", ["table", "runs"])
def test_a_run_lost_during_its_copy_keeps_what_landed(spark, tmp_path, monkeypatch, layout):
    """The copy job fails after some of its tasks; what they landed is recorded, the rest is pending again."""
    for k in range(8):
        write_file(f"{tmp_path}/bucket/raw/f{k}.txt", b"1")
    cfg = config(spark, tmp_path, layout, num_tasks=8)

    def copy_then_die(spark_, pending, staging_dir, done_dir=None, root=None, **more):
        some = pending.filter(F.col("source_path").rlike("f[0-4].txt$"))
        copying.copy_plan(some, 5, root=root, done_dir=done_dir).foreach(lambda r: None)  # tasks that ended before the job died
        raise OSError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(landing, "copy_files", copy_then_die)
        with pytest.raises(OSError):
            run(spark, cfg)
    second = run(spark, cfg)
    assert second.stats["resumed"] == 5
    assert sorted(r["source_path"][-6:] for r in second.pending.collect()) == ["f5.txt", "f6.txt", "f7.txt"]
    assert read_ledger(spark, cfg.ledger).count() == 8 and run(spark, cfg).count == 0
    assert [n for n in os.listdir(f"{tmp_path}/ledger/_intents") if not n.startswith(".")] == []


def test_landing_on_a_ledger_in_runs(spark, tmp_path):
    cfg = config(spark, tmp_path, "runs", compact_after=2)
    for k in range(4):
        write_file(f"{tmp_path}/bucket/raw/f{k}.txt", b"1")
        assert run(spark, cfg).count == 1 and run(spark, cfg).count == 0
    assert len(committed_runs(spark, cfg.ledger)) == 4 and len(os.listdir(f"{tmp_path}/ledger/snapshots")) == 2
    assert read_ledger(spark, cfg.ledger).count() == 4
