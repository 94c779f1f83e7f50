import os
from dataclasses import replace

import pytest

from quayside.operators.manifest import PathRules
from quayside.plans.landing import LandingConfig, run_landing
from quayside.session import new_run_dir
from quayside.sources.ledger import Ledger, read_ledger

from conftest import write_file


def _cfg(spark, tmp_path, **kw):
    kw.setdefault("rules", PathRules(root=f"file:{tmp_path}/landed", bucket_marker="/bucket/", landing_marker="/raw/"))
    return LandingConfig(source=str(tmp_path / "bucket"), ledger=Ledger(path=str(tmp_path / "ledger")), **kw)


def _seed(tmp_path, n=5):
    for i in range(n):
        write_file(f"{tmp_path}/bucket/raw/d{i % 2}/f{i}.txt", f"file {i}".encode() * 50, mtime=1_700_000_000 + i)


def _run(spark, cfg):
    return run_landing(spark, replace(cfg, staging_dir=new_run_dir(spark, "test-run")))


def test_run_rerun_touch(spark, tmp_path):
    _seed(tmp_path)
    cfg = _cfg(spark, tmp_path)
    first = _run(spark, cfg)
    assert first.count == 5
    assert {r["status"] for r in first.audit.collect()} == {"SUCCESS"}
    assert os.path.exists(f"{tmp_path}/landed/d0/f0.txt")
    assert _run(spark, cfg).count == 0
    touched = f"{tmp_path}/bucket/raw/d1/f3.txt"
    write_file(touched, b"changed", mtime=1_800_000_000)
    third = _run(spark, cfg)
    assert third.count == 1
    assert [r["source_path"] for r in third.audit.collect()] == [f"file:{touched}"]
    with open(f"{tmp_path}/landed/d1/f3.txt", "rb") as fh:
        assert fh.read() == b"changed"
    assert read_ledger(spark, cfg.ledger).count() == 6


def test_failed_copy_recorded_and_not_retried_by_default(spark, tmp_path):
    _seed(tmp_path, 3)
    write_file(f"{tmp_path}/landed/d1", b"blocks the d1 directory")
    cfg = _cfg(spark, tmp_path)
    res = _run(spark, cfg)
    status = {os.path.basename(r["source_path"]): r["status"] for r in res.audit.collect()}
    assert status == {"f0.txt": "SUCCESS", "f1.txt": "ERROR", "f2.txt": "SUCCESS"}
    assert res.stats["status"] == {"SUCCESS": 2, "ERROR": 1}  # counted in the copy tasks
    os.remove(f"{tmp_path}/landed/d1")
    assert _run(spark, cfg).count == 0
    retry = _run(spark, replace(cfg, retry_failed=True))
    assert retry.count == 1 and {r["status"] for r in retry.audit.collect()} == {"SUCCESS"}


def test_cap_exact_passes_over_raises(spark, tmp_path):
    _seed(tmp_path, 4)
    with pytest.raises(ValueError, match="max_files"):
        _run(spark, _cfg(spark, tmp_path, max_files=3))
    assert not os.path.exists(f"{tmp_path}/landed")
    assert _run(spark, _cfg(spark, tmp_path, max_files=4)).count == 4


def test_unmapped_fail_or_reject(spark, tmp_path):
    _seed(tmp_path, 2)
    write_file(f"{tmp_path}/bucket/elsewhere/x.txt", b"no landing marker")
    with pytest.raises(ValueError, match="no landing path"):
        _run(spark, _cfg(spark, tmp_path))
    res = _run(spark, _cfg(spark, tmp_path, on_unmapped="reject"))
    assert res.count == 2
    assert [os.path.basename(r["source_path"]) for r in res.rejected.collect()] == ["x.txt"]


def test_two_sources_one_target_is_refused(spark, tmp_path):
    write_file(f"{tmp_path}/bucket/raw/a/raw/x.txt", b"1")
    write_file(f"{tmp_path}/bucket/raw/a/raw/y.txt", b"2")
    with pytest.raises(ValueError, match="more than one source"):
        _run(spark, _cfg(spark, tmp_path))
    res = _run(spark, _cfg(spark, tmp_path, rules=PathRules(
        root=f"file:{tmp_path}/landed", bucket_marker="/bucket/", landing_marker="/raw/", keep_tail=True)))
    assert res.count == 2


def test_empty_source_touches_nothing(spark, tmp_path):
    os.makedirs(f"{tmp_path}/bucket/raw")
    write_file(f"{tmp_path}/bucket/raw/empty.txt", b"")
    cfg = _cfg(spark, tmp_path)
    res = _run(spark, cfg)
    assert res.count == 0 and res.audit.count() == 0
    assert read_ledger(spark, cfg.ledger).count() == 0


def test_listing_modes_agree_in_runs(spark, tmp_path):
    _seed(tmp_path, 6)
    cfg = _cfg(spark, tmp_path, listing="binaryFile")
    assert _run(spark, cfg).count == 6
    assert _run(spark, cfg).count == 0
    # the distributed listing sees the same paths and times: nothing new either
    assert _run(spark, replace(cfg, listing="distributed")).count == 0


def test_one_snapshot_per_run(spark, tmp_path, monkeypatch):
    """Files added or changed after the pending set is staged are left for the next run."""
    import quayside.plans.landing as landing

    _seed(tmp_path, 3)
    real_copy = landing.copy_files
    late_new = f"{tmp_path}/bucket/raw/d0/late.txt"
    changed = f"{tmp_path}/bucket/raw/d1/f1.txt"

    def copy_after_changes(*args, **kwargs):
        write_file(late_new, b"arrived during the run", mtime=1_750_000_000)
        write_file(changed, b"changed during the run", mtime=1_750_000_000)
        return real_copy(*args, **kwargs)

    monkeypatch.setattr(landing, "copy_files", copy_after_changes)
    cfg = _cfg(spark, tmp_path)
    first = _run(spark, cfg)
    rows = {os.path.basename(r["source_path"]): r for r in first.audit.collect()}
    assert first.count == first.stats["pending"] == 3 and set(rows) == {"f0.txt", "f1.txt", "f2.txt"}
    assert first.pending.count() == 3
    # the recorded version is the one detected, not the one found at copy time
    assert rows["f1.txt"]["source_modified_at"].timestamp() == 1_700_000_001
    monkeypatch.setattr(landing, "copy_files", real_copy)
    second = _run(spark, cfg)
    assert sorted(os.path.basename(r["source_path"]) for r in second.audit.collect()) == ["f1.txt", "late.txt"]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_names = st.sampled_from([f"d{i % 3}/f{i}.txt" for i in range(12)])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    first=st.dictionaries(_names, st.integers(1, 5), min_size=1, max_size=8),
    changes=st.dictionaries(_names, st.integers(0, 6), max_size=6),
)
def test_landing_runs_property(spark, tmp_path_factory, first, changes):
    """Second pass copies exactly the new or strictly newer files; a third finds nothing."""
    base = tmp_path_factory.mktemp("prop")
    for rel, t in first.items():
        write_file(f"{base}/bucket/raw/{rel}", f"{rel}@{t}".encode(), mtime=1_600_000_000 + t)
    cfg = _cfg(spark, base)
    assert _run(spark, cfg).count == len(first)
    expected = set()
    for rel, t in changes.items():
        write_file(f"{base}/bucket/raw/{rel}", f"{rel}@{t}!".encode(), mtime=1_600_000_000 + t)
        if rel not in first or t > first[rel]:
            expected.add(rel)
    second = _run(spark, cfg)
    got = {r["source_path"].split("/raw/", 1)[1] for r in second.audit.collect()}
    assert got == expected and second.count == len(expected)
    for rel in expected:
        with open(f"{base}/landed/{rel}", "rb") as fh:
            assert fh.read().endswith(b"!")
    assert _run(spark, cfg).count == 0


@pytest.mark.parametrize("kind", ["orc-path", "catalog-table", "bucketed-table"])
def test_ledger_format_and_locator(spark, tmp_path, kind):
    _seed(tmp_path, 3)
    if kind == "orc-path":
        ledger = Ledger(path=str(tmp_path / "ledger-orc"), fmt="orc")
    else:
        spark.sql("DROP TABLE IF EXISTS quayside_runs_ledger")
        ledger = Ledger(name="quayside_runs_ledger", fmt="parquet", buckets=4 if kind == "bucketed-table" else None)
    cfg = replace(_cfg(spark, tmp_path), ledger=ledger)
    assert _run(spark, cfg).count == 3
    assert _run(spark, cfg).count == 0
    write_file(f"{tmp_path}/bucket/raw/d0/f0.txt", b"new", mtime=1_900_000_000)
    assert _run(spark, cfg).count == 1
    assert read_ledger(spark, ledger).count() == 4
    if kind != "orc-path":
        spark.sql("DROP TABLE IF EXISTS quayside_runs_ledger")


def test_step_by_step_flow(spark, tmp_path):
    """The six steps driven one by one, as a caller of the separate steps would."""
    from quayside import (
        append_ledger,
        build_manifest,
        copy_pending,
        extract_inventory,
        pending_files,
        setup_ledger,
    )

    _seed(tmp_path, 4)
    cfg = _cfg(spark, tmp_path)
    for expected in (4, 0):
        inventory = extract_inventory(spark, cfg.source)
        manifest = build_manifest(inventory, cfg.rules)
        ledger_df = setup_ledger(spark, cfg.ledger)
        pending = pending_files(manifest, ledger_df)
        audit, n = copy_pending(spark, pending, cfg.ledger)
        assert n == expected and audit.count() == expected
        assert audit.columns == ledger_df.columns
        assert append_ledger(spark, audit, cfg.ledger, row_count=n) == expected
    assert read_ledger(spark, cfg.ledger).count() == 4
    with pytest.raises(ValueError, match="max_files"):
        write_file(f"{tmp_path}/bucket/raw/d0/new1.txt", b"1")
        write_file(f"{tmp_path}/bucket/raw/d0/new2.txt", b"2")
        copy_pending(spark, pending_files(build_manifest(extract_inventory(spark, cfg.source), cfg.rules),
                                          setup_ledger(spark, cfg.ledger)), cfg.ledger, max_files=1)


def test_source_is_listed_once_per_run(spark, tmp_path):
    _seed(tmp_path, 6)
    cfg = _cfg(spark, tmp_path, listing="distributed", preview_rows=3)
    n_dirs = sum(1 for _ in os.walk(f"{tmp_path}/bucket"))
    first = _run(spark, cfg)
    assert first.count == 6 and first.stats["dirs_listed"] == n_dirs
    second = _run(spark, cfg)
    assert second.count == 0 and second.stats["dirs_listed"] == n_dirs


def test_outputs_inside_the_source_are_refused(spark, tmp_path):
    _seed(tmp_path, 1)
    inside = PathRules(root=f"file:{tmp_path}/bucket/landed", bucket_marker="/bucket/", landing_marker="/raw/")
    with pytest.raises(ValueError, match="landing root"):
        _run(spark, _cfg(spark, tmp_path, rules=inside))
    cfg = replace(_cfg(spark, tmp_path), ledger=Ledger(path=str(tmp_path / "bucket" / "raw" / "ledger")))
    with pytest.raises(ValueError, match="ledger"):
        _run(spark, cfg)


def test_path_variants_end_to_end(spark, tmp_path):
    """Case-insensitive bucket marker, any-extension stripping and kept tail in one run."""
    write_file(f"{tmp_path}/BUCKET/raw/a/raw/x.tar.gz", b"1")
    write_file(f"{tmp_path}/BUCKET/raw/b/y.csv", b"22")
    rules = PathRules(root=f"file:{tmp_path}/landed", bucket_marker="/bucket/", landing_marker="/raw/",
                      bucket_ignore_case=True, keep_tail=True, strip_ext="*")
    cfg = LandingConfig(source=str(tmp_path / "BUCKET"), ledger=Ledger(path=str(tmp_path / "ledger")), rules=rules)
    res = _run(spark, cfg)
    got = {r["bucket_path"]: r["lakehouse_path"] for r in res.audit.collect()}
    assert got == {
        "raw/a/raw/x.tar.gz": f"file:{tmp_path}/landed/a/raw/x.tar",
        "raw/b/y.csv": f"file:{tmp_path}/landed/b/y",
    }
    with open(f"{tmp_path}/landed/b/y", "rb") as fh:
        assert fh.read() == b"22"
    assert _run(spark, cfg).count == 0


def test_overlapping_sources_are_refused(spark, tmp_path):
    _seed(tmp_path, 2)
    cfg = replace(_cfg(spark, tmp_path), source=[str(tmp_path / "bucket"), str(tmp_path / "bucket" / "raw")])
    with pytest.raises(ValueError, match="overlap"):
        _run(spark, cfg)
