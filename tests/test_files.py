import os

import pytest

from quayside.operators.copy import copy_files, copy_plan
from quayside.operators.detect import pending_files
from quayside.operators.inventory import extract_inventory
from quayside.operators.manifest import PathRules, build_manifest
from quayside.session import new_run_dir
from quayside.sources.files import scan_files
from quayside.sources.listing import list_files
from quayside.sources.ledger import empty_ledger

from conftest import write_file


def _tree(root):
    write_file(f"{root}/raw/a/one.txt", b"x" * 6000)
    write_file(f"{root}/raw/a/b/two.csv", b"y" * 10)
    write_file(f"{root}/raw/c/three.bin", os.urandom(3 * 1024 * 1024 + 7))
    write_file(f"{root}/raw/zero.txt", b"")
    write_file(f"{root}/raw/_hidden.txt", b"h")
    write_file(f"{root}/raw/.dot.txt", b"d")
    return root


def test_inventory_skips_zero_byte_and_hidden(spark, tmp_path):
    root = _tree(str(tmp_path / "src"))
    inv = extract_inventory(spark, root)
    got = {os.path.basename(r["source_path"]): r["source_size_mb"] for r in inv.collect()}
    assert got == {"one.txt": 0.01, "two.csv": 0.0, "three.bin": 3.0}
    plan = scan_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]


@pytest.mark.parametrize(
    "budget,dir_budget,threads", [(1, 256, None), (3, 256, 4), (50_000, 1, None), (50_000, 256, None), (50_000, 2, 8)]
)
def test_distributed_listing_equals_binary_file(spark, tmp_path, budget, dir_budget, threads):
    root = _tree(str(tmp_path / "src"))
    write_file(f"{root}/raw/_skipdir/inner.txt", b"hidden dir")
    write_file(f"{root}/raw/.dotdir/inner.txt", b"hidden dir")
    write_file(f"{root}/raw/k=_v/_part=1/kept.txt", b"kept")
    write_file(f"{root}/raw/deep/a/b/c/d/e.txt", b"deep")
    dist = list_files(spark, root, budget=budget, dir_budget=dir_budget, threads=threads)
    spark_scan = scan_files(spark, root)
    assert dist.count() == spark_scan.count() == 5
    assert dist.exceptAll(spark_scan).count() == 0 and spark_scan.exceptAll(dist).count() == 0
    only_txt = list_files(spark, root, glob="*.txt", budget=budget, dir_budget=dir_budget, threads=threads)
    assert only_txt.exceptAll(scan_files(spark, root, glob="*.txt")).count() == 0
    assert only_txt.count() == 3


def _pending(spark, root, landed):
    rules = PathRules(root=f"file:{landed}", bucket_marker="/src/", landing_marker="/raw/")
    man = build_manifest(extract_inventory(spark, root), rules)
    return pending_files(man, empty_ledger(spark))


def test_copy_files_bytes_equal_and_no_leftovers(spark, tmp_path):
    root = _tree(str(tmp_path / "src"))
    landed = str(tmp_path / "landed")
    run = new_run_dir(spark, "test-copy")
    audit = copy_files(spark, _pending(spark, root, landed), f"{run}/audit")
    rows = audit.collect()
    assert sorted(r["status"] for r in rows) == ["SUCCESS"] * 3
    assert all(r["copied_at"] is not None and r["error"] is None for r in rows)
    for rel in ["a/one.txt", "a/b/two.csv", "c/three.bin"]:
        with open(f"{root}/raw/{rel}", "rb") as a, open(f"{landed}/{rel}", "rb") as b:
            assert a.read() == b.read()
    leftovers = [f for _, _, fs in os.walk(landed) for f in fs if f.endswith(".inflight")]
    assert leftovers == []


def test_copy_error_rows_do_not_fail_the_others(spark, tmp_path):
    root = _tree(str(tmp_path / "src"))
    landed = str(tmp_path / "landed")
    write_file(f"{landed}/c", b"a file where a directory is needed")
    run = new_run_dir(spark, "test-copy-err")
    pend = _pending(spark, root, landed)
    gone = spark.createDataFrame(
        [(f"file:{root}/raw/missing.txt", None, 0.0, "x", f"file:{landed}/missing.txt")], pend.schema
    )
    rows = {os.path.basename(r["source_path"]): r for r in copy_files(spark, pend.unionByName(gone), f"{run}/audit").collect()}
    assert rows["one.txt"]["status"] == "SUCCESS"
    assert rows["three.bin"]["status"] == "ERROR" and rows["three.bin"]["error"]
    assert rows["missing.txt"]["status"] == "ERROR"


def test_recopy_is_idempotent(spark, tmp_path):
    root = _tree(str(tmp_path / "src"))
    landed = str(tmp_path / "landed")
    pend = _pending(spark, root, landed)
    for i in range(2):
        run = new_run_dir(spark, f"test-recopy-{i}")
        assert {r["status"] for r in copy_files(spark, pend, f"{run}/audit").collect()} == {"SUCCESS"}
    files = sorted(os.path.relpath(os.path.join(d, f), landed) for d, _, fs in os.walk(landed) for f in fs)
    assert files == ["a/b/two.csv", "a/one.txt", "c/three.bin"]


def test_staged_audit_is_not_recomputed(spark, tmp_path):
    root = _tree(str(tmp_path / "src"))
    landed = str(tmp_path / "landed")
    run = new_run_dir(spark, "test-once")
    audit = copy_files(spark, _pending(spark, root, landed), f"{run}/audit")
    first = {r["source_path"]: r["copied_at"] for r in audit.collect()}
    audit.count()
    second = {r["source_path"]: r["copied_at"] for r in audit.collect()}
    assert first == second  # reading staging again does not copy again


def test_copy_plan_uses_requested_tasks(spark, tmp_path):
    root = _tree(str(tmp_path / "src"))
    plan = copy_plan(_pending(spark, root, str(tmp_path / "l")), num_tasks=3)
    assert 1 <= plan.rdd.getNumPartitions() <= 3
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in text and "rangepartitioning(lakehouse_path" in text


def test_custom_copier(spark, tmp_path):
    def _shutil_copier(src, dst):  # nested: shipped to the workers by value
        import os
        import shutil

        src, dst = src.replace("file:", "", 1), dst.replace("file:", "", 1)
        if src.endswith("one.txt"):
            raise PermissionError("refused by the custom copier")
        os.makedirs(os.path.dirname(dst), exist_ok=True)
        shutil.copyfile(src, dst)

    root = _tree(str(tmp_path / "src"))
    landed = str(tmp_path / "landed")
    run = new_run_dir(spark, "test-copier")
    rows = {os.path.basename(r["source_path"]): r for r in copy_files(
        spark, _pending(spark, root, landed), f"{run}/audit", copier=_shutil_copier).collect()}
    assert rows["one.txt"]["status"] == "ERROR" and "refused" in rows["one.txt"]["error"]
    assert rows["two.csv"]["status"] == rows["three.bin"]["status"] == "SUCCESS"
    assert os.path.getsize(f"{landed}/c/three.bin") == 3 * 1024 * 1024 + 7


def test_split_uri_keeps_path_verbatim():
    from quayside.sources.fsuri import split_uri

    assert split_uri("file:/tmp/a b/h#x?.txt") == (None, "/tmp/a b/h#x?.txt")
    assert split_uri("file:///tmp/x") == (None, "/tmp/x")
    assert split_uri("/tmp/x") == (None, "/tmp/x")
    assert split_uri("s3a://bucket/dir/h#x?y%20.txt") == ("s3://bucket/", "dir/h#x?y%20.txt")
    assert split_uri("abfss://c@acct.dfs.core.windows.net/p/q") == ("abfss://c@acct.dfs.core.windows.net/", "p/q")
    assert split_uri("hdfs://nn:8020/") == ("hdfs://nn:8020/", "")


def test_copy_names_with_uri_characters(spark, tmp_path):
    root = str(tmp_path / "src")
    names = ["a b.txt", "p%20q.txt", "h#x.txt", "q?y.txt", "é ü.txt", "k=v.txt"]
    for n in names:
        write_file(f"{root}/raw/dir one/{n}", n.encode())
    landed = str(tmp_path / "landed")
    run = new_run_dir(spark, "test-names")
    rows = copy_files(spark, _pending(spark, root, landed), f"{run}/audit").collect()
    assert sorted(r["status"] for r in rows) == ["SUCCESS"] * len(names)
    for n in names:
        with open(f"{landed}/dir one/{n}", "rb") as fh:
            assert fh.read() == n.encode()
    assert sorted(r[0] for r in list_files(spark, root).collect()) == sorted(r[0] for r in scan_files(spark, root).collect())


def test_relative_landing_paths_resolve_against_base(spark, tmp_path):
    root = _tree(str(tmp_path / "src"))
    rules = PathRules(root="Files/Landing", bucket_marker="/src/", landing_marker="/raw/")
    pend = pending_files(build_manifest(extract_inventory(spark, root), rules), empty_ledger(spark))
    run = new_run_dir(spark, "test-relative")
    rows = copy_files(spark, pend, f"{run}/audit", relative_to=f"file:{tmp_path}/base").collect()
    assert {r["status"] for r in rows} == {"SUCCESS"}
    assert {r["lakehouse_path"] for r in rows} == {"Files/Landing/a/one.txt", "Files/Landing/a/b/two.csv", "Files/Landing/c/three.bin"}
    assert os.path.getsize(f"{tmp_path}/base/Files/Landing/c/three.bin") == 3 * 1024 * 1024 + 7


def test_distributed_listing_root_cases(spark, tmp_path):
    one = write_file(f"{tmp_path}/single/only.txt", b"x")
    assert [r[0] for r in list_files(spark, one).collect()] == [r[0] for r in scan_files(spark, one).collect()]
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path / "missing"))


def test_file_deleted_after_listing_is_skipped(spark, tmp_path):
    root = _tree(str(tmp_path / "src"))
    listing = scan_files(spark, root)  # the driver lists here
    os.remove(f"{root}/raw/a/one.txt")  # the source loses a file before the scan runs
    assert sorted(os.path.basename(r[0]) for r in listing.collect()) == ["three.bin", "two.csv"]
