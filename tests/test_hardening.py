"""Globs, URIs, partial copies, collisions across runs, staging, pre-flight and listing memory."""

import os
from dataclasses import replace

import pyarrow.fs as pafs
import pytest

from quayside.operators import copy as copying
from quayside.operators.guards import claimed_targets
from quayside.operators.manifest import PathRules, build_manifest
from quayside.operators.inventory import extract_inventory
from quayside.plans.landing import LandingConfig, run_landing
from quayside.schema import STATUS_ERROR, STATUS_SUCCESS
from quayside.session import new_run_dir
from quayside.sources import listing
from quayside.sources.files import scan_files
from quayside.sources.fsuri import FileSystems, azure_options, s3_options, split_uri, storage_settings
from quayside.sources.ledger import Ledger

from conftest import write_file

NAMES = ["a.csv", "b.txt", "c.json", "d1.csv", "d2.txt", "e[x].csv", "f{1}.txt", "g,h.csv", "i\\j.txt", "k-z.csv", "b.csv.txt"]


@pytest.mark.parametrize("glob", [
    "*.{csv,txt}", "[^a].*", "[!a].*", "[a-c].*", "?.csv", "d?.*", "{a,b}.*", "{d[12],c}.*", "e\\[x\\].csv", "f\\{1\\}.txt", "g,h.csv", "*", "nothing*",
])
def test_both_listings_match_names_alike(spark, tmp_path, glob):
    for n in NAMES:
        write_file(f"{tmp_path}/src/x/{n}", b"1")
    a, b = listing.list_files(spark, f"{tmp_path}/src", glob=glob), scan_files(spark, f"{tmp_path}/src", glob=glob)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_source_path_with_wildcards(spark, tmp_path):
    for d in ("p1", "p2", "q1"):
        write_file(f"{tmp_path}/src/{d}/f.txt", b"1")
    for root in (f"{tmp_path}/src/p*", f"{tmp_path}/src/{{p1,q1}}", f"{tmp_path}/src/[^p]1/*.txt"):
        a, b = listing.list_files(spark, root), scan_files(spark, root)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0
    with pytest.raises(FileNotFoundError):
        listing.list_files(spark, f"{tmp_path}/src/z*")


def test_flat_folder_leaves_in_bounded_frames(tmp_path):
    import pandas as pd

    folder = tmp_path / "flat"
    folder.mkdir()
    for k in range(60_000):
        (folder / f"f{k}").write_bytes(b"1")
    frames = list(listing._lister(None, 50_000)(iter([pd.DataFrame({"dir": [f"file:{folder}"]})])))
    assert max(len(f) for f in frames) <= listing._BATCH_ROWS and sum(len(f) for f in frames) == 60_000


def test_vanished_directories_are_counted(tmp_path):
    import pandas as pd

    class Count:
        n = 0

        def add(self, k):
            self.n += k

    gone = Count()
    frames = list(listing._lister(None, 10, vanished=gone)(iter([pd.DataFrame({"dir": [f"file:{tmp_path}/gone"]})])))
    assert frames == [] and gone.n == 1


def test_uri_resolution():
    assert split_uri("s3a://b/k/x") == ("s3://b/", "k/x")
    assert split_uri("file:/x/y") == split_uri("/x/y") == split_uri("file:///x/y") == (None, "/x/y")
    for bad in ("hdfs:/land/f0", "dbfs:/x", "abfss:/x"):
        with pytest.raises(ValueError, match="authority"):
            split_uri(bad)
    assert azure_options({}, "abfss://c@acct.dfs.core.windows.net/") == ("c", {"account_name": "acct"})
    assert azure_options({}, "abfss://ws@lake/") == ("ws", {"account_name": "lake"})
    assert azure_options({}, "abfss://ws@lake.example/") == (
        "ws", {"account_name": "lake", "dfs_storage_authority": ".example", "blob_storage_authority": ".example"})
    container, options = azure_options({"fs.azure.account.key.one.dfs.fabric.example": "KEY"}, "abfss://ws@one.dfs.fabric.example/")
    assert (container, options["account_name"], options["account_key"]) == ("ws", "one", "KEY")
    assert (options["dfs_storage_authority"], options["blob_storage_authority"]) == (".dfs.fabric.example", ".blob.fabric.example")
    with pytest.raises(ValueError, match="container@account"):
        azure_options({}, "abfss://lake/")
    fs, path = FileSystems().resolve("abfss://ws@lake.example/id/Files/x")
    assert fs.type_name == "abfs" and path == "ws/id/Files/x"


def test_storage_settings_reach_the_file_system(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.s3a.endpoint", "http://store.example:9000")
    conf.set("fs.s3a.path.style.access", "true")
    conf.set("fs.s3a.bucket.special.access.key", "mine")
    try:
        settings = storage_settings(spark)
        assert s3_options(settings, "b") == {"scheme": "http", "endpoint_override": "store.example:9000", "force_virtual_addressing": False}
        assert s3_options(settings, "special")["access_key"] == "mine"
        assert s3_options({}, "b") == {}
        fs, path = FileSystems(settings | {"fs.s3a.endpoint.region": "eu-west-1"}).resolve("s3a://b/k")
        assert fs.type_name == "s3" and path == "b/k"
    finally:
        for k in ("fs.s3a.endpoint", "fs.s3a.path.style.access", "fs.s3a.bucket.special.access.key"):
            conf.unset(k)


class _Broken:
    """A stream that fails, or ends, after its first block."""

    def __init__(self, error):
        self.blocks, self.error = [b"HALF"], error

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        return False

    def read(self, n):
        if self.blocks:
            return self.blocks.pop()
        if self.error:
            raise OSError("the source went away")
        return b""


class _Source:
    type_name = "source"

    def __init__(self, error):
        self.error = error

    def equals(self, other):
        return False

    def get_file_info(self, path):
        return pafs.FileInfo(path, pafs.FileType.File, size=8)

    def open_input_stream(self, path):
        return _Broken(self.error)


@pytest.mark.parametrize("error", [True, False])
@pytest.mark.parametrize("store", ["mock", "local"])
def test_a_failed_copy_leaves_the_old_target(tmp_path, monkeypatch, error, store):
    import pandas as pd

    if store == "mock":
        from pyarrow._fs import _MockFileSystem

        fs, target = _MockFileSystem(), "d/target"
        fs.create_dir("d")
    else:
        fs, target = pafs.LocalFileSystem(), f"{tmp_path}/target"
    with fs.open_output_stream(target) as out:
        out.write(b"GOOD-OLD")
    places = {"src://a/f": (_Source(error), "f"), "dst://a/t": (fs, target)}
    monkeypatch.setattr(copying, "FileSystems", lambda settings=None: type("R", (), {"resolve": staticmethod(places.__getitem__)})())
    row = {"source_path": ["src://a/f"], "source_modified_at": [None], "source_size_mb": [0.0], "bucket_path": ["f"], "lakehouse_path": ["dst://a/t"]}
    (out,) = list(copying._copier(1, 4)(iter([pd.DataFrame(row)])))
    assert out["status"].tolist() == [STATUS_ERROR] and out["error"][0]
    assert fs.open_input_stream(target).read() == b"GOOD-OLD"
    names = [i.base_name for i in fs.get_file_info(pafs.FileSelector(os.path.dirname(target)))]
    assert names == ["target"]


def _cfg(tmp_path, **kw):
    rules = kw.pop("rules", PathRules(root=f"file:{tmp_path}/landed", bucket_marker="/bucket/", landing_marker="/raw/", strip_ext="*"))
    return LandingConfig(source=str(tmp_path / "bucket"), ledger=Ledger(path=str(tmp_path / "ledger")), rules=rules, **kw)


def _run(spark, cfg):
    return run_landing(spark, replace(cfg, staging_dir=new_run_dir(spark, "test-run")))


def test_collisions_across_runs_are_refused(spark, tmp_path):
    write_file(f"{tmp_path}/bucket/raw/a.csv", b"first")
    cfg = _cfg(tmp_path)
    assert _run(spark, cfg).count == 1
    write_file(f"{tmp_path}/bucket/raw/a.txt", b"second")
    with pytest.raises(ValueError, match="more than one source"):
        _run(spark, cfg)
    assert open(f"{tmp_path}/landed/a", "rb").read() == b"first"
    os.remove(f"{tmp_path}/bucket/raw/a.csv")  # gone from the listing, still in the ledger
    with pytest.raises(ValueError, match="more than one source"):
        _run(spark, cfg)
    assert _run(spark, replace(cfg, on_collision="allow")).count == 1


def test_claims_look_only_at_pending_targets(spark, tmp_path):
    for n in ("a.csv", "a.txt", "b.csv"):
        write_file(f"{tmp_path}/bucket/raw/{n}", b"1")
    manifest = build_manifest(extract_inventory(spark, f"{tmp_path}/bucket"), _cfg(tmp_path).rules)
    ledger = spark.createDataFrame([], "lakehouse_path string, source_path string, status string")
    only_b = manifest.filter(manifest.source_path.endswith("b.csv"))
    assert claimed_targets(only_b, manifest, ledger).count() == 0
    rows = claimed_targets(manifest, manifest, ledger).collect()
    assert [r["lakehouse_path"] for r in rows] == [f"file:{tmp_path}/landed/a"]


def test_staging_inside_the_source_is_refused(spark, tmp_path):
    write_file(f"{tmp_path}/bucket/raw/a.csv", b"1")
    with pytest.raises(ValueError, match="staging"):
        run_landing(spark, _cfg(tmp_path, staging_dir=f"{tmp_path}/bucket/raw/stage"))


def test_catalog_ledger_inside_the_source_is_refused(spark, tmp_path):
    write_file(f"{tmp_path}/bucket/raw/a.csv", b"1")
    spark.sql("DROP TABLE IF EXISTS quayside_inside")
    from quayside.schema import ledger_schema

    spark.createDataFrame([], ledger_schema()).write.option("path", f"{tmp_path}/bucket/tbl").saveAsTable("quayside_inside")
    try:
        with pytest.raises(ValueError, match="ledger"):
            _run(spark, replace(_cfg(tmp_path), ledger=Ledger(name="quayside_inside")))
    finally:
        spark.sql("DROP TABLE IF EXISTS quayside_inside")


def test_staging_goes_when_asked(spark, tmp_path):
    write_file(f"{tmp_path}/bucket/raw/a.csv", b"1")
    run = new_run_dir(spark, "test-keep")
    result = run_landing(spark, _cfg(tmp_path, staging_dir=run, keep_staging=False))
    assert result.count == 1 and not os.path.exists(run.removeprefix("file:"))


def test_preflight_stops_before_any_copy(spark, tmp_path):
    write_file(f"{tmp_path}/bucket/raw/a.csv", b"1")
    write_file(f"{tmp_path}/blocked", b"a file")
    rules = PathRules(root=f"file:{tmp_path}/blocked", bucket_marker="/bucket/", landing_marker="/raw/")
    with pytest.raises(RuntimeError, match="cannot be written"):
        _run(spark, _cfg(tmp_path, rules=rules))
    good = replace(rules, root=f"file:{tmp_path}/landed")
    assert _run(spark, _cfg(tmp_path, rules=good)).count == 1  # nothing was recorded by the refused run
    with pytest.raises(ValueError, match="does not resolve"):
        _run(spark, replace(_cfg(tmp_path, rules=replace(rules, root="nofs:/x")), ledger=Ledger(path=f"{tmp_path}/other")))


def test_single_slash_roots_land_under_the_qualified_root(spark, tmp_path):
    write_file(f"{tmp_path}/bucket/raw/a/f0", b"1")
    rules = PathRules(root=f"file:{tmp_path}/landed", bucket_marker="/bucket/", landing_marker="/raw/")
    assert _run(spark, _cfg(tmp_path, rules=rules)).count == 1
    assert os.path.exists(f"{tmp_path}/landed/a/f0")


def test_exit_code_when_every_copy_failed(spark, tmp_path, monkeypatch, capsys):
    from quayside import __main__ as cli

    write_file(f"{tmp_path}/src/raw/d/one.txt", b"1")
    write_file(f"{tmp_path}/landed/d", b"a file where a folder is needed")
    argv = ["--source", f"{tmp_path}/src", "--ledger-path", f"{tmp_path}/ledger", "--root", f"file:{tmp_path}/landed",
            "--bucket-marker", "/src/", "--landing-marker", "/raw/"]
    assert cli.main(argv) == 1
    assert STATUS_SUCCESS not in capsys.readouterr().out


def test_large_files_get_tasks_of_their_own(spark):
    rows = [(f"/s/{k}", None, 10.0 if k < 3 else 0.1, "b", f"/t/{k % 4}/{k}") for k in range(60)]
    pend = spark.createDataFrame(rows, "source_path string, source_modified_at timestamp, source_size_mb double, bucket_path string, lakehouse_path string")
    plan = copying.copy_plan(pend, 4, copier=lambda a, b: None, num_large=3, large_mb=5.0)
    parts = [p for p in plan.rdd.glom().collect() if p]
    large = [p for p in parts if any(r["source_size_mb"] > 5 for r in p)]
    assert len(large) == 3 and all(len(p) == 1 for p in large) and sum(map(len, parts)) == 60
    folders = [{r["lakehouse_path"].rsplit("/", 1)[0] for r in p} for p in parts if p not in large]
    assert sum(len(f) for f in folders) <= 4 + len(folders)


def test_azure_logins():
    root, host = "abfss://ws@one.dfs.core.windows.net/", "one.dfs.core.windows.net"
    creds = {
        f"fs.azure.account.auth.type.{host}": "OAuth",
        "fs.azure.account.oauth.provider.type": "org.apache.hadoop.fs.azurebfs.oauth2.ClientCredsTokenProvider",
        "fs.azure.account.oauth2.client.id": "app", f"fs.azure.account.oauth2.client.secret.{host}": "secret",
        "fs.azure.account.oauth2.client.endpoint": "https://login.example/tenant-1/oauth2/token", "fs.azure.account.key": "unused",
    }
    name = {"account_name": "one"}
    assert azure_options(creds, root) == ("ws", name | {"tenant_id": "tenant-1", "client_id": "app", "client_secret": "secret"})
    msi = creds | {"fs.azure.account.oauth.provider.type": "x.MsiTokenProvider"}
    assert azure_options(msi, root) == ("ws", name | {"client_id": "app"})
    sas = {"fs.azure.account.auth.type": "SAS", "fs.azure.sas.fixed.token": "?sv=1"}
    assert azure_options(sas, root) == ("ws", name | {"sas_token": "sv=1"})
    for bad in ({"fs.azure.account.auth.type": "Custom"}, {"fs.azure.account.auth.type": "SAS"}, creds | {"fs.azure.account.oauth2.client.endpoint": "?"},
                creds | {"fs.azure.account.oauth.provider.type": "x.RefreshTokenBasedTokenProvider"}):
        with pytest.raises(ValueError, match="cannot log in"):
            azure_options(bad, root)
