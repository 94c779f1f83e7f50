from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.__main__ import parse
from quayside.operators.guards import check_batch_size, pending_summary, preview, target_collisions
from quayside.operators.manifest import PathRules, build_manifest, unmapped


def _rows(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("s3://b/Files/raw/"), F.col("id").cast("string")).alias("source_path"),
        F.lit(datetime(2024, 1, 1)).alias("source_modified_at"),
        F.lit(0.5).alias("source_size_mb"),
    )


def test_cap_500_passes_501_raises(spark):
    assert check_batch_size(_rows(spark, 500), 500) == 500
    with pytest.raises(ValueError, match="more than 500"):
        check_batch_size(_rows(spark, 501), 500)
    assert check_batch_size(_rows(spark, 0), 500) == 0
    assert check_batch_size(_rows(spark, 501), None) is None


def test_summary_one_pass(spark):
    r = pending_summary(_rows(spark, 501), max_files=500).first()
    assert (r["n_files"], r["is_empty"], r["over_cap"]) == (501, False, True)
    r = pending_summary(_rows(spark, 0)).first()
    assert (r["n_files"], r["is_empty"], r["over_cap"]) == (0, True, False)


def test_preview_is_ordered_top_k(spark):
    df = _rows(spark, 100)
    got = [r["source_path"] for r in preview(df, 5).collect()]
    assert got == sorted(r["source_path"] for r in df.collect())[:5]
    assert preview(df, 7, order_by=None).count() == 7
    plan = preview(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_unmapped_and_collisions(spark):
    inv = spark.createDataFrame(
        [("s3://b/Files/raw/a.txt",), ("s3://b/x/a.txt",), ("s3://b/Files/raw/d/raw/a.txt",), ("s3://b/Files/raw/d/raw/b.txt",)],
        "source_path string",
    ).select("source_path", F.lit(datetime(2024, 1, 1)).alias("source_modified_at"), F.lit(0.0).alias("source_size_mb"))
    man = build_manifest(inv, PathRules(root="L", landing_marker="/raw/"))
    assert [r[0] for r in unmapped(man).collect()] == ["s3://b/x/a.txt"]
    clashes = {r["lakehouse_path"]: r["n_sources"] for r in target_collisions(man).collect()}
    assert clashes == {"L/d": 2}


def test_cli_parse():
    cfg = parse(["--source", "s3a://b/raw/", "--ledger-path", "/l", "--root", "R", "--landing-marker", "/raw/",
                 "--strip-ext", "*",
                 "--retry-failed", "--max-files", "500", "--listing", "binaryFile"])
    assert cfg.source == "s3a://b/raw/" and cfg.ledger.path == "/l" and cfg.ledger.fmt == "parquet"
    assert cfg.rules.root == "R" and cfg.rules.strip_ext == "*" and cfg.retry_failed and cfg.max_files == 500
    assert cfg.listing == "binaryFile"
    assert parse(["--source", "x", "--ledger-path", "/l", "--root", "R", "--landing-marker", "/m/"]).listing == "distributed"
    with pytest.raises(SystemExit):
        parse(["--source", "x", "--root", "R", "--landing-marker", "/m/"])  # a ledger is required
    with pytest.raises(SystemExit):
        parse(["--source", "x", "--ledger-path", "/l", "--root", "R"])  # so is the landing marker


def test_cli_main_end_to_end(spark, tmp_path, capsys):
    import json
    import os

    from quayside.__main__ import main

    for name in ("a/one.txt", "b/two.txt"):
        path = f"{tmp_path}/src/raw/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as fh:
            fh.write(name.encode())
    argv = ["--source", f"{tmp_path}/src", "--ledger-path", f"{tmp_path}/ledger", "--root", f"file:{tmp_path}/landed",
            "--bucket-marker", "/src/", "--landing-marker", "/raw/", "--preview", "2"]
    assert main(argv) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["copied"] == 2 and first["status"] == {"SUCCESS": 2}
    assert open(f"{tmp_path}/landed/b/two.txt", "rb").read() == b"b/two.txt"
    assert main(argv) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["copied"] == 0
