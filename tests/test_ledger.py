from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.schema import LEDGER_COLUMNS, ledger_schema
from quayside.sources.ledger import Ledger, append_ledger, ensure_ledger, read_ledger

ROW = ("p", datetime(2024, 1, 1), 1.0, "b", "l", datetime(2024, 1, 2), "SUCCESS", None)


def test_path_ledger_create_append_read(spark, tmp_path):
    led = Ledger(path=str(tmp_path / "ledger"))
    ensure_ledger(spark, led)
    ensure_ledger(spark, led)  # second call is a no-op
    assert read_ledger(spark, led).count() == 0
    assert read_ledger(spark, led).columns == LEDGER_COLUMNS
    audit = spark.createDataFrame([ROW], ledger_schema())
    assert append_ledger(spark, audit, led) == 1
    assert append_ledger(spark, audit.limit(0), led) == 0
    assert read_ledger(spark, led).count() == 1


def test_existing_table_with_other_schema_is_kept(spark, tmp_path):
    led = Ledger(path=str(tmp_path / "other"))
    spark.createDataFrame([("x",)], "source_path string").write.parquet(led.path)
    ensure_ledger(spark, led)
    assert read_ledger(spark, led).columns == ["source_path"]


def test_not_null_columns_are_checked(spark, tmp_path):
    led = Ledger(path=str(tmp_path / "nn"))
    ensure_ledger(spark, led)
    bad = spark.createDataFrame([ROW], ledger_schema()).withColumn("status", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="status"):
        append_ledger(spark, bad, led)


def test_catalog_table_ledger(spark, tmp_path):
    name = "quayside_test_ledger"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    led = Ledger(name=name)
    ensure_ledger(spark, led)
    append_ledger(spark, spark.createDataFrame([ROW], ledger_schema()), led)
    assert read_ledger(spark, led).count() == 1
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_ledger_needs_one_locator():
    with pytest.raises(ValueError):
        Ledger()
    with pytest.raises(ValueError):
        Ledger(name="a", path="b")


def test_empty_existing_folder_is_initialised(spark, tmp_path):
    folder = tmp_path / "half-made"
    folder.mkdir()
    led = Ledger(path=str(folder))
    ensure_ledger(spark, led)
    assert read_ledger(spark, led).count() == 0
    assert read_ledger(spark, led).columns == LEDGER_COLUMNS


def test_bucketed_ledger_detection_shuffles_only_the_manifest(spark, tmp_path):
    from quayside.operators.detect import latest_versions, pending_files

    name = "quayside_bucketed_ledger"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    led = Ledger(name=name, buckets=8)
    ensure_ledger(spark, led)
    rows = [(f"p{i}", datetime(2024, 1, 1 + i % 5), 1.0, "b", "l", datetime(2024, 2, 1), "SUCCESS", None) for i in range(40)]
    append_ledger(spark, spark.createDataFrame(rows, ledger_schema()), led)
    append_ledger(spark, spark.createDataFrame(rows[:10], ledger_schema()), led)  # a second append keeps the spec
    agg_plan = latest_versions(read_ledger(spark, led))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in agg_plan
    man = spark.createDataFrame(
        [(f"p{i}", datetime(2024, 1, 3), 1.0, "b", "l") for i in range(50)],
        "source_path string, source_modified_at timestamp, source_size_mb double, bucket_path string, lakehouse_path string",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pending_files(man, read_ledger(spark, led))
        expected = sorted([f"p{i}" for i in range(40) if 1 + i % 5 < 3] + [f"p{i}" for i in range(40, 50)])
        assert sorted(r[0] for r in plan.collect()) == expected
        final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in final
    assert final.count("Exchange hashpartitioning") == 1  # the manifest side only
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    with pytest.raises(ValueError):
        Ledger(path="/x", buckets=4)


def test_extra_nullable_ledger_column_is_filled_with_null(spark, tmp_path):
    led = Ledger(path=str(tmp_path / "wider"))
    wider = ledger_schema().add("note", "string", True)
    spark.createDataFrame([], wider).write.parquet(led.path)
    ensure_ledger(spark, led)  # exists: kept with its own schema
    append_ledger(spark, spark.createDataFrame([ROW], ledger_schema()), led)
    rows = read_ledger(spark, led).collect()
    assert len(rows) == 1 and rows[0]["note"] is None and rows[0]["source_path"] == "p"
