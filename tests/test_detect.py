from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators.detect import latest_versions, pending_files
from quayside.schema import ledger_schema

T0 = datetime(1970, 1, 1, 0, 0, 0)
T1 = datetime(2024, 1, 1, 10, 0, 0)
T2 = datetime(2024, 1, 2, 10, 0, 0)
T3 = datetime(2024, 1, 3, 10, 0, 0)

MAN = "source_path string, source_modified_at timestamp, source_size_mb double, bucket_path string, lakehouse_path string"


def manifest(spark, rows):
    return spark.createDataFrame([(p, t, 1.0, "b/" + p, "l/" + p) for p, t in rows], MAN)


def ledger(spark, rows):
    out = []
    for r in rows:
        p, t, status = (r + ("SUCCESS",))[:3]
        out.append((p, t, 1.0, "b/" + p, "l/" + p, T3, status, None if status == "SUCCESS" else "boom"))
    return spark.createDataFrame(out, ledger_schema())


def pending_set(spark, man_rows, led_rows, **kw):
    return sorted(r["source_path"] for r in pending_files(manifest(spark, man_rows), ledger(spark, led_rows), **kw).collect())


def test_contract_cases(spark):
    man = [
        ("unseen", T1), ("newer", T2), ("equal", T1), ("older", T1), ("several", T2),
        ("failed", T1), ("null_mtime", None), ("epoch", T0),
    ]
    led = [
        ("newer", T1), ("equal", T1), ("older", T2), ("several", T1), ("several", T3),
        ("failed", T1, "ERROR"), ("gone", T1),
    ]
    assert pending_set(spark, man, led) == ["newer", "unseen"]
    assert pending_set(spark, man, led, retry_failed=True) == ["failed", "newer", "unseen"]


def test_empty_ledger_every_file_after_epoch_is_pending(spark):
    man = [("a", T1), ("b", T0), ("c", None)]
    assert pending_set(spark, man, []) == ["a"]


def test_empty_source(spark):
    assert pending_set(spark, [], [("a", T1)]) == []


def test_latest_versions_ignores_status_by_default(spark):
    led = ledger(spark, [("a", T1), ("a", T2, "ERROR"), ("b", T1, "ERROR")])
    got = {r[0]: r[1] for r in latest_versions(led).collect()}
    assert got == {"a": T2, "b": T1}
    got = {r[0]: r[1] for r in latest_versions(led, retry_failed=True).collect()}
    assert got == {"a": T1}


def test_output_columns_and_ntz_manifest_vs_ltz_ledger(spark):
    man = manifest(spark, [("a", T2), ("b", T1)]).withColumn(
        "source_modified_at", F.col("source_modified_at").cast("timestamp_ntz")
    )
    out = pending_files(man, ledger(spark, [("a", T1), ("b", T1)]))
    assert out.columns == ["source_path", "source_modified_at", "source_size_mb", "bucket_path", "lakehouse_path"]
    assert [r[0] for r in out.collect()] == ["a"]


def test_plan_is_left_outer_and_ledger_pruned(spark, tmp_path):
    led_dir = str(tmp_path / "ledger")
    ledger(spark, [("a", T1)]).write.parquet(led_dir)
    plan = pending_files(manifest(spark, [("a", T2)]), spark.read.parquet(led_dir))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" in text
    assert "ReadSchema: struct<source_path:string,source_modified_at:timestamp>" in text
    assert "partial_max" in text


def _model(man, led, retry_failed=False):
    latest = {}
    for p, t, ok in led:
        if retry_failed and not ok:
            continue
        latest[p] = max(latest.get(p, t), t)
    return sorted(p for p, t in man if t is not None and t > latest.get(p, T0))


_paths = st.sampled_from([f"p{i}" for i in range(6)])
_times = st.sampled_from([T0, T1, T2, T3])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    man=st.dictionaries(_paths, st.one_of(st.none(), _times), max_size=6),
    led=st.lists(st.tuples(_paths, _times, st.booleans()), max_size=8),
    retry=st.booleans(),
)
def test_matches_python_model(spark, man, led, retry):
    man_rows = list(man.items())
    led_rows = [(p, t, "SUCCESS" if ok else "ERROR") for p, t, ok in led]
    assert pending_set(spark, man_rows, led_rows, retry_failed=retry) == _model(man_rows, led, retry)


def test_shuffle_join_plan_has_two_exchanges(spark, tmp_path):
    led_dir, man_dir = str(tmp_path / "ledger"), str(tmp_path / "manifest")
    ledger(spark, [("a", T1), ("a", T2), ("b", T1)]).write.parquet(led_dir)
    manifest(spark, [("a", T3), ("c", T1)]).write.parquet(man_dir)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pending_files(spark.read.parquet(man_dir), spark.read.parquet(led_dir))
        assert sorted(r[0] for r in plan.collect()) == ["a", "c"]
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "LeftOuter" in text
    # one shuffle per side: the aggregate's hash partitioning is reused by the join
    final = text.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(source_path") == 2


def test_retry_failed_status_filter_reaches_the_scan(spark, tmp_path):
    led_dir = str(tmp_path / "ledger")
    ledger(spark, [("a", T1), ("a", T2, "ERROR")]).write.parquet(led_dir)
    plan = pending_files(manifest(spark, [("a", T2)]), spark.read.parquet(led_dir), retry_failed=True)
    assert [r[0] for r in plan.collect()] == ["a"]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,SUCCESS)" in text  # pushed to the parquet reader
    assert "ReadSchema: struct<source_path:string,source_modified_at:timestamp,status:string>" in text
