from quayside.session import checkpoint_root, new_run_dir, qualify


def test_run_dirs_live_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    a, b = new_run_dir(spark, "x"), new_run_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/quayside/x-")


def test_qualify(spark):
    assert qualify(spark, "/tmp/some/where") == "file:/tmp/some/where"
    assert qualify(spark, "gs://bucket/key with space") == "gs://bucket/key with space"  # no Hadoop GCS here
    assert qualify(spark, "rel/dir").startswith("file:/") and qualify(spark, "rel/dir").endswith("/rel/dir")
