"""Session construction for tests and the benchmark, and the shared staging area.

Staging lives under the cluster's checkpoint directory (``spark.checkpoint.dir``),
which on a cluster is a shared, fault-tolerant file system. Only a local-mode
session that has none gets a directory of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "quayside",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory named by the session.

    When neither ``spark.checkpoint.dir`` nor a SparkContext checkpoint dir is
    set, a local-mode session gets a fresh temporary one; a cluster session must
    name one (a machine-local folder is not visible to other executors).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared directory "
            "(HDFS / object store) so staged snapshots survive executor loss"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="quayside-ckpt-"))
    return sc.getCheckpointDir()


def new_run_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, unique folder under the checkpoint root for one run's staged data."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/quayside/{label}-{uuid.uuid4().hex[:16]}"


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualify a path against the cluster's default file system (driver side,
    one call), so executors can open it without the Hadoop configuration. A URI
    whose scheme has no Hadoop file system here is already absolute: kept as is."""
    from py4j.protocol import Py4JJavaError

    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    try:
        fs = p.getFileSystem(hconf)
    except Py4JJavaError:
        if "://" in path:
            return path
        raise
    return str(fs.makeQualified(p).toString())
