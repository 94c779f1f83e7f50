"""The append-only ledger (audit) table: S2-S4, K1, K2.

A ledger is named either by a catalog table (``name``) or by a storage path
(``path``); ``fmt`` picks the table format (parquet by default, ``delta`` where
the Delta jars are on the classpath).

``buckets``: a catalog parquet/orc ledger can be bucketed (and sorted) on
``source_path``. The per-path maximum then needs no shuffle, and the detection
join shuffles only the manifest, into the same buckets. Every append writes up
to one file per bucket it touches, so a bucketed ledger wants periodic
compaction; leave it unbucketed unless the ledger scan's shuffle matters.

``layout="runs"`` (path ledgers in parquet) makes an append atomic without a table format. Each append writes a
folder ``runs/<run id>`` of its own and then, in one call, an empty marker ``_commits/<run id>``; readers
see the folders that have a marker. An append that dies half-way is therefore invisible, and repeating it under
the same run id replaces what is left of it; one that has its marker is not repeated.

In that layout the newest versions need no scan of the whole ledger. ``compact_ledger`` writes
``snapshots/<id>``, one row for each source and landing path with its newest recorded times, and a marker that names the
runs it covers; ``versions`` reads the newest snapshot and only the runs since.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.schema import LEDGER_NOT_NULL, STATUS_SUCCESS, ledger_schema

# Rough on-disk bytes of one ledger row; sizes the number of files per append.
_ROW_BYTES = 400
_TARGET_FILE_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Ledger:
    name: str | None = None
    path: str | None = None
    fmt: str = "parquet"
    buckets: int | None = None
    layout: str = "table"  # or "runs"

    def __post_init__(self):
        if self.layout not in ("table", "runs"):
            raise ValueError("layout must be 'table' or 'runs'")
        if self.layout == "runs" and (self.path is None or self.fmt != "parquet"):
            raise ValueError("layout='runs' needs a path ledger in parquet")
        if (self.name is None) == (self.path is None):
            raise ValueError("a ledger needs exactly one of name= or path=")
        if self.buckets is not None and self.name is None:
            raise ValueError("bucketing needs a catalog table (name=)")


def _bucketed(writer, ledger: "Ledger"):
    if ledger.buckets:
        return writer.bucketBy(ledger.buckets, "source_path").sortBy("source_path")
    return writer


def empty_ledger(spark: SparkSession, schema: StructType | None = None) -> DataFrame:
    """An empty relation with the ledger schema."""
    return spark.createDataFrame([], schema or ledger_schema())


def _hadoop(spark: SparkSession, path: str):
    """``(file system, path)`` of Hadoop for a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def marker_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of a folder, in order; none where there is no folder."""
    fs, p = _hadoop(spark, folder)
    names = [str(s.getPath().getName()) for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if not n.startswith("."))


def _exists(spark: SparkSession, ledger: Ledger) -> bool:
    if ledger.name is not None:
        return spark.catalog.tableExists(ledger.name)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(ledger.path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _readable(spark: SparkSession, ledger: Ledger) -> bool:
    try:
        read_ledger(spark, ledger).schema
        return True
    except AnalysisException:
        return False


def ensure_ledger(spark: SparkSession, ledger: Ledger) -> None:
    """K1: create the ledger when absent; an existing one is left as it is,
    even if its schema differs. A path ledger whose folder exists without any
    data (an interrupted first creation) is initialised in place."""
    if ledger.layout == "runs":
        for folder in ("runs", "_commits"):
            fs, p = _hadoop(spark, f"{ledger.path}/{folder}")
            fs.mkdirs(p)
        return
    if _exists(spark, ledger):
        if ledger.name is None and not _readable(spark, ledger):
            empty_ledger(spark).write.format(ledger.fmt).mode("append").save(ledger.path)
        return
    writer = empty_ledger(spark).write.format(ledger.fmt).mode("ignore")
    if ledger.name is not None:
        _bucketed(writer, ledger).saveAsTable(ledger.name)
    else:
        writer.save(ledger.path)


def read_ledger(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """The ledger as a DataFrame (lazy; pruned to the columns a plan uses)."""
    if ledger.layout == "runs":
        return _read_runs(spark, ledger, committed_runs(spark, ledger))
    if ledger.name is not None:
        return spark.table(ledger.name)
    return spark.read.format(ledger.fmt).load(ledger.path)


def _read_runs(spark: SparkSession, ledger: Ledger, runs: list[str]) -> DataFrame:
    if not runs:
        return empty_ledger(spark)
    return spark.read.schema(ledger_schema()).parquet(*[f"{ledger.path}/runs/{r}" for r in runs])


def committed_runs(spark: SparkSession, ledger: Ledger) -> list[str]:
    """Ids of the runs whose appends are whole."""
    return marker_names(spark, f"{ledger.path}/_commits")


def _snapshot(spark: SparkSession, ledger: Ledger) -> tuple[str | None, list[str]]:
    """The newest snapshot, and the runs it covers."""
    names = marker_names(spark, f"{ledger.path}/_snapshots")
    if not names:
        return None, []
    (row,) = spark.read.text(f"{ledger.path}/_snapshots/{names[-1]}").collect()
    return names[-1], json.loads(row["value"])


def versions(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """``source_path, lakehouse_path, latest_any, latest_success`` of a ledger in runs: the newest recorded time of each pair, and of
    its successful rows, from the newest snapshot and the runs since."""
    name, covered = _snapshot(spark, ledger)
    times = F.max("source_modified_at").alias("latest_any"), F.max(F.when(F.col("status") == STATUS_SUCCESS, F.col("source_modified_at"))).alias("latest_success")
    known = set(covered)
    since = _read_runs(spark, ledger, [r for r in committed_runs(spark, ledger) if r not in known])
    since = since.groupBy("source_path", "lakehouse_path").agg(*times)
    if name is None:
        return since
    return spark.read.schema(since.schema).parquet(f"{ledger.path}/snapshots/{name}").union(since)


def compact_ledger(spark: SparkSession, ledger: Ledger, after: int = 1) -> str | None:
    """Write a new snapshot, where at least ``after`` runs came since the last one: its id. One that dies half-way has no
    marker and is not read; the ledger's rows stay as they are."""
    name, covered = _snapshot(spark, ledger)
    runs = committed_runs(spark, ledger)
    if len(runs) - len(covered) < max(1, after):
        return None
    new = f"{len(runs):08d}-{uuid.uuid4().hex[:12]}"
    rows = versions(spark, ledger).groupBy("source_path", "lakehouse_path").agg(*[F.max(c).alias(c) for c in ("latest_any", "latest_success")])
    rows.write.parquet(f"{ledger.path}/snapshots/{new}")
    write_marker(spark, f"{ledger.path}/_snapshots/{new}", json.dumps(runs))
    return new


def write_marker(spark: SparkSession, path: str, text: str = "") -> None:
    """A small file that is there with its whole content or not at all; an existing one is left."""
    fs, p = _hadoop(spark, path)
    if fs.exists(p):
        return
    if not text:
        fs.mkdirs(p.getParent())
        fs.createNewFile(p)
        return
    _, tmp = _hadoop(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(tmp, p) and not fs.exists(p):
        raise OSError(f"cannot write {path}")


def _append_run(spark: SparkSession, audit: DataFrame, ledger: Ledger, files: int, run_id: str | None) -> None:
    run_id = run_id or uuid.uuid4().hex
    if run_id in committed_runs(spark, ledger):
        return
    audit.coalesce(files).write.mode("overwrite").parquet(f"{ledger.path}/runs/{run_id}")
    write_marker(spark, f"{ledger.path}/_commits/{run_id}")


def ledger_table_schema(spark: SparkSession, ledger: Ledger) -> StructType:
    """S3: the schema as stored, which wins over the declared one."""
    return read_ledger(spark, ledger).schema


def null_counts(df: DataFrame) -> Row:
    """Rows (``n``) and NULLs in the ledger's NOT NULL columns, in one aggregate pass."""
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in LEDGER_NOT_NULL]).first()


def null_violations(df: DataFrame) -> dict[str, int]:
    """Counts of NULLs in the ledger's NOT NULL columns."""
    row = null_counts(df)
    return {c: row[c] for c in LEDGER_NOT_NULL if row[c]}


def append_ledger(
    spark: SparkSession,
    audit: DataFrame,
    ledger: Ledger,
    row_count: int | None = None,
    check_nulls: bool = True,
    run_id: str | None = None,
) -> int:
    """K2: append audit rows; nothing is written when there are none.

    Rows are aligned by name and cast to the stored schema. The NOT NULL
    contract is checked explicitly (parquet does not keep it). Output files are
    sized from the row count so repeated small appends do not litter the table
    with one file per copy task. ``audit`` is expected to be staged rows (a
    cheap scan), not a lazy copy plan: it is evaluated by the check and by the
    write. ``run_id`` names the append in a ledger in runs: the same one twice appends once.
    """
    counts = null_counts(audit) if check_nulls and row_count != 0 else None
    n = row_count if row_count is not None else counts["n"] if counts else audit.count()
    if n == 0:
        return 0
    if counts:
        bad = {c: counts[c] for c in LEDGER_NOT_NULL if counts[c]}
        if bad:
            raise ValueError(f"audit rows violate NOT NULL ledger columns: {bad}")
    target = ledger_table_schema(spark, ledger)
    have = set(audit.columns)
    missing = [f.name for f in target.fields if f.name not in have and not f.nullable]
    if missing:
        raise ValueError(f"audit rows lack ledger columns {missing}")
    # stored schema wins: columns the audit rows lack are NULL (nullable ones only)
    aligned = audit.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )
    files = max(1, math.ceil(n * _ROW_BYTES / _TARGET_FILE_BYTES))
    # audit rows are staged parquet: fewer output files without a shuffle
    if ledger.layout == "runs":
        _append_run(spark, aligned, ledger, files, run_id)
        return n
    writer = aligned.coalesce(files).write.format(ledger.fmt).mode("append")
    if ledger.name is not None:
        _bucketed(writer, ledger).saveAsTable(ledger.name)
    else:
        writer.save(ledger.path)
    return n
