"""Distributed file copy with one audit row per file.

Placement: a run of more than ``mb_per_task`` MiB is dealt by weight (``deal_by_bytes``): rows are put in
the order of their target paths, a running sum of their weights (bytes, and a share for each file) is cut
at equal steps, and every row goes to the task of its step, so neighbours in a folder meet in one task
and no task holds more than its step and one file. Files of ``mb_per_task`` or more are tasks by themselves; onto a
local or mounted disk they are copied in parts by several tasks (``operators/parts.py``). A smaller run, of up to
``FEW_FILES`` files, is range-partitioned by target path, which costs no further job. Where ``mb_per_task`` makes more tasks than
their bytes and files are worth (``task_limit``), neighbouring ones share a Spark task. Spark runs tasks in the order of their
numbers: neighbours get numbers far apart, as creations and renames in one folder wait for each other. Each task copies its files
with ``pyarrow.fs`` (server-side ``copy_file`` when source and target share a file
system, a chunked stream otherwise), one at a time on a local disk and on a
thread pool against HDFS or object stores, where copies wait on the network.
Nothing about the file list passes through the driver.

A target is never replaced by part of a file. The bytes go to a hidden temporary
name beside it, their count is compared with the source's, and only then the
temporary takes the target's place: by rename on local disks and HDFS, by a
server-side copy and the removal of the temporary on object stores (where one
object copied within a store skips the temporary: that copy is a single request, and a
count that differs is an error unless the source itself has changed to it meanwhile).
A failed copy removes its temporary and leaves the old target. ``verify="content"`` also
compares a digest of the bytes read from the source with one of the bytes read back from the
temporary.

A copy that fails for another reason than a missing file or a refused permission is tried again, ``retries``
times with growing pauses, before it becomes an ERROR row.

Side effects and retries: a task may be re-run (executor loss, speculation); every
copy is idempotent. The copy plan is evaluated exactly once by writing its audit
rows to a staging folder (the write job's commit protocol keeps one attempt per
task); counts, previews and the ledger append all read that staging output.
"""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from quayside.operators.parts import copy_in_parts, local_target, task_limit
from quayside.schema import MANIFEST_COLUMNS, STATUS_ERROR, STATUS_SUCCESS, audit_schema, ledger_schema
from quayside.session import qualify
from quayside.sources.fsuri import FileSystems, has_scheme, storage_settings

# Ship this module's task code by value: executors need pyarrow/pandas only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CHUNK_BYTES = 8 * 1024 * 1024
# Bytes (MiB) of a copy task; a file this large is one by itself.
MB_PER_TASK = 2048.0
FILES_PER_TASK = 2000
# Files up to which a run of less than ``MB_PER_TASK`` is range-partitioned.
FEW_FILES = 20_000
# Further tries of a failed copy, and seconds before the first of them.
RETRIES = 2
RETRY_PAUSE = 0.2


def audit_records(
    df: DataFrame,
    copied_at: Column | None = None,
    status: str = STATUS_SUCCESS,
    error: str | None = None,
) -> DataFrame:
    """Manifest rows + ``copied_at`` (now by default), ``status``, ``error``."""
    return df.select(
        *MANIFEST_COLUMNS,
        (copied_at if copied_at is not None else F.current_timestamp()).alias("copied_at"),
        F.lit(status).alias("status"),
        F.lit(error).cast("string").alias("error"),
    )


def plan_copy_tasks(
    spark: SparkSession,
    n_files: int,
    total_mb: float,
    files_per_task: int = FILES_PER_TASK,
    mb_per_task: float = MB_PER_TASK,
) -> int:
    """Number of copy tasks: enough that no task holds more than
    ``files_per_task`` files or ``mb_per_task`` MiB, and at least one per core
    when there are that many files (copies are I/O-bound)."""
    if n_files <= 0:
        return 1
    cores = max(1, spark.sparkContext.defaultParallelism)
    want = max(
        math.ceil(n_files / files_per_task),
        math.ceil((total_mb or 0.0) / mb_per_task),
        min(n_files, cores),
    )
    return int(max(1, min(want, n_files)))


def _copier(
    threads: int | None,
    chunk_bytes: int,
    copier=None,
    relative_to: str | None = None,
    counters: tuple | None = None,
    settings: dict | None = None,
    root: tuple[str, str] | None = None,
    verify: str = "size",
    retries: int = RETRIES,
    pause: float = RETRY_PAUSE,
    done_dir: str | None = None,
    zone: str = "UTC",
):
    """Build the per-task function given to ``mapInPandas``.

    ``threads=None`` picks the pool size from the target file system: copies to
    a local disk are bound by directory locks and run one at a time per task
    (measured: 8 threads were 2.5x slower than 1), copies to HDFS or an object
    store are bound by network latency and run 16 at a time.

    ``copier``: an optional picklable ``(source_uri, target_uri) -> None`` that
    replaces the built-in ``pyarrow.fs`` copy (for stores pyarrow cannot open);
    it must overwrite the target and raise on failure.

    ``relative_to``: a qualified base URI for landing paths given without a
    scheme and not absolute (Spark resolves such paths against the default file
    system's working directory; the ledger keeps them as given).

    ``root``: ``(as given, qualified)``; a landing path that begins with the first is
    opened under the second. ``settings``: see ``storage_settings``.

    ``verify``: ``"size"`` or ``"content"``; ``retries``, ``pause``: further tries of a file and
    the seconds before the first of them (doubled each time, at most 30, with jitter). None of the three
    but ``retries`` concerns a ``copier``.

    ``done_dir``: where a task leaves the rows of each batch as soon as it is copied, whatever becomes of the
    job (see ``landed_rows``); ``zone`` is the session's time zone.

    ``counters``: optional ``(success, error)`` Spark accumulators. Updates made
    inside an action count once per successful task, so the totals are exact
    without another pass over the audit rows.
    """

    def run(batches):
        import hashlib
        import posixpath
        import random
        import time
        import uuid
        from concurrent.futures import ThreadPoolExecutor
        from datetime import datetime, timezone

        import pandas as pd

        resolve = FileSystems(settings).resolve

        def digest(fs, path):
            seen = hashlib.blake2b(digest_size=16)
            with fs.open_input_stream(path) as src:
                while block := src.read(chunk_bytes):
                    seen.update(block)
            return seen.digest()

        def stream(sfs, spath, dfs, dpath):
            seen = hashlib.blake2b(digest_size=16)
            with sfs.open_input_stream(spath) as src, dfs.open_output_stream(dpath) as dst:
                while block := src.read(chunk_bytes):
                    if verify == "content":
                        seen.update(block)
                    dst.write(block)
            return seen.digest()

        def check(fs, path, size):
            got = fs.get_file_info(path).size
            if got != size:
                raise OSError(f"{got} bytes arrived of {size}")

        def leave(out):
            """A whole Parquet file or none: object stores show it when it is closed, folders when it is renamed."""
            import numpy as np
            import pyarrow as pa
            import pyarrow.parquet as pq

            kinds = {"source_size_mb": pa.float64(), "source_modified_at": pa.timestamp("us", "UTC"), "copied_at": pa.timestamp("us", "UTC")}
            at = pd.to_datetime(out["source_modified_at"])
            if at.dt.tz is None:  # Spark hands times over in the session's zone
                at = at.dt.tz_localize(zone, ambiguous=np.ones(len(at), bool), nonexistent="shift_forward")
            rows = pa.Table.from_pandas(out.assign(source_modified_at=at), pa.schema([(c, kinds.get(c, pa.string())) for c in out.columns]), preserve_index=False)
            fs, folder = resolve(done_dir)
            name = f"{uuid.uuid4().hex}.parquet"
            folders = fs.type_name in ("local", "hdfs")
            if folders:
                fs.create_dir(folder, recursive=True)
            path = f"{folder}/.{name}.inflight" if folders else f"{folder}/{name}"
            with fs.open_output_stream(path) as sink:
                pq.write_table(rows, sink)
            if folders:
                fs.move(path, f"{folder}/{name}")

        made_dirs: set = set()

        def absolute(uri):
            if root and (uri + "/").startswith(root[0].rstrip("/") + "/"):
                return root[1].rstrip("/") + uri[len(root[0].rstrip("/")):]
            if relative_to and not has_scheme(uri) and not uri.startswith("/"):
                return relative_to.rstrip("/") + "/" + uri
            return uri

        def transfer(src_uri, dst_uri):
            if copier is not None:
                return copier(src_uri, dst_uri)
            sfs, spath = resolve(src_uri)
            dfs, dpath = resolve(dst_uri)
            size = sfs.get_file_info(spath).size
            if size is None:
                raise FileNotFoundError(src_uri)
            parent = posixpath.dirname(dpath)
            folders = dfs.type_name in ("local", "hdfs")  # object stores have none to make
            if folders and parent and (id(dfs), parent) not in made_dirs:
                dfs.create_dir(parent, recursive=True)
                made_dirs.add((id(dfs), parent))
            if not folders and verify == "size" and sfs.equals(dfs):
                try:
                    sfs.copy_file(spath, dpath)  # one request: whole or not at all
                except OSError:
                    pass  # e.g. over the size limit of one request: through a temporary
                else:
                    if dfs.get_file_info(dpath).size != size:
                        check(dfs, dpath, sfs.get_file_info(spath).size)
                    return None
            tmp = posixpath.join(parent, f".{posixpath.basename(dpath)}.{uuid.uuid4().hex}.inflight")
            try:
                if folders and sfs.equals(dfs):
                    sfs.copy_file(spath, tmp)
                    sent = digest(sfs, spath) if verify == "content" else None
                else:
                    sent = stream(sfs, spath, dfs, tmp)
                check(dfs, tmp, size)
                if verify == "content" and digest(dfs, tmp) != sent:
                    raise OSError("other bytes arrived than were read")
                if folders:
                    dfs.move(tmp, dpath)
                else:
                    dfs.copy_file(tmp, dpath)
                    dfs.delete_file(tmp)
            except BaseException:
                try:
                    dfs.delete_file(tmp)
                except Exception:
                    pass
                raise

        def copy_one(src_uri, dst_uri):
            if dst_uri is None or src_uri is None:
                return STATUS_ERROR, "ValueError: no landing path for this source", datetime.now(timezone.utc)
            for again in range(retries, -1, -1):
                try:
                    transfer(src_uri, absolute(dst_uri))
                    return STATUS_SUCCESS, None, datetime.now(timezone.utc)
                except Exception as exc:  # one failed file never fails the task
                    if not again or isinstance(exc, (FileNotFoundError, PermissionError, IsADirectoryError, NotADirectoryError, ValueError)):
                        return STATUS_ERROR, f"{type(exc).__name__}: {exc}", datetime.now(timezone.utc)
                    time.sleep(min(pause * 2 ** (retries - again), 30) * (0.5 + random.random()))

        def pool_size(pdf) -> int:
            if threads is not None:
                return max(1, threads)
            if copier is not None:
                return 8
            first = next((u for u in pdf["lakehouse_path"] if u is not None), None)
            if first is None:
                return 1
            try:
                fs_type = resolve(absolute(first))[0].type_name
            except Exception:
                return 1
            return 1 if fs_type == "local" else 16

        pool = None
        try:
            for pdf in batches:
                if pool is None:
                    size = pool_size(pdf)
                    pool = ThreadPoolExecutor(max_workers=size) if size > 1 else False
                srcs, dsts = list(pdf["source_path"]), list(pdf["lakehouse_path"])
                results = list(pool.map(copy_one, srcs, dsts)) if pool else list(map(copy_one, srcs, dsts))
                out = pdf[MANIFEST_COLUMNS].copy()
                out["copied_at"] = pd.to_datetime([r[2] for r in results], utc=True)
                out["status"] = [r[0] for r in results]
                out["error"] = [r[1] for r in results]
                if counters is not None:
                    n_ok = sum(1 for r in results if r[0] == STATUS_SUCCESS)
                    counters[0].add(n_ok)
                    counters[1].add(len(results) - n_ok)
                if done_dir:
                    leave(out)
                yield out
        finally:
            if pool:
                pool.shutdown()

    return run


def copy_plan(
    pending: DataFrame,
    num_tasks: int,
    threads: int | None = None,
    chunk_bytes: int = _CHUNK_BYTES,
    copier=None,
    relative_to: str | None = None,
    counters: tuple | None = None,
    settings: dict | None = None,
    root: tuple[str, str] | None = None,
    num_large: int = 0,
    large_mb: float = MB_PER_TASK,
    verify: str = "size",
    retries: int = RETRIES,
    task: str | None = None,
    done_dir: str | None = None,
) -> DataFrame:
    """The lazy copy: each evaluation copies again, so evaluate it once
    (``copy_files`` does). ``num_large`` tasks take the files of ``large_mb`` or more.
    ``task``: a column that says which of the ``num_tasks`` tasks a row belongs to."""
    if verify not in ("size", "content"):
        raise ValueError("verify must be 'size' or 'content'")
    schema = audit_schema(pending.schema)
    rows = pending.select(*MANIFEST_COLUMNS)
    run = _copier(threads, chunk_bytes, copier, relative_to, counters, settings, root, verify, retries, done_dir=done_dir, zone=pending.sparkSession.conf.get("spark.sql.session.timeZone"))
    if task:
        dealt = pending.repartitionById(num_tasks, F.col(task).cast("int")).select(*MANIFEST_COLUMNS)
    elif num_large:
        large = F.coalesce(F.col("source_size_mb") >= large_mb, F.lit(False))
        dealt = rows.filter(large).repartitionByRange(num_large, "source_path").union(
            rows.filter(~large).repartitionByRange(max(1, num_tasks), "lakehouse_path")
        )
    else:
        dealt = rows.repartitionByRange(max(1, num_tasks), "lakehouse_path")
    return dealt.mapInPandas(run, schema)


def size_aggregates(where: Column | None = None, mb_per_task: float = MB_PER_TASK) -> list[Column]:
    """Files and MiB of the rows ``where`` holds, and of those large enough for a task of their own."""
    where = F.lit(True) if where is None else where
    mb, large = F.col("source_size_mb"), where & (F.col("source_size_mb") >= mb_per_task)
    return [
        F.count_if(where).alias("n_files"), F.coalesce(F.sum(F.when(where, mb)), F.lit(0.0)).alias("mb"),
        F.count_if(large).alias("n_large"), F.coalesce(F.sum(F.when(large, mb)), F.lit(0.0)).alias("large_mb"),
    ]


def deal_by_bytes(
    spark: SparkSession, pending: DataFrame, staging_dir: str, sizes: Row, files_per_task: int = FILES_PER_TASK, mb_per_task: float = MB_PER_TASK
) -> tuple[DataFrame, int]:
    """Pending rows with ``task``, and the number of tasks: cuts at equal weights of the files in the order of their
    target paths. A file weighs its share of ``mb_per_task`` and one of ``files_per_task``, so no task of several files
    holds more than twice either; one of ``mb_per_task`` or more is a task of its own.

    Rows are ordered over range partitions and staged; sums of whole partitions and a running sum inside each give
    the place of every row. ``sizes``: the ``size_aggregates`` of ``pending``."""
    mb = F.coalesce("source_size_mb", F.lit(0.0))
    large = mb >= mb_per_task
    n_small, small_mb = sizes["n_files"] - sizes["n_large"], sizes["mb"] - sizes["large_mb"]
    total = small_mb / mb_per_task + n_small / files_per_task
    steps = max(math.ceil(total), min(n_small, spark.sparkContext.defaultParallelism))
    weight = F.when(large, 0.0).otherwise((mb / mb_per_task + 1 / files_per_task) * (steps / total if total else 1.0))
    n_parts = max(spark.sparkContext.defaultParallelism, math.ceil(sizes["n_files"] / 200_000))
    rows = pending.select(*MANIFEST_COLUMNS, weight.alias("weight"), large.cast("int").alias("large"))
    rows = rows.repartitionByRange(n_parts, "lakehouse_path", "source_path").sortWithinPartitions("lakehouse_path", "source_path")
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    rows.write.mode("errorifexists").parquet(staging_dir)
    rows = spark.read.schema(rows.schema).parquet(staging_dir).withColumn("part", F.shiftright("at", 33))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    parts = rows.groupBy("part").agg(F.sum("weight").alias("w"), F.sum("large").alias("n"))
    parts = parts.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("w", "n")])
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = {c: F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in ("weight", "large")}
    rows = rows.select("*", before["weight"].alias("w"), before["large"].alias("n")).join(parts, "part")
    small_task = F.least(F.floor(F.col("w") + F.col("w_before")), F.lit(max(steps - 1, 0)))
    task = F.when(F.col("large") == 1, F.lit(steps) + F.col("n") + F.col("n_before")).otherwise(small_task)
    return rows.select(*MANIFEST_COLUMNS, task.cast("int").alias("task")), int(max(1, steps + sizes["n_large"]))


def apart(task: Column, n: int, limit: int) -> tuple[Column, int]:
    """Which of at most ``limit`` Spark tasks one of ``n`` tasks belongs to, and how many those are: neighbours share one, and
    those next to each other have numbers far apart."""
    n_tasks = min(n, limit)
    stride = next(k for k in range(max(1, round(n_tasks * 0.618)), n_tasks + 1) if math.gcd(k, n_tasks) == 1 or n_tasks == 1)
    shared = F.floor(task.cast("long") * n_tasks / n) if n_tasks < n else task.cast("long")
    return F.pmod(shared * stride, F.lit(n_tasks)).cast("int"), n_tasks


def copy_files(
    spark: SparkSession,
    pending: DataFrame,
    staging_dir: str,
    num_tasks: int | None = None,
    threads: int | None = None,
    copier=None,
    relative_to: str | None = None,
    counters: tuple | None = None,
    root: tuple[str, str] | None = None,
    sizes: Row | None = None,
    verify: str = "size",
    retries: int = RETRIES,
    mb_per_task: float = MB_PER_TASK,
    part_mb: float | None = None,
    done_dir: str | None = None,
) -> DataFrame:
    """Copy every pending file on the executors, stage the audit rows once
    at ``staging_dir`` (parquet), and return them read back from there.

    ``sizes``: the ``size_aggregates`` of ``pending``, where the caller has them already (they hold for the
    default ``mb_per_task``). Relative landing paths resolve against ``relative_to``, by default the
    default file system's working directory, as Spark resolves them. ``part_mb``: size of the parts in which files of
    ``mb_per_task`` or more are copied onto a local or mounted disk (None: a quarter of it; 0: whole)."""
    if relative_to is None:
        relative_to = qualify(spark, ".")
    more = {"threads": threads, "copier": copier, "relative_to": relative_to, "counters": counters, "settings": storage_settings(spark), "root": root}
    more |= {"verify": verify, "retries": retries, "done_dir": done_dir}
    if num_tasks is not None:
        plan = copy_plan(pending, num_tasks, **more)
    else:
        row = sizes if sizes is not None and mb_per_task == MB_PER_TASK else pending.agg(*size_aggregates(mb_per_task=mb_per_task)).first()
        if row["mb"] <= mb_per_task and row["n_files"] <= FEW_FILES:
            plan = copy_plan(pending, plan_copy_tasks(spark, row["n_files"], row["mb"]), **more)
        else:
            in_parts = None
            if row["n_large"] and part_mb != 0 and copier is None:
                large = F.coalesce(F.col("source_size_mb") >= mb_per_task, F.lit(False)) & local_target(F.col("lakehouse_path"), relative_to, root)
                options = {k: more[k] for k in ("relative_to", "counters", "settings", "root", "verify", "retries")}
                in_parts = copy_in_parts(spark, pending.filter(large), f"{staging_dir}-parts", part_mb or mb_per_task / 4, **options)
                pending = pending.filter(~large)
                row = pending.agg(*size_aggregates(mb_per_task=mb_per_task)).first()
            dealt, n = deal_by_bytes(spark, pending, f"{staging_dir}-order", row, mb_per_task=mb_per_task)
            task, n = apart(F.col("task"), n, task_limit(spark, row["n_files"], row["mb"]))
            plan = copy_plan(dealt.withColumn("task", task), n, task="task", **more)
            plan = plan if in_parts is None else plan.union(in_parts)
    plan.write.mode("errorifexists").parquet(staging_dir)
    return spark.read.schema(plan.schema).parquet(staging_dir)


def landed_rows(spark: SparkSession, staging_dir: str, done_dir: str) -> DataFrame | None:
    """What a copy job that may have been cut off has landed: its audit rows if it was committed, else the successful rows that
    its tasks left in ``done_dir``, one for each source (None: nothing)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).exists(p)

    if there(f"{staging_dir}/_SUCCESS"):
        return spark.read.schema(ledger_schema()).parquet(staging_dir)
    if not there(done_dir):
        return None
    rows = spark.read.schema(ledger_schema()).parquet(done_dir).filter(F.col("status") == STATUS_SUCCESS)
    return rows.dropDuplicates(["source_path", "source_modified_at"])


def preflight(spark: SparkSession, target: str, settings: dict | None = None) -> None:
    """Open the landing root, write and remove a probe there, on the driver and in one
    task; raises before any copy when either cannot."""

    def probe(uri: str) -> str | None:
        import uuid

        try:
            fs, path = FileSystems(settings).resolve(uri)
            if fs.type_name in ("local", "hdfs"):
                fs.create_dir(path, recursive=True)
            name = f"{path.rstrip('/')}/.probe-{uuid.uuid4().hex}.inflight"
            with fs.open_output_stream(name) as out:
                out.write(b"probe")
            fs.delete_file(name)
        except Exception as exc:
            return f"{type(exc).__name__}: {exc}"
        return None

    def run(batches):
        for pdf in batches:
            yield pdf.assign(error=[probe(u) for u in pdf["uri"]])

    error = probe(target)
    if error is None:
        one = spark.createDataFrame([(target,)], "uri string").coalesce(1)
        error = one.mapInPandas(run, "uri string, error string").first()["error"]
    if error is not None:
        raise RuntimeError(f"the landing root {target!r} cannot be written: {error}; nothing was copied")
