"""K3 for huge files: one file copied by several tasks, a part being a row.

Onto a local or mounted disk the bytes of a file can be written at their places by different tasks. Each part reads its
range of the source (from any store) and writes it into one hidden temporary file beside the target. Then a task that sees
all parts of a file checks that none is missing, that the length is the source's, and renames; otherwise it removes the
temporary and the old target stays. Parts may be written again by a retried task: they are the same bytes at the same place.

A Spark task takes one part where that gives no more tasks than their bytes are worth (``task_limit``); of smaller parts it takes
several, those of one file being dealt round over the tasks.

Object stores and HDFS have no such writes through ``pyarrow.fs``: there a huge file stays one task's stream.
"""

from __future__ import annotations

import math
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.schema import MANIFEST_COLUMNS, STATUS_ERROR, STATUS_SUCCESS, audit_schema
from quayside.sources.fsuri import FileSystems, has_scheme

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CHUNK_BYTES = 8 * 1024 * 1024
# MiB, and files or parts, that a Spark task is worth at least where there are many.
_LEAST_MB = 64.0
_LEAST_COPIES = 2000
_PART_SCHEMA = "source_path string, lakehouse_path string, written long, error string"


def local_target(path: Column, relative_to: str, root: tuple[str, str] | None) -> Column:
    """Whether a landing path is on a local (or mounted) disk."""

    def local(uri: str) -> bool:
        return uri.startswith("file:") or not has_scheme(uri)

    rest = F.when(path.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), path.startswith("file:")).when(path.startswith("/"), True).otherwise(local(relative_to))
    if root is not None:
        rest = F.when(path.startswith(root[0].rstrip("/") + "/"), local(root[1])).otherwise(rest)
    return F.coalesce(rest, F.lit(False))


def task_limit(spark: SparkSession, n_copies: int, mb: float) -> int:
    """Most Spark tasks for so many files or parts and MiB: their number grows with both, not with how finely they are cut."""
    return max(128, 8 * spark.sparkContext.defaultParallelism, math.ceil(mb / _LEAST_MB + n_copies / _LEAST_COPIES))


def copy_in_parts(
    spark: SparkSession,
    large: DataFrame,
    staging_dir: str,
    part_mb: float,
    relative_to: str = "/",
    counters: tuple | None = None,
    settings: dict | None = None,
    root: tuple[str, str] | None = None,
    verify: str = "size",
    retries: int = 0,
) -> DataFrame:
    """Copies the parts of every row of ``large``, by up to ``task_limit`` tasks, and stages what became of them; returns the plan of the
    completion, which gives the files' audit rows (each evaluation completes, so evaluate it once)."""
    token, part_bytes = uuid.uuid4().hex, max(1, int(part_mb * 1024 * 1024))

    def absolute(uri):
        if root and (uri + "/").startswith(root[0].rstrip("/") + "/"):
            uri = root[1].rstrip("/") + uri[len(root[0].rstrip("/")):]
        elif not has_scheme(uri) and not uri.startswith("/"):
            uri = relative_to.rstrip("/") + "/" + uri
        return uri

    def temporary(resolve, source, target):
        import os
        import zlib

        path = resolve(absolute(target))[1]
        folder, name = os.path.split(path)
        return path, os.path.join(folder, f".{name}.{token}-{zlib.crc32(source.encode()):08x}.inflight")

    def write_part(resolve, source, target, k, n):
        import hashlib
        import os

        sfs, spath = resolve(source)
        if sfs.get_file_info(spath).size is None:
            raise FileNotFoundError(source)
        _, tmp = temporary(resolve, source, target)
        os.makedirs(os.path.dirname(tmp), exist_ok=True)
        at, end, sent = k * part_bytes, None if k == n - 1 else (k + 1) * part_bytes, hashlib.blake2b(digest_size=16)
        out = os.open(tmp, os.O_RDWR | os.O_CREAT, 0o644)
        try:
            with sfs.open_input_file(spath) as src:
                src.seek(at)
                while end is None or at < end:
                    block = src.read(_CHUNK_BYTES if end is None else min(_CHUNK_BYTES, end - at))
                    if not block:
                        break
                    sent.update(block)
                    os.pwrite(out, block, at)
                    at += len(block)
            os.fsync(out)
            if verify == "content":
                back, here = hashlib.blake2b(digest_size=16), k * part_bytes
                while here < at:
                    block = os.pread(out, min(_CHUNK_BYTES, at - here), here)
                    if not block:
                        break
                    back.update(block)
                    here += len(block)
                if back.digest() != sent.digest():
                    raise OSError("other bytes arrived than were read")
        finally:
            os.close(out)
        return at - k * part_bytes

    def parts(batches):
        import time

        import pandas as pd

        resolve = FileSystems(settings).resolve
        for pdf in batches:
            out = []
            for row in pdf.itertuples():
                for again in range(retries, -1, -1):
                    try:
                        written, error = write_part(resolve, row.source_path, row.lakehouse_path, row.part, row.n_parts), None
                        break
                    except Exception as exc:
                        written, error = None, f"{type(exc).__name__}: {exc}"
                        if isinstance(exc, (FileNotFoundError, PermissionError)):
                            break
                        time.sleep(0.2 if again else 0)
                out.append((row.source_path, row.lakehouse_path, written, error))
            yield pd.DataFrame(out, columns=["source_path", "lakehouse_path", "written", "error"])

    def complete(batches):
        import os
        from datetime import datetime, timezone

        import pandas as pd

        resolve = FileSystems(settings).resolve

        def one(row):
            path, tmp = temporary(resolve, row.source_path, row.lakehouse_path)
            try:
                if row.error or row.arrived != row.n_parts:
                    raise OSError(row.error or f"{row.arrived} of {row.n_parts} parts arrived")
                sfs, spath = resolve(row.source_path)
                size = sfs.get_file_info(spath).size
                if os.path.exists(tmp):
                    if not size == row.written == os.path.getsize(tmp):
                        raise OSError(f"{os.path.getsize(tmp)} bytes arrived of {size}")
                    os.replace(tmp, path)
                elif not (os.path.exists(path) and os.path.getsize(path) == size):  # else: renamed by an earlier attempt
                    raise FileNotFoundError(tmp)
                return STATUS_SUCCESS, None
            except Exception as exc:
                if os.path.exists(tmp):
                    os.remove(tmp)
                return STATUS_ERROR, f"{type(exc).__name__}: {exc}"

        for pdf in batches:
            done = [one(row) for row in pdf.itertuples()]
            out = pdf[MANIFEST_COLUMNS].copy()
            out["copied_at"] = pd.to_datetime([datetime.now(timezone.utc)] * len(pdf), utc=True)
            out["status"], out["error"] = [d[0] for d in done], pd.Series([d[1] for d in done], index=out.index, dtype=object)
            if counters is not None:
                n_ok = sum(d[0] == STATUS_SUCCESS for d in done)
                counters[0].add(n_ok)
                counters[1].add(len(done) - n_ok)
            yield out

    earlier = Window.orderBy("source_path", "lakehouse_path").rowsBetween(Window.unboundedPreceding, -1)
    n_parts = F.ceil(F.col("source_size_mb") * 1024 * 1024 / part_bytes).cast("int")
    rows = large.select(*MANIFEST_COLUMNS, F.greatest(n_parts, F.lit(1)).alias("n_parts"))
    total, mb = rows.agg(F.sum("n_parts"), F.sum("source_size_mb")).first()
    total = total or 1
    n_tasks = min(total, task_limit(spark, total, mb or 0.0))
    # few parts are numbered (no more rows than tasks: one small task's work); of many, a file's first task is drawn by its name
    first = F.coalesce(F.sum("n_parts").over(earlier), F.lit(0)) if total <= n_tasks else F.pmod(F.xxhash64("source_path", "lakehouse_path"), F.lit(n_tasks))
    each = rows.withColumn("first", first)
    each = each.select("source_path", "lakehouse_path", "n_parts", "first", F.explode(F.expr("sequence(0, n_parts - 1)")).alias("part"))
    dealt = each.repartitionById(int(n_tasks), F.pmod(F.col("first") + F.col("part"), F.lit(n_tasks)).cast("int"))
    dealt.select("source_path", "lakehouse_path", "n_parts", "part").mapInPandas(parts, _PART_SCHEMA).write.mode("errorifexists").parquet(staging_dir)
    seen = spark.read.schema(_PART_SCHEMA).parquet(staging_dir).groupBy("source_path", "lakehouse_path").agg(
        F.count("written").alias("arrived"), F.sum("written").alias("written"), F.min("error").alias("error")
    )
    return rows.join(seen, ["source_path", "lakehouse_path"]).select(*MANIFEST_COLUMNS, "n_parts", "arrived", "written", "error").mapInPandas(
        complete, audit_schema(large.schema)
    )
