"""Distributed recursive listing: the file tree walked level by level as Spark jobs.

``binaryFile`` (``scan_files``) builds its file index on the driver: every
file's status is held there before the first task runs, which stops scaling
somewhere in the tens of millions of files. ``list_files`` keeps the driver
out of it. Each round is one Spark job: the round's directories are hash
partitioned over the tasks, and each task lists its directories with
``pyarrow.fs``, then keeps descending breadth-first into the subdirectories it
found while it has listed fewer than ``budget`` entries. Files are written to a
staging folder as they are found; subdirectories it did not get to are written
as the next round's input. A small tree is therefore listed by one task in one
round, a large one fans out over the cluster after the first round, and no task
lists more than its own directories plus ``budget`` entries or ``dir_budget``
further directories (a wide tree costs one request per directory on an object
store, so it must fan out rather than be walked by one task). The driver only
holds one count per round; the walk ends when a round leaves no directory. The
result is read back from staging: the listing is evaluated once, however often
it is used.

Names are matched by the regular expression that Hadoop itself makes of ``glob``
(braces, classes with ``^`` or ``!``, escapes), taken from it once on the driver; a
source path with wildcards is expanded there too, as ``binaryFile`` does.

Visibility follows Spark's own listing, so both listings return the same rows:
names starting with ``_`` (unless they contain ``=``) or ``.``, and names
ending in ``._COPYING_``, are skipped for files and directories alike, except
``_metadata`` / ``_common_metadata``; zero-byte files are skipped; times are
truncated to milliseconds (a store that gives none leaves it NULL, so the file is
never pending); ``glob`` filters file names. Output columns are those of
``scan_files``: ``path``, ``modificationTime``, ``length``. A directory that vanishes
between its discovery and its listing is counted in ``vanished``.

All roots and all matches of roots with wildcards are one frontier: the number of jobs
follows the depth of the deepest tree, not the number of matches.

A flat directory is not one task's work either. On a local (or mounted) disk its
names are streamed; beyond ``page_limit`` of them the task keeps a thinned sample of names, no
entries, and leaves ranges ``(after, until]`` of the name space for the next round, whose
tasks stat only what is in their range; each of them streams all names, so there are only as many ranges as cores. For stores that list keys in order from a given
key on, ``pages`` does the same: a task takes ``page_limit`` keys of a range and leaves the
rest as ranges for each further character at the places where keys differ. pyarrow itself
has no such call: without ``pages`` one directory of an object store or HDFS is
one list (some hundred bytes an entry) in the task that lists it. Rows leave a task in frames of
at most ``_BATCH_ROWS``, and at most ``_WAVE`` listings are held at a time.
"""

from __future__ import annotations

import math
import sys
from itertools import chain

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import new_run_dir, qualify
from quayside.sources.files import scan_files
from quayside.sources.fsuri import FileSystems, storage_settings

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LEVEL_SCHEMA = "kind string, path string, modificationTime timestamp, length long, after string, until string"
_BATCH_ROWS = 20_000
_BUDGET = 50_000
# Directories a task may list beyond the ones assigned to it, per round: on an
# object store each directory is at least one request, so a wide tree must fan
# out to the cluster rather than be walked by the task that found it.
_DIR_BUDGET = 256
# Directories whose listings a task holds at a time.
_WAVE = 16
# Entries of one directory that a task takes before it leaves ranges of names to others.
PAGE_LIMIT = 20_000
# Names of a flat directory that are kept at least to cut its ranges evenly, where it has that many.
_SAMPLE = 20_000


def name_ranges(first: str, last: str, until: str | None) -> list[tuple[str, str | None]]:
    """Ranges ``(after, until]`` that hold together every name above ``last``, up to ``until``: one for each further
    character (of ASCII, then the rest) at each place from the first one where ``first`` and ``last`` differ."""
    same = next((i for i, (a, b) in enumerate(zip(first, last)) if a != b), min(len(first), len(last)))
    cuts = [last]
    for i in range(len(last) - 1, same - 1, -1):
        cuts += [last[:i] + chr(c) for c in range(ord(last[i]) + 1, 128)]
    cuts = [c for c in cuts if until is None or c < until]
    return list(zip(cuts, [*cuts[1:], until]))


def local_entries(path: str, after: str | None, until: str | None, limit: int, fanout: int):
    """Streams ``(name, is_dir, length, ms)`` of a local directory's names in ``(after, until]``; of a whole directory of
    more than ``limit`` names instead ``(None, after, until, None)`` for each of at most ``fanout`` ranges of names."""
    import os
    from itertools import islice

    def entry(e):
        try:
            st = e.stat()
        except OSError:  # gone meanwhile, or a link to nothing
            return None
        return e.name, e.is_dir(), st.st_size if e.is_file() else None, st.st_mtime_ns // 1_000_000

    with os.scandir(path) as found:
        if after is None and until is None:
            head = list(islice(found, limit + 1))
            if len(head) <= limit:
                yield from filter(None, map(entry, head))
                return
            names, n, step = sorted(e.name for e in head), len(head), 1
            for e in found:
                n += 1
                if n % step == 0:
                    names.append(e.name)
                    if len(names) > max(4 * limit, _SAMPLE):
                        names, step = names[::2], 2 * step
            names.sort()
            parts = max(2, min(-(-2 * n // limit), fanout))
            cuts = sorted({names[len(names) * k // parts] for k in range(1, parts)})
            for a, b in zip([None, *cuts], [*cuts, None]):
                yield None, a, b, None
            return
        for e in found:
            if (after is None or e.name > after) and (until is None or e.name <= until):
                row = entry(e)
                if row:
                    yield row


def _lister(
    name_pattern: str | None,
    budget: int,
    dir_counter=None,
    dir_budget: int = _DIR_BUDGET,
    threads: int | None = None,
    settings: dict | None = None,
    vanished=None,
    page_limit: int = 1 << 40,
    fanout: int = 64,
    pages=None,
):
    def run(batches):
        import re
        from collections import deque
        from concurrent.futures import ThreadPoolExecutor
        from itertools import islice

        import numpy as np
        import pandas as pd
        import pyarrow.fs as pafs

        def hidden(name: str) -> bool:
            excluded = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
            kept = name.startswith("_common_metadata") or name.startswith("_metadata")
            return excluded and not kept

        resolve = FileSystems(settings).resolve
        wanted = re.compile(name_pattern, re.S).fullmatch if name_pattern else None

        def frame(rows):
            pdf = pd.DataFrame(rows, columns=["kind", "path", "ms", "length", "after", "until"])
            pdf["modificationTime"] = pd.Series(np.array([r[2] for r in rows], "datetime64[ms]")).dt.tz_localize("UTC")
            return pdf[["kind", "path", "modificationTime", "length", "after", "until"]]

        def ordered_pages(parent, after, until):
            found = pages(parent, after, until)
            taken = list(islice(found, page_limit))
            more = len(taken) == page_limit and next(iter(found), None) is not None
            return taken + [(None, a, b, None) for a, b in (name_ranges(taken[0][0], taken[-1][0], until) if more else [])]

        def list_one(item):
            parent, after, until = item
            try:
                if pages is not None:
                    return ordered_pages(parent, after, until)
                fs, path = resolve(parent)
                if fs.type_name == "local":
                    found = local_entries(path, after, until, page_limit, fanout)
                    first = next(found, None)  # opens the directory
                    return chain([first] if first else [], found)
                kinds = {pafs.FileType.Directory: True, pafs.FileType.File: False}
                infos = fs.get_file_info(pafs.FileSelector(path, recursive=False))
                return (
                    (i.base_name, kinds[i.type], i.size, i.mtime_ns // 1_000_000 if i.mtime_ns is not None else None)
                    for i in infos if i.type in kinds
                )
            except FileNotFoundError:
                return None

        def pool_size(first_dir) -> int:
            if threads is not None:
                return max(1, threads)
            try:
                return 1 if pages is None and resolve(first_dir)[0].type_name == "local" else 16
            except Exception:
                return 1

        rows: list = []
        listed = 0  # entries listed by this task, across its batches
        extra_dirs = 0  # directories listed beyond the assigned ones
        pool = None
        try:
            for pdf in batches:
                ranges = [pdf[c].where(pdf[c].notna(), None) if c in pdf else [None] * len(pdf) for c in ("after", "until")]
                queue = deque((item, True) for item in zip(pdf["dir"], *ranges))
                while queue:
                    # one wave: some queued directories still within the budgets,
                    # listed together (concurrently against a remote store)
                    to_list = []
                    while queue and len(to_list) < _WAVE:
                        item, must = queue.popleft()
                        if not must and (listed >= budget or extra_dirs >= dir_budget):
                            rows.append(("dir", item[0], None, None, None, None))  # left for the next round
                            if len(rows) >= _BATCH_ROWS:
                                yield frame(rows)
                                rows = []
                            continue
                        extra_dirs += not must
                        to_list.append(item)
                    if not to_list:
                        continue
                    if pool is None:
                        size = pool_size(to_list[0][0])
                        pool = ThreadPoolExecutor(max_workers=size) if size > 1 else False
                    listings = pool.map(list_one, to_list) if pool else map(list_one, to_list)
                    for (parent, _, _), entries in zip(to_list, listings):
                        if dir_counter is not None:
                            dir_counter.add(1)
                        if entries is None:
                            if vanished is not None:
                                vanished.add(1)
                            continue
                        base = parent.rstrip("/")
                        for name, is_dir, length, ms in entries:
                            if name is None:  # a range of names, left for the next round
                                rows.append(("dir", parent, None, None, is_dir, length))
                            elif hidden(name):
                                continue
                            else:
                                listed += 1
                                if is_dir:
                                    queue.append(((f"{base}/{name}", None, None), False))
                                elif length and (wanted is None or wanted(name)):
                                    rows.append(("file", f"{base}/{name}", ms, length, None, None))
                            if len(rows) >= _BATCH_ROWS:
                                yield frame(rows)
                                rows = []
            if rows:
                yield frame(rows)
        finally:
            if pool:
                pool.shutdown()

    return run


def glob_pattern(spark: SparkSession, glob: str) -> str:
    """The regular expression that Hadoop matches ``glob`` by, usable in Python."""
    import re

    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    try:
        re.compile(pattern, re.S)
    except re.error as exc:
        raise ValueError(f"cannot match names by {glob!r}: {exc}") from exc
    return pattern


def _expand(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """Paths, each with 'dir' or 'file', that a root with wildcards stands for (driver side, one call)."""
    if not any(c in root for c in "*?[{"):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [(str(s.getPath().toString()), "dir" if s.isDirectory() else "file") for s in found or []]


def _root_status(spark: SparkSession, root: str, settings: dict) -> str | None:
    """'dir', 'file' or None (absent), asked once on the driver: through Hadoop's
    file system when it has one for the scheme, else through pyarrow (the same
    access the executors will use)."""
    from py4j.protocol import Py4JJavaError

    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    try:
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    except Py4JJavaError:
        import pyarrow.fs as pafs

        afs, apath = FileSystems(settings).resolve(root)
        kind = afs.get_file_info(apath).type
        if kind == pafs.FileType.NotFound:
            return None
        return "dir" if kind == pafs.FileType.Directory else "file"
    if not fs.exists(p):
        return None
    return "dir" if fs.getFileStatus(p).isDirectory() else "file"


def list_files(
    spark: SparkSession,
    root: str | list[str],
    staging_dir: str | None = None,
    glob: str | None = None,
    max_tasks: int | None = None,
    budget: int = _BUDGET,
    dir_counter=None,
    dir_budget: int = _DIR_BUDGET,
    threads: int | None = None,
    vanished=None,
    page_limit: int = PAGE_LIMIT,
    pages=None,
) -> DataFrame:
    """List every visible file under ``root`` (one or several) on the executors; see the module doc.

    ``dir_counter``: an optional Spark accumulator that counts directory listings
    (one per directory, or range of its names, per evaluation; a retried task counts again).
    ``threads``: directories listed at once per task; None picks 1 on a local
    disk and 16 against a remote store, where each listing waits on a request.
    ``vanished``: an optional accumulator of directories gone before their listing.
    ``pages``: an optional picklable ``(directory URI, after, until) -> iterator`` of ``(name, is_dir, length, mtime in
    ms)`` in ascending order of names, of those in ``(after, until]`` (None: unbounded), which replaces the
    pyarrow listing; it raises FileNotFoundError where there is no directory. Over S3 that is a paginator of
    ListObjectsV2 with Prefix, Delimiter and StartAfter."""
    staging_dir = staging_dir or new_run_dir(spark, "listing")
    settings = storage_settings(spark)
    dirs, files = [], []
    for one in [root] if isinstance(root, str) else root:
        one = qualify(spark, one)
        status = "dir" if pages is not None else _root_status(spark, one, settings)
        matches = [(one, status)] if status else _expand(spark, one)
        if not matches:
            raise FileNotFoundError(f"listing root does not exist: {one}")
        dirs += [path for path, kind in matches if kind == "dir"]
        files += [path for path, kind in matches if kind == "file"]
    listed = scan_files(spark, files, glob=glob, max_tasks=1) if files else None  # like binaryFile: a file root lists that file
    if not dirs:
        return listed
    cores_cap = max_tasks or 4 * spark.sparkContext.defaultParallelism
    frontier = spark.createDataFrame([(d, None, None) for d in dirs], "dir string, after string, until string")
    name_pattern = glob_pattern(spark, glob) if glob else None
    run = _lister(name_pattern, budget, dir_counter, dir_budget, threads, settings, vanished, page_limit, max_tasks or spark.sparkContext.defaultParallelism, pages)
    n_dirs, level = len(dirs), 0
    while n_dirs:
        out = f"{staging_dir}/level-{level:05d}"
        # four tasks per core, but never more than 256 assigned directories per task
        # (the core count can be small at planning time under dynamic allocation)
        n_tasks = max(1, min(n_dirs, max(cores_cap, math.ceil(n_dirs / 256))))
        frontier.repartition(n_tasks, "dir", "after").mapInPandas(run, _LEVEL_SCHEMA).write.mode("errorifexists").parquet(out)
        staged = spark.read.schema(_LEVEL_SCHEMA).parquet(out)  # known schema: no inference job
        frontier = staged.filter(F.col("kind") == "dir").select(F.col("path").alias("dir"), "after", "until")
        n_dirs = frontier.count()
        level += 1
    found = (
        spark.read.schema(_LEVEL_SCHEMA)
        .parquet(*[f"{staging_dir}/level-{i:05d}" for i in range(level)])
        .filter(F.col("kind") == "file")
        .select("path", "modificationTime", "length")
    )
    return found if listed is None else found.unionByName(listed)
