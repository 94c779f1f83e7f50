"""One landing run, inventory -> manifest -> detection -> copy -> ledger append.

Evaluation count: the source listing and the ledger are each evaluated once,
when the pending set is staged (written under the run folder). Every later
step — guards, counts, copy, preview, append — reads that snapshot, so a file
that changes or disappears during the run cannot make the steps disagree, and
appending to the ledger cannot change an already computed pending set.

Before the first copy a run refuses: overlapping sources; a landing root, ledger,
staging or checkpoint folder inside a source; landing paths that another source of
the listing claims or that the ledger has from another source; and a landing root
that the driver or a task cannot write (``preflight``).

Staging (listing, pending and audit rows) stays for the result's DataFrames unless
``keep_staging=False``, which removes it at the end of a successful run.

Failure model: copies are idempotent and the audit append happens after all
copies. Before the first copy a run leaves an intent beside the ledger, which says where its audit rows will be
and where its tasks leave the rows of each batch as it lands. A run that dies before its append
is completed by the next one (``resume``): the rows of what it landed are appended first, so those files are not
pending again; what it did not land is. Only files whose task was cut off are copied twice. One run at a time
may work on a ledger. In a ledger in runs the append itself is atomic and not repeated (``sources/ledger.py``), and
detection reads the newest snapshot and the runs since, not the whole ledger.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.copy import RETRIES, copy_files, landed_rows, preflight, size_aggregates
from quayside.operators.detect import newest, pending_files, pending_since
from quayside.operators.guards import claimed_targets, preview
from quayside.operators.inventory import extract_inventory
from quayside.operators.manifest import PathRules, build_manifest
from quayside.schema import BYTES_PER_MIB, STATUS_ERROR, STATUS_SUCCESS
from quayside.session import checkpoint_root, new_run_dir, qualify
from quayside.sources.fsuri import storage_settings
from quayside.sources.ledger import (
    Ledger,
    append_ledger,
    compact_ledger,
    empty_ledger,
    ensure_ledger,
    marker_names,
    read_ledger,
    versions,
    write_marker,
)

log = logging.getLogger("quayside")


@dataclass(frozen=True)
class LandingConfig:
    source: str | list[str]
    ledger: Ledger
    rules: PathRules
    factor: int = BYTES_PER_MIB
    glob: str | None = None
    listing: str = "distributed"  # tree walked on the executors; 'binaryFile': Spark's driver-side file index
    pages: Callable | None = None  # lists a range of a directory's names in order (see list_files), for flat folders of object stores
    retry_failed: bool = False
    on_unmapped: str = "fail"  # 'fail' raises before copying; 'reject' sets them apart
    on_collision: str = "fail"  # 'fail' raises when two sources share a landing path, also across runs; 'allow'
    max_files: int | None = None  # None: no cap (the copy is distributed)
    copy_threads: int | None = None  # None: 1 per task on a local disk, 16 on HDFS / object stores
    num_tasks: int | None = None
    copier: Callable[[str, str], None] | None = None  # replaces the pyarrow copy (must overwrite, raise on failure)
    staging_dir: str | None = None  # default: a new folder under spark.checkpoint.dir
    keep_staging: bool = True  # False: remove the run folder after a successful run (its DataFrames go with it)
    verify: str = "size"  # 'content' also compares a digest of each copy with one of its source
    retries: int = RETRIES  # further tries of a failed copy within the run
    part_mb: float | None = None  # parts of huge files onto local disks; None: a quarter of a task's MiB, 0: whole files
    resume: bool = True  # complete a run that died before its append
    compact_after: int = 20  # runs until a ledger in runs gets a new snapshot; 0: never
    preview_rows: int = 0  # > 0: log the first rows (by source_path) of the pending and audit sets


@dataclass
class LandingResult:
    inventory: DataFrame
    manifest: DataFrame
    ledger: DataFrame
    pending: DataFrame
    audit: DataFrame
    rejected: DataFrame | None
    count: int
    run_dir: str
    stats: dict = field(default_factory=dict)


def run_landing(spark: SparkSession, cfg: LandingConfig) -> LandingResult:
    if cfg.on_unmapped not in ("fail", "reject"):
        raise ValueError("on_unmapped must be 'fail' or 'reject'")
    if cfg.on_collision not in ("fail", "allow"):
        raise ValueError("on_collision must be 'fail' or 'allow'")
    _check_layout(spark, cfg)
    run_dir = cfg.staging_dir or new_run_dir(spark, "landing")
    clock = [time.perf_counter()]
    timings: dict[str, float] = {}

    def lap(step: str) -> None:
        now = time.perf_counter()
        timings[step] = round(now - clock[0], 4)
        clock[0] = now

    log.info("landing run %s: source=%s ledger=%s", run_dir, cfg.source, cfg.ledger)
    ensure_ledger(spark, cfg.ledger)
    _check_table_place(spark, cfg)
    resumed = _resume(spark, cfg) if cfg.resume else 0
    ledger = read_ledger(spark, cfg.ledger)
    lap("ledger")
    dirs_listed, vanished = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    inventory = extract_inventory(
        spark, cfg.source, cfg.factor, glob=cfg.glob, listing=cfg.listing, staging_dir=run_dir, dir_counter=dirs_listed,
        vanished=vanished, pages=cfg.pages,
    )
    if cfg.listing != "distributed":  # the distributed listing is staged by itself
        inventory.write.mode("errorifexists").parquet(f"{run_dir}/listing")
        inventory = spark.read.schema(inventory.schema).parquet(f"{run_dir}/listing")
    manifest = build_manifest(inventory, cfg.rules)

    # The one evaluation of listing + detection.
    if cfg.ledger.layout == "runs":
        seen = versions(spark, cfg.ledger)
        landed = seen.filter(F.col("latest_success").isNotNull()).select("source_path", "lakehouse_path", F.lit(STATUS_SUCCESS).alias("status"))
        pending_plan = pending_since(manifest, newest(seen, cfg.retry_failed))
    else:
        landed, pending_plan = ledger, pending_files(manifest, ledger, cfg.retry_failed)
    pending_plan.write.mode("errorifexists").parquet(f"{run_dir}/pending")
    pending = spark.read.schema(pending_plan.schema).parquet(f"{run_dir}/pending")
    lap("detect_and_stage")

    # One aggregate (a single action) answers the pre-copy questions: size of the batch
    # and rows without a landing or bucket path (the ledger forbids NULL there).
    unmapped_row = F.col("lakehouse_path").isNull() | F.col("bucket_path").isNull()
    row = pending.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(unmapped_row).alias("unmapped"),
        *size_aggregates(~unmapped_row),
    ).first()
    n, n_unmapped, total_mb = row["n"], row["unmapped"], float(row["mb"])
    stats = {"pending": n, "unmapped": n_unmapped, "pending_mb": total_mb}
    stats["timings"], stats["resumed"] = timings, resumed
    lap("checks")
    log.info("%d new or updated files (%.2f MiB), %d without a landing path", n, total_mb, n_unmapped)
    _log_preview("pending", pending, cfg.preview_rows)

    if cfg.max_files is not None and n > cfg.max_files:
        raise ValueError(f"{n} files are pending, more than max_files={cfg.max_files}; nothing was copied")

    rejected = None
    to_copy = pending
    if n_unmapped:
        if cfg.on_unmapped == "fail":
            raise ValueError(
                f"{n_unmapped} pending files have no landing path or bucket path (markers "
                f"{cfg.rules.landing_marker!r} / {cfg.rules.bucket_marker!r} missing); nothing was copied"
            )
        rejected = pending.filter(unmapped_row)
        to_copy = pending.filter(~unmapped_row)
        n -= n_unmapped

    if n and cfg.on_collision == "fail":
        claims = claimed_targets(to_copy, manifest, landed, n)
        claimed = claims.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("lakehouse_path", "first_source", "last_source")).alias("one")).first()
        stats["collisions"], first = claimed["n"], claimed["one"]
        if stats["collisions"]:
            raise ValueError(
                f"{stats['collisions']} landing paths are claimed by more than one source, in this listing or in the "
                f"ledger (e.g. {first['lakehouse_path']!r} by {first['first_source']!r} and {first['last_source']!r}); "
                "nothing was copied"
            )

    def finish() -> None:
        # read at the end: any re-evaluation of the listing would show here
        if cfg.listing == "distributed":
            stats["dirs_listed"] = dirs_listed.value
            stats["dirs_vanished"] = vanished.value
        if not cfg.keep_staging:
            _remove(spark, run_dir)

    if n == 0:
        log.info("nothing to copy; the ledger is left as it is")
        finish()
        audit = empty_ledger(spark, ledger.schema)
        return LandingResult(inventory, manifest, ledger, pending, audit, rejected, 0, run_dir, stats)

    root = (cfg.rules.root, _qualified_root(spark, cfg.rules.root))
    if cfg.copier is None:
        preflight(spark, root[1], storage_settings(spark))
    counters = (spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0))
    run_id = uuid.uuid4().hex
    intent, done_dir = record_intent(spark, cfg.ledger, run_id, run_dir)
    audit = copy_files(
        spark,
        to_copy,
        f"{run_dir}/audit",
        num_tasks=cfg.num_tasks,
        threads=cfg.copy_threads,
        copier=cfg.copier,
        counters=counters,
        root=root,
        sizes=row,
        verify=cfg.verify,
        retries=cfg.retries,
        part_mb=cfg.part_mb,
        done_dir=done_dir,
    )
    lap("copy")
    # NOT NULL columns were checked on the pending rows; the copy sets the rest.
    append_ledger(spark, audit, cfg.ledger, row_count=n, check_nulls=False, run_id=run_id)
    _remove(spark, intent)
    if cfg.ledger.layout == "runs" and cfg.compact_after:
        compact_ledger(spark, cfg.ledger, cfg.compact_after)
    stats["copied"] = n
    lap("append")
    status = {k: v for k, v in ((STATUS_SUCCESS, counters[0].value), (STATUS_ERROR, counters[1].value)) if v}
    stats["status"] = status
    log.info("copied %d files: %s; ledger appended", n, status)
    _log_preview("audit", audit, cfg.preview_rows)
    finish()
    return LandingResult(inventory, manifest, ledger, pending, audit, rejected, n, run_dir, stats)


def _intents(spark: SparkSession, ledger: Ledger) -> str:
    """The folder of the intents of runs that have not appended yet."""
    return f"{ledger.path}/_intents" if ledger.path else f"{checkpoint_root(spark)}/quayside/intents/{ledger.name}"


def record_intent(spark: SparkSession, ledger: Ledger, run_id: str, run_dir: str) -> tuple[str, str]:
    """Note that a run is about to copy with its audit rows at ``run_dir/audit``: the intent, and the folder for its tasks' rows."""
    intent, done_dir = f"{_intents(spark, ledger)}/{run_id}", f"{run_dir}/landed-rows"
    write_marker(spark, intent, json.dumps({"audit": f"{run_dir}/audit", "done": done_dir}))
    return intent, done_dir


def _resume(spark: SparkSession, cfg: LandingConfig) -> int:
    """Append what earlier runs landed without reaching their append: the number of rows."""
    folder, total = _intents(spark, cfg.ledger), 0
    for run_id in marker_names(spark, folder):
        (text,) = spark.read.text(f"{folder}/{run_id}").collect()
        places = json.loads(text["value"])
        rows = landed_rows(spark, places["audit"], places["done"])
        n = 0 if rows is None else append_ledger(spark, rows, cfg.ledger, check_nulls=False, run_id=run_id)
        _remove(spark, f"{folder}/{run_id}")
        log.info("completed run %s: %d files it had landed are recorded", run_id, n)
        total += n
    return total


def _log_preview(label: str, df: DataFrame, rows: int) -> None:
    if rows > 0 and log.isEnabledFor(logging.INFO):
        for r in preview(df, rows).collect():
            log.info("%s: %s", label, r.asDict())


def _check_layout(spark: SparkSession, cfg: LandingConfig) -> None:
    """Refuse overlapping source folders, and a landing root, path ledger or
    staging inside a source folder (the run's own output would be listed as new sources by the
    next run). Paths are compared qualified, on the driver, before any job."""
    sources = [cfg.source] if isinstance(cfg.source, str) else list(cfg.source)
    roots = [qualify(spark, s).rstrip("/") + "/" for s in sources]
    # nested or repeated roots would list the same files twice
    for i, a in enumerate(roots):
        for b in roots[i + 1:]:
            if a.startswith(b) or b.startswith(a):
                raise ValueError(f"source folders overlap: {a!r} and {b!r}")
    targets = {"landing root": _qualified_root(spark, cfg.rules.root)}
    if cfg.ledger.path is not None:
        targets["ledger"] = cfg.ledger.path
    targets["staging folder"] = cfg.staging_dir or checkpoint_root(spark)
    _refuse_inside(spark, roots, targets)


def _check_table_place(spark: SparkSession, cfg: LandingConfig) -> None:
    """The same for the folder of a catalog ledger, once it exists."""
    if cfg.ledger.name is None:
        return
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {cfg.ledger.name}").filter("col_name = 'Location'").collect()
    sources = [cfg.source] if isinstance(cfg.source, str) else list(cfg.source)
    roots = [qualify(spark, s).rstrip("/") + "/" for s in sources]
    _refuse_inside(spark, roots, {"ledger": r["data_type"] for r in rows})


def _qualified_root(spark: SparkSession, root: str) -> str:
    """The landing root as a URI that executors can open; raises for one that names no file system."""
    from py4j.protocol import Py4JJavaError

    try:
        return qualify(spark, root)
    except Py4JJavaError as exc:
        raise ValueError(f"the landing root {root!r} does not resolve: {exc.java_exception}; nothing was copied") from None


def _remove(spark: SparkSession, folder: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _refuse_inside(spark: SparkSession, roots: list[str], targets: dict[str, str]) -> None:
    for label, target in targets.items():
        where = qualify(spark, target).rstrip("/") + "/"
        for root in roots:
            if where.startswith(root):
                raise ValueError(f"the {label} {target!r} lies inside the source {root!r}")
