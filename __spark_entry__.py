"""

Every query reads the supplied tables (or files written from them) in
full; the stand-in mappings are in ``quayside/sources/standins.py`` and the
oracle SQL below spells out the same mappings for DuckDB.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quayside.functions.paths import landing_path, path_after, size_mb  # noqa: E402
from quayside.operators.copy import audit_records, copy_files, deal_by_bytes, size_aggregates  # noqa: E402
from quayside.operators.detect import latest_versions, newest, pending_files, pending_since  # noqa: E402
from quayside.operators.guards import check_batch_size, claimed_targets, pending_summary, preview, target_collisions  # noqa: E402
from quayside.operators.inventory import extract_inventory  # noqa: E402
from quayside.operators.manifest import PathRules, build_manifest, unmapped  # noqa: E402
from quayside.plans.landing import LandingConfig, record_intent, run_landing  # noqa: E402
from quayside.schema import REFERENCE_MAX_FILES  # noqa: E402
from quayside.session import new_run_dir  # noqa: E402
from quayside.sources import standins as st  # noqa: E402
from quayside.sources.ledger import (  # noqa: E402
    Ledger,
    append_ledger,
    compact_ledger,
    empty_ledger,
    ensure_ledger,
    read_ledger,
    versions,
)

SMOKE_DIR = "/root/testdata/sf0.001"
MAX_FILES = REFERENCE_MAX_FILES


# ---------------------------------------------------------------- projections
def _tree(spark: SparkSession, sf_dir: str, label: str, flat: bool = False) -> str:
    """A folder ``tree`` of real files, one for each row of ``documents``, in a new run folder: its run folder."""
    run = new_run_dir(spark, label)
    st.documents_tree(spark, sf_dir, f"{run}/tree", flat)
    return run


def _below(col: str, marker: str = "/raw/"):
    """The part of a path of the tree that does not depend on the run."""
    return F.substring_index(F.col(col), marker, -1)


def q_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _tree(spark, sf_dir, "listing")
    inv = extract_inventory(spark, f"{run}/tree", listing="binaryFile")
    return inv.select(
        _below("source_path").alias("source_path"), "source_size_mb", F.col("source_modified_at").isNotNull().alias("has_time")
    )


def q_file_inventory_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _tree(spark, sf_dir, "listing")
    inv = extract_inventory(spark, f"{run}/tree", listing="distributed")
    return inv.select(
        _below("source_path").alias("source_path"), "source_size_mb", F.col("source_modified_at").isNotNull().alias("has_time")
    )


def q_inventory_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by braces, classes, negated classes and ``?``, over the tree's files, from a source path with wildcards."""
    run = _tree(spark, sf_dir, "glob")
    inv = extract_inventory(spark, f"{run}/tree/raw/src{{0,1?}}", glob="{*[0-3],[^1-8]?}.txt", listing="distributed")
    return inv.select(_below("source_path").alias("source_path"), "source_size_mb")


def q_inventory_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files in one folder, which is listed by ranges of names."""
    run = _tree(spark, sf_dir, "flat", flat=True)
    inv = extract_inventory(spark, f"{run}/tree", listing="distributed", page_limit=100)
    return inv.select(_below("source_path").alias("source_path"), "source_size_mb")


def q_inventory_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several roots, with and without wildcards, as one frontier."""
    run = _tree(spark, sf_dir, "roots")
    roots = [f"{run}/tree/raw/src1", f"{run}/tree/raw/src[2-9]/e*", f"{run}/tree/raw/src1[0-4]"]
    inv = extract_inventory(spark, roots, listing="distributed")
    return inv.select(_below("source_path").alias("source_path"), "source_size_mb")


def q_size_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = st.table(spark, sf_dir, "documents")
    return d.select("doc_id", size_mb("n_chars", 1024).alias("source_size_mb"))


def q_bucket_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = st.documents_paths(spark, sf_dir)
    return d.select("doc_id", "source_path", path_after("source_path", "/Files/").alias("bucket_path"))


def q_bucket_path_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = st.table(spark, sf_dir, "pages")
    return p.select("page_id", path_after("url", "/en/").alias("bucket_path"))


def q_bucket_path_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = st.table(spark, sf_dir, "pages")
    return p.select("page_id", path_after("url", "/EN/", ignore_case=True).alias("bucket_path"))


def q_landing_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = st.documents_paths(spark, sf_dir)
    return d.select("doc_id", landing_path("source_path", "/raw/", st.LANDING_ROOT).alias("lakehouse_path"))


def q_landing_path_strip_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = st.table(spark, sf_dir, "pages")
    return p.select("page_id", landing_path("url", "/en/", st.PAGES_ROOT, strip_ext="html").alias("lakehouse_path"))


def q_landing_path_strip_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = st.table(spark, sf_dir, "pages")
    return p.select("page_id", landing_path("url", "/en/", st.PAGES_ROOT, strip_ext="*").alias("lakehouse_path"))


def q_landing_path_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marker that most paths hold more than once: the piece up to its second occurrence, and the whole tail."""
    p = st.table(spark, sf_dir, "pages")
    return p.select(
        "page_id",
        landing_path("url", "th", st.PAGES_ROOT).alias("piece"),
        landing_path("url", "th", st.PAGES_ROOT, keep_tail=True).alias("tail"),
    )


def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_manifest(st.documents_inventory(spark, sf_dir), st.STANDIN_RULES)


def q_unmapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    man = build_manifest(st.pages_inventory(spark, sf_dir), st.PAGES_RULES)
    return unmapped(man).select("source_path", "bucket_path", "lakehouse_path")


def q_landing_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_collisions(build_manifest(st.pages_inventory(spark, sf_dir), st.PAGES_RULES))


# ---------------------------------------------------------------- detection
def q_latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_versions(st.lineitem_ledger(spark, sf_dir))


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_files(st.orders_manifest(spark, sf_dir), st.lineitem_ledger(spark, sf_dir))


def q_pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pending(spark, sf_dir)


def q_pending_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_files(st.orders_manifest(spark, sf_dir), empty_ledger(spark))


def _runs_ledger(spark: SparkSession, sf_dir: str, label: str) -> Ledger:
    """The ledger of lineitem in five runs; the first three are in a snapshot."""
    ledger = Ledger(path=f"{new_run_dir(spark, label)}/ledger", layout="runs")
    ensure_ledger(spark, ledger)
    run = F.pmod(F.xxhash64("source_path", "source_modified_at"), F.lit(5))
    rows = st.lineitem_ledger(spark, sf_dir)
    sizes = {r["run"]: r["count"] for r in rows.groupBy(run.alias("run")).count().collect()}  # they size the appends' files
    for k in range(5):
        append_ledger(spark, rows.filter(run == k), ledger, row_count=sizes.get(k, 0), check_nulls=False, run_id=f"run-{k}")
        if k == 2:
            compact_ledger(spark, ledger)
    return ledger


def q_latest_versions_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest versions from the snapshot and the runs since."""
    return newest(versions(spark, _runs_ledger(spark, sf_dir, "incremental")))


def q_pending_files_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _runs_ledger(spark, sf_dir, "incremental-pending")
    return pending_since(st.orders_manifest(spark, sf_dir), newest(versions(spark, ledger)))


def q_append_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append that was cut off before its marker is invisible; repeated, it appends once."""
    ledger = _runs_ledger(spark, sf_dir, "atomic")
    before = read_ledger(spark, ledger).count()
    _pending(spark, sf_dir).write.parquet(f"{ledger.path}-pending")  # detection is evaluated once, as in a run
    more = audit_records(spark.read.parquet(f"{ledger.path}-pending"))
    more.write.parquet(f"{ledger.path}/runs/cut-off")
    invisible = read_ledger(spark, ledger).count()
    for _ in range(2):
        append_ledger(spark, more, ledger, run_id="cut-off")
    counts = {"n_before": before, "n_cut_off": invisible, "n_after": read_ledger(spark, ledger).count()}
    return spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()])


def q_latest_success_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_versions(st.events_ledger(spark, sf_dir), retry_failed=True)


def q_latest_all_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_versions(st.events_ledger(spark, sf_dir))


def _events_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current version of each user's file = the newest event of that user."""
    led = st.events_ledger(spark, sf_dir)
    inv = led.groupBy("source_path").agg(
        F.max("source_modified_at").alias("source_modified_at"),
        F.lit(0.0).alias("source_size_mb"),
    )
    return build_manifest(inv, st.STANDIN_RULES)


def q_pending_retry_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_files(_events_manifest(spark, sf_dir), st.events_ledger(spark, sf_dir), retry_failed=True)


def q_pending_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_summary(_pending(spark, sf_dir), max_files=MAX_FILES)


def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(_pending(spark, sf_dir), 20)


def q_audit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_records(_pending(spark, sf_dir), copied_at=st.ntz(st.AUDIT_TIME))


def q_pending_after_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a ledger table, load the history, detect, append the audit rows of
    the pending set, detect again: the second detection finds nothing."""
    run = new_run_dir(spark, "after-append")
    ledger = Ledger(path=f"{run}/ledger")
    ensure_ledger(spark, ledger)
    append_ledger(spark, st.lineitem_ledger(spark, sf_dir), ledger)
    manifest = st.orders_manifest(spark, sf_dir)
    pending_plan = pending_files(manifest, read_ledger(spark, ledger))
    pending_plan.write.parquet(f"{run}/pending")
    pending = spark.read.parquet(f"{run}/pending")
    n_before = pending.count()
    rows_before = read_ledger(spark, ledger).count()
    append_ledger(spark, audit_records(pending), ledger, row_count=n_before)
    n_appended = read_ledger(spark, ledger).count() - rows_before
    n_after = pending_files(manifest, read_ledger(spark, ledger)).count()
    return spark.range(1).select(
        F.lit(n_before).cast("bigint").alias("n_pending_before"),
        F.lit(n_appended).cast("bigint").alias("n_appended"),
        F.lit(n_after).cast("bigint").alias("n_pending_after"),
    )


def q_preview_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unordered preview: how many rows it has, and how many of them are pending rows."""
    pending = _pending(spark, sf_dir)
    some = preview(pending, 20, order_by=None)
    known = some.join(pending.select("source_path"), "source_path", "left_semi")
    counts = known.select(F.lit(True).alias("known")).union(some.select(F.lit(False)))
    return counts.agg(F.count_if(~F.col("known")).alias("n_rows"), F.count_if("known").alias("n_pending"))


def _raises(action) -> bool:
    try:
        action()
    except ValueError:
        return True
    return False


def q_cap_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch cap: as many files as the cap pass, one more raises."""
    pending = _pending(spark, sf_dir)
    n = pending.count()
    at_cap, over = _raises(lambda: check_batch_size(pending, n)), _raises(lambda: check_batch_size(pending, n - 1))
    return spark.range(1).select(
        F.lit(n).cast("bigint").alias("n_files"), F.lit(at_cap).alias("raises_at_cap"), F.lit(over).alias("raises_over_cap")
    )


def q_collisions_vs_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ``.txt`` files, whose landing paths (any extension dropped) the ledger has from ``.csv`` files."""
    rules = replace(st.STANDIN_RULES, strip_ext="*")
    inv = st.orders_inventory(spark, sf_dir).withColumn("source_path", F.regexp_replace("source_path", "\\.csv$", ".txt"))
    manifest = build_manifest(inv, rules)
    landed = landing_path("source_path", rules.landing_marker, rules.root, strip_ext="*")
    ledger = st.lineitem_ledger(spark, sf_dir).withColumn("lakehouse_path", landed)
    return claimed_targets(pending_files(manifest, ledger), manifest, ledger)


# ---------------------------------------------------------------- copy + run
def _tree_rules(run: str) -> PathRules:
    return PathRules(root=f"{run}/landed", bucket_marker="/tree/", landing_marker="/raw/")


def _with_content(audit: DataFrame) -> DataFrame:
    """The audit rows with the size and MD5 of what stands at their landing paths."""
    return st.landed_content(audit).withColumn("target_size_mb", size_mb("target_bytes"))


def q_copy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of documents, copied; sizes and content are read back from the copies."""
    run = _tree(spark, sf_dir, "copy-files")
    manifest = build_manifest(extract_inventory(spark, f"{run}/tree", listing="distributed"), _tree_rules(run))
    pending_files(manifest, empty_ledger(spark)).write.parquet(f"{run}/pending")
    audit = copy_files(spark, spark.read.parquet(f"{run}/pending"), f"{run}/audit")
    return _with_content(audit).select(
        _below("source_path").alias("source_path"), "source_size_mb", "target_size_mb", "content_md5", "status", "error"
    )


def q_copy_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files of very different sizes, dealt to tasks by bytes: what the tasks hold."""
    pending = st.orders_manifest(spark, sf_dir)
    sizes = pending.agg(*size_aggregates(mb_per_task=0.3)).first()
    dealt, _ = deal_by_bytes(spark, pending, f"{new_run_dir(spark, 'placement')}/order", sizes, files_per_task=50, mb_per_task=0.3)
    tasks = dealt.groupBy("task").agg(
        F.count(F.lit(1)).alias("n"), F.sum("source_size_mb").alias("mb"), F.count_if(F.col("source_size_mb") >= 0.3).alias("large")
    )
    return tasks.agg(
        F.sum("n").alias("n_files"), F.sum("large").alias("n_large"),
        F.bool_and((F.col("n") == 1) | ((F.col("mb") <= 0.6) & (F.col("n") <= 100))).alias("within_twice"),
        F.bool_and((F.col("large") == 0) | (F.col("n") == 1)).alias("large_alone"),
    )


def q_copy_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of documents, dealt by bytes, its longer files in parts of 4 KiB by several tasks; digests are compared."""
    run = _tree(spark, sf_dir, "copy-parts")
    manifest = build_manifest(extract_inventory(spark, f"{run}/tree", listing="distributed"), _tree_rules(run))
    manifest.write.parquet(f"{run}/pending")
    audit = copy_files(spark, spark.read.parquet(f"{run}/pending"), f"{run}/audit", mb_per_task=0.016, part_mb=0.004, verify="content")
    return _with_content(audit).select(
        _below("source_path").alias("source_path"), "source_size_mb", "target_size_mb", "content_md5", "status", "error"
    )


def q_copy_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's file, and for each a second source that does not exist."""
    run = _tree(spark, sf_dir, "copy-errors")
    manifest = build_manifest(extract_inventory(spark, f"{run}/tree", listing="distributed"), _tree_rules(run))
    gone = manifest.withColumns({c: F.concat(F.col(c), F.lit(".gone")) for c in ("source_path", "bucket_path", "lakehouse_path")})
    manifest.union(gone).write.parquet(f"{run}/pending")
    began = datetime.now(timezone.utc)
    audit = copy_files(spark, spark.read.parquet(f"{run}/pending"), f"{run}/audit")
    return _with_content(audit).select(
        _below("source_path").alias("source_path"), "status", F.col("error").isNotNull().alias("has_error"),
        F.col("content_md5").isNotNull().alias("landed"), (F.col("copied_at") >= F.lit(began)).alias("copied_since_start"),
    )


def q_run_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run over the tree of documents, and a second one that finds nothing."""
    run = _tree(spark, sf_dir, "run-landing")
    cfg = LandingConfig(source=f"{run}/tree", ledger=Ledger(path=f"{run}/ledger"), rules=_tree_rules(run), staging_dir=f"{run}/first")
    first = run_landing(spark, cfg)
    second = run_landing(spark, replace(cfg, staging_dir=f"{run}/second"))
    return (
        _with_content(first.audit)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("n_files"), F.count_distinct("content_md5").alias("n_contents"))
        .withColumn("n_pending_rerun", F.lit(second.count).cast("bigint"))
    )


def q_run_landing_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that ended before its append: the next one records what it had landed and finds nothing to copy."""
    run = _tree(spark, sf_dir, "run-resumed")
    rules, ledger = _tree_rules(run), Ledger(path=f"{run}/ledger", layout="runs")
    ensure_ledger(spark, ledger)
    manifest = build_manifest(extract_inventory(spark, f"{run}/tree", listing="distributed"), rules)
    manifest.write.parquet(f"{run}/lost/pending")
    record_intent(spark, ledger, "lost-run", f"{run}/lost")
    copy_files(spark, spark.read.parquet(f"{run}/lost/pending"), f"{run}/lost/audit")
    result = run_landing(spark, LandingConfig(source=f"{run}/tree", ledger=ledger, rules=rules, staging_dir=f"{run}/next"))
    rows = read_ledger(spark, ledger).groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))
    return rows.select(
        "status", "n_files", F.lit(result.stats["resumed"]).cast("bigint").alias("n_resumed"), F.lit(result.count).cast("bigint").alias("n_copied_again")
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "file_inventory": q_file_inventory,
    "file_inventory_distributed": q_file_inventory_distributed,
    "inventory_glob": q_inventory_glob,
    "inventory_flat": q_inventory_flat,
    "inventory_roots": q_inventory_roots,
    "size_projection": q_size_projection,
    "bucket_path": q_bucket_path,
    "bucket_path_missing": q_bucket_path_missing,
    "bucket_path_ci": q_bucket_path_ci,
    "landing_path": q_landing_path,
    "landing_path_strip_one": q_landing_path_strip_one,
    "landing_path_strip_any": q_landing_path_strip_any,
    "landing_path_repeated": q_landing_path_repeated,
    "manifest": q_manifest,
    "unmapped_rows": q_unmapped_rows,
    "landing_collisions": q_landing_collisions,
    "latest_versions": q_latest_versions,
    "pending_files": q_pending_files,
    "pending_first_load": q_pending_first_load,
    "pending_after_append": q_pending_after_append,
    "latest_versions_incremental": q_latest_versions_incremental,
    "pending_files_incremental": q_pending_files_incremental,
    "append_atomic": q_append_atomic,
    "latest_success_only": q_latest_success_only,
    "latest_all_status": q_latest_all_status,
    "pending_retry_failed": q_pending_retry_failed,
    "pending_summary": q_pending_summary,
    "cap_guard": q_cap_guard,
    "collisions_vs_ledger": q_collisions_vs_ledger,
    "preview": q_preview,
    "preview_any": q_preview_any,
    "audit_records": q_audit_records,
    "copy_files": q_copy_files,
    "copy_placement": q_copy_placement,
    "copy_in_parts": q_copy_in_parts,
    "copy_with_errors": q_copy_with_errors,
    "run_landing": q_run_landing,
    "run_landing_resumed": q_run_landing_resumed,
}


# Queries of the optional subpackage, where it is there.
_ORACLE_MORE: dict[str, str] = {}
try:
    import corpus_pipeline
    from quayside.llm import queries as _llm
except ImportError:
    pass
else:
    _QUERIES |= _llm.QUERIES | {"pipeline": corpus_pipeline.run}
    _ORACLE_MORE |= _llm.ORACLE_SQL
    if corpus_pipeline.ORACLE_SQL:
        _ORACLE_MORE["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: new-or-updated files, orders (manifest) vs lineitem (ledger), sf0.001."""
    return q_pending_files(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


# ---------------------------------------------------------------- oracle SQL
P = st.PREFIX


def _after(e: str, m: str) -> str:
    return f"CASE WHEN strpos({e}, '{m}') > 0 THEN substr({e}, strpos({e}, '{m}') + {len(m)}) END"


def _landing(e: str, m: str, root: str) -> str:
    return f"'{root}/' || string_split({e}, '{m}')[2]"


_DOC_PATH = f"'{P}' || source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt'"
_ORDER_PATH = f"'{P}orders/' || CAST(o_orderkey AS VARCHAR) || '.csv'"
_LINE_PATH = f"'{P}orders/' || CAST(l_orderkey AS VARCHAR) || '.csv'"
_EVENT_PATH = f"'{P}events/' || CAST(user_id AS VARCHAR) || '.json'"
_EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"

# The files of the tree: zero-byte files are invisible.
_TREE = """
SELECT source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, CAST(doc_id AS VARCHAR) || '.txt' AS name,
       source, text, round(strlen(text) / 1048576, 2) AS mb
FROM documents WHERE strlen(text) > 0"""

_MAN_COLS = "m.source_path, m.source_modified_at, m.source_size_mb, m.bucket_path, m.lakehouse_path"

_PENDING_CTE = f"""
inv AS (
  SELECT {_ORDER_PATH} AS source_path, o_orderdate AS source_modified_at,
         round(floor(o_totalprice) / 1048576, 2) AS source_size_mb
  FROM orders),
man AS (
  SELECT source_path, source_modified_at, source_size_mb,
         {_after('source_path', '/Files/')} AS bucket_path,
         {_landing('source_path', '/raw/', st.LANDING_ROOT)} AS lakehouse_path
  FROM inv),
lat AS (
  SELECT {_LINE_PATH} AS source_path, max(l_shipdate) AS latest_copied_time
  FROM lineitem GROUP BY 1),
pend AS (
  SELECT {_MAN_COLS}
  FROM man m LEFT JOIN lat l ON m.source_path = l.source_path
  WHERE m.source_modified_at > coalesce(l.latest_copied_time, {_EPOCH}))
"""

_EVENTS_CTE = f"""
ev AS (
  SELECT {_EVENT_PATH} AS source_path, ts,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS status
  FROM events)
"""

_ORACLE: dict[str, str] = {
    "file_inventory": f"SELECT path AS source_path, mb AS source_size_mb, true AS has_time FROM ({_TREE})",
    "file_inventory_distributed": f"SELECT path AS source_path, mb AS source_size_mb, true AS has_time FROM ({_TREE})",
    "inventory_glob": f"""
SELECT path AS source_path, mb AS source_size_mb FROM ({_TREE})
WHERE regexp_full_match(source, 'src(0|1.)') AND regexp_full_match(name, '(.*[0-3]|[^1-8].)\\.txt')""",
    "inventory_flat": f"SELECT replace(path, '/', '-') AS source_path, mb AS source_size_mb FROM ({_TREE})",
    "inventory_roots": f"""
SELECT path AS source_path, mb AS source_size_mb FROM ({_TREE}) WHERE source = 'src1'
UNION ALL
SELECT path, mb FROM ({_TREE}) WHERE regexp_full_match(path, 'src[2-9]/e[^/]*/.*')
UNION ALL
SELECT path, mb FROM ({_TREE}) WHERE regexp_full_match(source, 'src1[0-4]')""",
    "landing_path_repeated": f"""
SELECT page_id, {_landing('url', 'th', st.PAGES_ROOT)} AS piece, '{st.PAGES_ROOT}/' || {_after('url', 'th')} AS tail
FROM pages""",
    "preview_any": f"WITH {_PENDING_CTE} SELECT least(count(*), 20) AS n_rows, least(count(*), 20) AS n_pending FROM pend",
    "cap_guard": f"""
WITH {_PENDING_CTE} SELECT count(*) AS n_files, false AS raises_at_cap, true AS raises_over_cap FROM pend""",
    "collisions_vs_ledger": f"""
WITH o AS (
  SELECT '{P}orders/' || CAST(o_orderkey AS VARCHAR) AS stem FROM orders WHERE o_orderdate > {_EPOCH}),
l AS (SELECT DISTINCT '{P}orders/' || CAST(l_orderkey AS VARCHAR) AS stem FROM lineitem)
SELECT {_landing('stem', '/raw/', st.LANDING_ROOT)} AS lakehouse_path, stem || '.csv' AS first_source, stem || '.txt' AS last_source
FROM o JOIN l USING (stem)""",
    "size_projection": "SELECT doc_id, round(n_chars / 1024, 2) AS source_size_mb FROM documents",
    "bucket_path": f"""
SELECT doc_id, source_path, {_after('source_path', '/Files/')} AS bucket_path
FROM (SELECT doc_id, {_DOC_PATH} AS source_path FROM documents)""",
    "bucket_path_missing": f"SELECT page_id, {_after('url', '/en/')} AS bucket_path FROM pages",
    "bucket_path_ci": """
SELECT page_id,
       CASE WHEN regexp_matches(url, '(?is)/EN/') THEN regexp_extract(url, '(?is)/EN/(.*)', 1) END AS bucket_path
FROM pages""",
    "landing_path": f"""
SELECT doc_id, {_landing('source_path', '/raw/', st.LANDING_ROOT)} AS lakehouse_path
FROM (SELECT doc_id, {_DOC_PATH} AS source_path FROM documents)""",
    "landing_path_strip_one": f"""
SELECT page_id, regexp_replace({_landing('url', '/en/', st.PAGES_ROOT)}, '\\.html$', '') AS lakehouse_path
FROM pages""",
    "landing_path_strip_any": f"""
SELECT page_id, regexp_replace({_landing('url', '/en/', st.PAGES_ROOT)}, '\\.\\w+$', '') AS lakehouse_path
FROM pages""",
    "manifest": f"""
SELECT source_path, source_modified_at, source_size_mb,
       {_after('source_path', '/Files/')} AS bucket_path,
       {_landing('source_path', '/raw/', st.LANDING_ROOT)} AS lakehouse_path
FROM (SELECT {_DOC_PATH} AS source_path,
             TIMESTAMP '{st.DOC_EPOCH}' + to_seconds(doc_id) AS source_modified_at,
             round(n_chars / 1024, 2) AS source_size_mb
      FROM documents)""",
    "unmapped_rows": f"""
SELECT url AS source_path, {_after('url', '://')} AS bucket_path, CAST(NULL AS VARCHAR) AS lakehouse_path
FROM pages WHERE strpos(url, '/en/') = 0""",
    "landing_collisions": f"""
SELECT lakehouse_path, count(*) AS n_sources
FROM (SELECT regexp_replace({_landing('url', '/en/', st.PAGES_ROOT)}, '\\.\\w+$', '') AS lakehouse_path FROM pages)
WHERE lakehouse_path IS NOT NULL
GROUP BY lakehouse_path HAVING count(*) > 1""",
    "latest_versions": f"""
SELECT {_LINE_PATH} AS source_path, max(l_shipdate) AS latest_copied_time
FROM lineitem GROUP BY 1""",
    "pending_files": f"WITH {_PENDING_CTE} SELECT * FROM pend",
    "pending_first_load": f"""
WITH {_PENDING_CTE}
SELECT {_MAN_COLS} FROM man m WHERE m.source_modified_at > {_EPOCH}""",
    "pending_after_append": f"""
WITH {_PENDING_CTE}
SELECT count(*) AS n_pending_before, count(*) AS n_appended, CAST(0 AS BIGINT) AS n_pending_after
FROM pend""",
    "latest_versions_incremental": f"""
SELECT {_LINE_PATH} AS source_path, max(l_shipdate) AS latest_copied_time
FROM lineitem GROUP BY 1""",
    "pending_files_incremental": f"WITH {_PENDING_CTE} SELECT * FROM pend",
    "append_atomic": f"""
WITH {_PENDING_CTE}, l AS (SELECT count(*) AS n FROM lineitem)
SELECT l.n AS n_before, l.n AS n_cut_off, l.n + (SELECT count(*) FROM pend) AS n_after FROM l""",
    "latest_success_only": f"""
WITH {_EVENTS_CTE}
SELECT source_path, max(ts) AS latest_copied_time FROM ev WHERE status = 'SUCCESS' GROUP BY 1""",
    "latest_all_status": f"""
WITH {_EVENTS_CTE}
SELECT source_path, max(ts) AS latest_copied_time FROM ev GROUP BY 1""",
    "pending_retry_failed": f"""
WITH {_EVENTS_CTE},
man AS (
  SELECT source_path, max(ts) AS source_modified_at, CAST(0 AS DOUBLE) AS source_size_mb,
         {_after('source_path', '/Files/')} AS bucket_path,
         {_landing('source_path', '/raw/', st.LANDING_ROOT)} AS lakehouse_path
  FROM ev GROUP BY source_path),
lat AS (SELECT source_path, max(ts) AS latest_copied_time FROM ev WHERE status = 'SUCCESS' GROUP BY 1)
SELECT {_MAN_COLS}
FROM man m LEFT JOIN lat l ON m.source_path = l.source_path
WHERE m.source_modified_at > coalesce(l.latest_copied_time, {_EPOCH})""",
    "pending_summary": f"""
WITH {_PENDING_CTE}
SELECT count(*) AS n_files, count(*) = 0 AS is_empty, count(*) > {MAX_FILES} AS over_cap FROM pend""",
    "preview": f"WITH {_PENDING_CTE} SELECT * FROM pend ORDER BY source_path LIMIT 20",
    "audit_records": f"""
WITH {_PENDING_CTE}
SELECT *, TIMESTAMP '{st.AUDIT_TIME}' AS copied_at, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error
FROM pend""",
    "copy_files": f"""
SELECT path AS source_path, mb AS source_size_mb, mb AS target_size_mb, md5(text) AS content_md5,
       'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error
FROM ({_TREE})""",
    "copy_placement": """
SELECT count(*) AS n_files, count(*) FILTER (WHERE round(floor(o_totalprice) / 1048576, 2) >= 0.3) AS n_large,
       true AS within_twice, true AS large_alone
FROM orders""",
    "copy_in_parts": f"""
SELECT path AS source_path, mb AS source_size_mb, mb AS target_size_mb, md5(text) AS content_md5,
       'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error
FROM ({_TREE})""",
    "run_landing_resumed": f"""
SELECT 'SUCCESS' AS status, count(*) AS n_files, count(*) AS n_resumed, CAST(0 AS BIGINT) AS n_copied_again FROM ({_TREE})""",
    "copy_with_errors": f"""
SELECT path AS source_path, 'SUCCESS' AS status, false AS has_error, true AS landed, true AS copied_since_start FROM ({_TREE})
UNION ALL
SELECT path || '.gone', 'ERROR', true, false, true FROM ({_TREE})""",
    "run_landing": f"""
SELECT 'SUCCESS' AS status, count(*) AS n_files, count(DISTINCT text) AS n_contents, CAST(0 AS BIGINT) AS n_pending_rerun
FROM ({_TREE})""",
}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in (_ORACLE | _ORACLE_MORE).items() if k in _QUERIES}
