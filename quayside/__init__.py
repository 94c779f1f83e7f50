"""quayside: incremental file landing as Spark DataFrame jobs.

List files under any Hadoop-compatible path, derive bucket and landing paths
with column expressions, compare the listing with an append-only ledger to
find new or strictly newer files, copy them in parallel on the executors, and
append one audit row per file.
"""

from quayside.functions import landing_path, path_after, path_piece, size_mb, strip_extension
from quayside.operators import (
    PathRules,
    audit_records,
    build_manifest,
    check_batch_size,
    copy_files,
    copy_plan,
    extract_inventory,
    file_inventory,
    latest_versions,
    pending_files,
    pending_summary,
    preview,
    target_collisions,
)
from quayside.plans import LandingConfig, LandingResult, copy_pending, run_landing, setup_ledger
from quayside.schema import ledger_schema
from quayside.sources import Ledger, append_ledger, empty_ledger, ensure_ledger, read_ledger, scan_files
from quayside.sources.listing import list_files

__all__ = [
    "LandingConfig",
    "LandingResult",
    "Ledger",
    "PathRules",
    "append_ledger",
    "audit_records",
    "build_manifest",
    "check_batch_size",
    "copy_files",
    "copy_pending",
    "copy_plan",
    "empty_ledger",
    "ensure_ledger",
    "extract_inventory",
    "file_inventory",
    "landing_path",
    "latest_versions",
    "ledger_schema",
    "list_files",
    "path_after",
    "path_piece",
    "pending_files",
    "pending_summary",
    "preview",
    "read_ledger",
    "run_landing",
    "scan_files",
    "setup_ledger",
    "size_mb",
    "strip_extension",
    "target_collisions",
]
