from quayside.operators.copy import audit_records, copy_files, copy_plan, plan_copy_tasks
from quayside.operators.detect import latest_versions, pending_files
from quayside.operators.guards import check_batch_size, pending_summary, preview, target_collisions
from quayside.operators.inventory import extract_inventory, file_inventory
from quayside.operators.manifest import PathRules, build_manifest, unmapped

__all__ = [
    "PathRules",
    "audit_records",
    "build_manifest",
    "check_batch_size",
    "copy_files",
    "copy_plan",
    "extract_inventory",
    "file_inventory",
    "latest_versions",
    "pending_files",
    "pending_summary",
    "plan_copy_tasks",
    "preview",
    "target_collisions",
    "unmapped",
]
