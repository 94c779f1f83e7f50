from quayside.sources.files import scan_files
from quayside.sources.ledger import (
    Ledger,
    append_ledger,
    empty_ledger,
    ensure_ledger,
    ledger_table_schema,
    null_violations,
    read_ledger,
)

__all__ = [
    "Ledger",
    "append_ledger",
    "empty_ledger",
    "ensure_ledger",
    "ledger_table_schema",
    "null_violations",
    "read_ledger",
    "scan_files",
]
