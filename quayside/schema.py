"""Column sets and the ledger schema shared by every stage of a landing run."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed values that must match the reference's results.
# Bytes in one mebibyte (sizes are reported in MiB, rounded to 2 decimals).
BYTES_PER_MIB = 1024 * 1024
# Audit status values.
STATUS_SUCCESS = "SUCCESS"
STATUS_ERROR = "ERROR"
# Lower bound a file's modification time must exceed when it has never been landed.
EPOCH_TEXT = "1970-01-01 00:00:00"
# Default bucket marker: bucket_path is what follows the first "/Files/".
DEFAULT_BUCKET_MARKER = "/Files/"
# Pattern of "any last extension" when landing paths drop one.
ANY_EXTENSION_PATTERN = r"\.\w+$"
# The reference's per-run file cap (optional here: max_files).
REFERENCE_MAX_FILES = 500

INVENTORY_COLUMNS = ["source_path", "source_modified_at", "source_size_mb"]
MANIFEST_COLUMNS = INVENTORY_COLUMNS + ["bucket_path", "lakehouse_path"]
AUDIT_EXTRA_COLUMNS = ["copied_at", "status", "error"]
LEDGER_COLUMNS = MANIFEST_COLUMNS + AUDIT_EXTRA_COLUMNS

# error is the only column allowed to be NULL in a ledger row.
LEDGER_NOT_NULL = [c for c in LEDGER_COLUMNS if c != "error"]


# Fixed values that must match the reference's results: the ledger's columns, types and nullability.
def ledger_schema() -> StructType:
    return StructType(
        [
            StructField("source_path", StringType(), False),
            StructField("source_modified_at", TimestampType(), False),
            StructField("source_size_mb", DoubleType(), False),
            StructField("bucket_path", StringType(), False),
            StructField("lakehouse_path", StringType(), False),
            StructField("copied_at", TimestampType(), False),
            StructField("status", StringType(), False),
            StructField("error", StringType(), True),
        ]
    )


def audit_schema(manifest_schema: StructType) -> StructType:
    """Audit rows keep the manifest's own column types, then add the three audit columns."""
    fields = [manifest_schema[c] for c in MANIFEST_COLUMNS]
    return StructType(
        [StructField(f.name, f.dataType, True) for f in fields]
        + [
            StructField("copied_at", TimestampType(), True),
            StructField("status", StringType(), True),
            StructField("error", StringType(), True),
        ]
    )

