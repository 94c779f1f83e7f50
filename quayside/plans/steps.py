"""The run as separate steps, for callers that drive each one themselves.

    inventory = extract_inventory(spark, source)            # C1
    manifest = build_manifest(inventory, rules)             # C2
    ledger_df = setup_ledger(spark, ledger)                 # C3
    pending = pending_files(manifest, ledger_df)            # C4
    audit, n = copy_pending(spark, pending, ledger)         # C5
    append_ledger(spark, audit, ledger, row_count=n)        # C6

``run_landing`` does the same with the checks and logging in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.copy import copy_files
from quayside.schema import ledger_schema
from quayside.session import new_run_dir
from quayside.sources.ledger import Ledger, empty_ledger, ensure_ledger, ledger_table_schema, read_ledger


def setup_ledger(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """Create the ledger if absent, then return it as a DataFrame."""
    ensure_ledger(spark, ledger)
    return read_ledger(spark, ledger)


def copy_pending(
    spark: SparkSession,
    pending: DataFrame,
    ledger: Ledger | None = None,
    max_files: int | None = None,
    staging_dir: str | None = None,
    **copy_options,
) -> tuple[DataFrame, int]:
    """Stage the pending set once, check the cap, copy, and return
    ``(audit rows, count)``; ``(empty rows with the ledger's schema, 0)`` when
    nothing is pending. Raising over the cap happens before any copy."""
    run = staging_dir or new_run_dir(spark, "copy")
    pending.write.mode("errorifexists").parquet(f"{run}/pending")
    staged = spark.read.schema(pending.schema).parquet(f"{run}/pending")
    n = staged.count()
    if max_files is not None and n > max_files:
        raise ValueError(f"{n} files are pending, more than max_files={max_files}; nothing was copied")
    if n == 0:
        schema = ledger_table_schema(spark, ledger) if ledger is not None else ledger_schema()
        return empty_ledger(spark, schema), 0
    audit = copy_files(spark, staged, f"{run}/audit", **copy_options)
    return audit, n
