"""Change detection against the ledger.

Plan shape: the ledger is pruned to (source_path, source_modified_at) at the
scan, reduced by a partial (map-side) max per path, shuffled once on the path,
then left-joined to the manifest. No join strategy is forced: Catalyst/AQE
broadcast the per-path maxima only when their estimated size (under AQE, their
measured shuffle size) is below ``spark.sql.autoBroadcastJoinThreshold``, and
otherwise use a sort-merge join that reuses the aggregate's partitioning (a
ledger bucketed on source_path needs no ledger shuffle at all). Both sides are
unique per path, so the join cannot be skewed by a hot key; a path repeated
across many ledger rows is collapsed by the partial aggregate before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.schema import EPOCH_TEXT, MANIFEST_COLUMNS, STATUS_SUCCESS


def latest_versions(ledger: DataFrame, retry_failed: bool = False) -> DataFrame:
    """A1: the newest recorded modification time per source path.

    Default: over every row whatever its status, so a failed copy is not retried
    until its source changes. ``retry_failed=True`` only counts SUCCESS rows (the
    status filter is pushed to the ledger scan).
    """
    if retry_failed:
        ledger = ledger.filter(F.col("status") == F.lit(STATUS_SUCCESS))
    return ledger.groupBy("source_path").agg(F.max("source_modified_at").alias("latest_copied_time"))


def newest(versions: DataFrame, retry_failed: bool = False) -> DataFrame:
    """A1 over the ``versions`` of a ledger in runs."""
    latest = F.max("latest_success" if retry_failed else "latest_any").alias("latest_copied_time")
    return versions.groupBy("source_path").agg(latest).filter(F.col("latest_copied_time").isNotNull())


def pending_since(manifest: DataFrame, latest: DataFrame) -> DataFrame:
    """C4 against the newest recorded versions: files that are new, or strictly newer than theirs."""
    mtype = manifest.schema["source_modified_at"].dataType
    epoch = F.lit(EPOCH_TEXT).cast(mtype)
    return (
        manifest.join(latest, on="source_path", how="left")
        .filter(F.col("source_modified_at") > F.coalesce(F.col("latest_copied_time").cast(mtype), epoch))
        .select(*MANIFEST_COLUMNS)
    )


def pending_files(manifest: DataFrame, ledger: DataFrame, retry_failed: bool = False) -> DataFrame:
    """C4: files that are new, or strictly newer than the latest recorded version.

    An unseen file is pending when its time is after the epoch; a NULL time is
    never pending; equal times are not pending.
    """
    return pending_since(manifest, latest_versions(ledger, retry_failed))
