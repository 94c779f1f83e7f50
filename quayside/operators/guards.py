"""A2-A4, O1-O2 and pre-copy checks on a (staged) pending set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.schema import STATUS_SUCCESS


def pending_summary(pending: DataFrame, max_files: int | None = None) -> DataFrame:
    """A2/A3/A4 in one aggregate pass: file count, emptiness, over the cap."""
    n = F.count(F.lit(1))
    cap = F.lit(False) if max_files is None else n > F.lit(max_files)
    return pending.agg(n.alias("n_files"), (n == 0).alias("is_empty"), cap.alias("over_cap"))


def check_batch_size(pending: DataFrame, max_files: int | None) -> int | None:
    """A4: raise when more than ``max_files`` rows are pending; exactly the cap passes.

    Reads at most ``max_files + 1`` rows; returns the exact count when within the
    cap, None when there is no cap.
    """
    if max_files is None:
        return None
    n = pending.limit(max_files + 1).count()
    if n > max_files:
        raise ValueError(f"more than {max_files} files are pending ({n} seen); raise max_files or split the run")
    return n


def target_collisions(pending: DataFrame) -> DataFrame:
    """Landing paths claimed by more than one source path in this batch."""
    return (
        pending.filter(F.col("lakehouse_path").isNotNull())
        .groupBy("lakehouse_path")
        .agg(F.count(F.lit(1)).alias("n_sources"))
        .filter(F.col("n_sources") > 1)
    )


#: Pending rows whose landing paths are broadcast.
FEW_PENDING = 20_000


def claimed_targets(pending: DataFrame, manifest: DataFrame, ledger: DataFrame, n_pending: int | None = None) -> DataFrame:
    """Landing paths of pending files that more than one source claims, in the whole
    listing or by a landed row of the ledger: ``lakehouse_path, first_source,
    last_source`` (smallest and largest source path). Only paths that a pending file
    would write are looked at; minima and maxima are partial before the shuffle. ``n_pending``: how many rows are pending, where
    the caller has counted them; up to ``FEW_PENDING`` their paths are broadcast, so neither claims nor paths are shuffled for the join."""
    claims = manifest.select("lakehouse_path", "source_path").union(
        ledger.filter(F.col("status") == STATUS_SUCCESS).select("lakehouse_path", "source_path")
    )
    few = n_pending is not None and n_pending <= FEW_PENDING
    wanted = F.broadcast(pending.select("lakehouse_path")) if few else pending.select("lakehouse_path").distinct()
    return (
        claims.join(wanted, "lakehouse_path", "left_semi")
        .groupBy("lakehouse_path")
        .agg(F.min("source_path").alias("first_source"), F.max("source_path").alias("last_source"))
        .filter(F.col("first_source") != F.col("last_source"))
    )


def preview(df: DataFrame, n: int = 20, order_by: str | None = "source_path") -> DataFrame:
    """O1/O2: first ``n`` rows ordered by ``order_by`` (a top-k, planned as
    TakeOrderedAndProject), or any ``n`` rows when ``order_by`` is None."""
    if order_by is None:
        return df.limit(n)
    return df.orderBy(order_by).limit(n)
