"""Recursive file listing as a DataFrame (Spark's ``binaryFile`` source).

Only ``path``, ``modificationTime`` and ``length`` are selected, so the scan's
ReadSchema never contains ``content`` and no file body is read. Spark skips
zero-byte files and names starting with ``_`` or ``.``.

Task count: Spark packs ``binaryFile`` splits as if content were read (file
length plus a 4 MiB open cost per file), so a tree of a million small files, or
of 100 TB, would become tens of thousands of scan tasks that each only stat a
few files. The listing is therefore coalesced (no shuffle) to at most
``max_tasks`` tasks; by default two per core, but never more than 64 of Spark's
packed splits per task (with dynamic allocation the core count can be small
when the job is planned). Each task stats its share of the files and emits the
metadata rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

LISTING_COLUMNS = ["path", "modificationTime", "length"]


def scan_files(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    modified_after: str | None = None,
    options: dict[str, str] | None = None,
    max_tasks: int | None = None,
) -> DataFrame:
    # A file deleted between the driver's listing and the task's stat is skipped,
    # not a failed run (deletes are not propagated anyway).
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    paths = [path] if isinstance(path, str) else list(path)
    listing = reader.load(paths).select(*LISTING_COLUMNS)
    if max_tasks is None:
        splits = listing.rdd.getNumPartitions()  # planning only, no job
        max_tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(splits / 64))
    return listing.coalesce(max_tasks) if max_tasks > 0 else listing
