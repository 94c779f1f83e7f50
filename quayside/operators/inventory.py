"""File listing -> inventory (path, modification time, size in MiB)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.paths import size_mb
from quayside.schema import BYTES_PER_MIB
from quayside.sources.files import scan_files
from quayside.sources.listing import PAGE_LIMIT, list_files


def file_inventory(listing: DataFrame, factor: int = BYTES_PER_MIB) -> DataFrame:
    """Rename the listing columns and convert ``length`` with ``factor``."""
    return listing.select(
        F.col("path").alias("source_path"),
        F.col("modificationTime").alias("source_modified_at"),
        size_mb("length", factor).alias("source_size_mb"),
    )


def extract_inventory(
    spark: SparkSession,
    source: str | list[str],
    factor: int = BYTES_PER_MIB,
    glob: str | None = None,
    listing: str = "binaryFile",
    staging_dir: str | None = None,
    dir_counter=None,
    vanished=None,
    page_limit: int = PAGE_LIMIT,
    pages=None,
) -> DataFrame:
    """Listing + projection.

    ``listing='binaryFile'`` uses Spark's file source (file index on the
    driver); ``'distributed'`` walks the tree on the executors and stages the
    listing (for trees with tens of millions of files); ``page_limit`` and ``pages`` as in ``list_files``.
    """
    if listing == "binaryFile":
        return file_inventory(scan_files(spark, source, glob=glob), factor)
    if listing == "distributed":
        listed = list_files(
            spark, source, f"{staging_dir}/listing-0" if staging_dir else None, glob=glob, dir_counter=dir_counter, vanished=vanished,
            page_limit=page_limit, pages=pages,
        )
        return file_inventory(listed, factor)
    raise ValueError("listing must be 'binaryFile' or 'distributed'")
