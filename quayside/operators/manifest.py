"""Inventory -> manifest with bucket and landing paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.paths import landing_path, path_after
from quayside.schema import DEFAULT_BUCKET_MARKER, MANIFEST_COLUMNS


@dataclass(frozen=True)
class PathRules:
    """How source paths map to bucket-relative and landing paths.

    ``bucket_marker``: bucket_path is what follows its first occurrence
    (``bucket_ignore_case`` matches it in any case). ``landing_marker``: the
    landing path is ``root/<piece after it>``; the piece ends at a second
    occurrence unless ``keep_tail``. ``strip_ext``: None, ``'*'`` or one extension.
    """

    root: str
    landing_marker: str
    bucket_marker: str = DEFAULT_BUCKET_MARKER
    bucket_ignore_case: bool = False
    keep_tail: bool = False
    strip_ext: str | None = None


def build_manifest(inventory: DataFrame, rules: PathRules) -> DataFrame:
    """Add ``bucket_path`` and ``lakehouse_path``, keep the 5 manifest columns.

    One projection over the inventory; Catalyst collapses it with the scan's.
    """
    return inventory.select(
        "source_path",
        "source_modified_at",
        "source_size_mb",
        path_after("source_path", rules.bucket_marker, rules.bucket_ignore_case).alias("bucket_path"),
        landing_path(
            "source_path",
            rules.landing_marker,
            rules.root,
            keep_tail=rules.keep_tail,
            strip_ext=rules.strip_ext,
        ).alias("lakehouse_path"),
    ).select(*MANIFEST_COLUMNS)


def unmapped(manifest: DataFrame) -> DataFrame:
    """Rows whose landing path could not be derived (marker missing)."""
    return manifest.filter(F.col("lakehouse_path").isNull())
