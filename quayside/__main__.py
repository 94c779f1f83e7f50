"""Command line: run one landing pass with the session spark-submit provides.

    spark-submit --py-files quayside.zip quayside/__main__.py --source s3a://bucket/raw/ \\
        --ledger-table meta.landing --root abfss://lake/Files/Landing/raw \\
        --bucket-marker /Files/ --landing-marker /raw/
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from quayside.operators.manifest import PathRules
from quayside.plans.landing import LandingConfig, run_landing
from quayside.schema import DEFAULT_BUCKET_MARKER, STATUS_SUCCESS
from quayside.sources.ledger import Ledger


def parse(argv: list[str]) -> LandingConfig:
    ap = argparse.ArgumentParser(prog="quayside", description="Land new or updated files and record them in a ledger.")
    ap.add_argument("--source", required=True, nargs="+", help="folder(s) to list recursively")
    led = ap.add_mutually_exclusive_group(required=True)
    led.add_argument("--ledger-table", help="catalog table name of the ledger")
    led.add_argument("--ledger-path", help="storage path of the ledger")
    ap.add_argument("--format", default="parquet", help="ledger table format (parquet, delta, ...)")
    ap.add_argument("--ledger-buckets", type=int, default=None, help="bucket a catalog ledger on source_path")
    ap.add_argument("--root", required=True, help="landing root; files land at <root>/<piece after the landing marker>")
    ap.add_argument("--bucket-marker", default=DEFAULT_BUCKET_MARKER)
    ap.add_argument("--landing-marker", required=True, help="files land at <root>/<piece after this marker>")
    ap.add_argument("--bucket-ignore-case", action="store_true")
    ap.add_argument("--keep-tail", action="store_true", help="keep everything after the first landing marker")
    ap.add_argument("--strip-ext", default=None, help="drop this extension from landing paths, '*' for any")
    ap.add_argument("--glob", default=None, help="only file names matching this pattern")
    ap.add_argument("--listing", default="distributed", choices=["binaryFile", "distributed"])
    ap.add_argument("--retry-failed", action="store_true", help="retry files whose last copy failed")
    ap.add_argument("--on-unmapped", default="fail", choices=["fail", "reject"])
    ap.add_argument("--on-collision", default="fail", choices=["fail", "allow"])
    ap.add_argument("--max-files", type=int, default=None)
    ap.add_argument("--copy-threads", type=int, default=None)
    ap.add_argument("--tasks", type=int, default=None, help="number of copy tasks (default: from files and bytes)")
    ap.add_argument("--keep-staging", action="store_true", help="leave the run's listing, pending and audit files")
    ap.add_argument("--preview", type=int, default=20, help="rows of pending/audit to log")
    a = ap.parse_args(argv)
    return LandingConfig(
        source=a.source[0] if len(a.source) == 1 else a.source,
        ledger=Ledger(name=a.ledger_table, path=a.ledger_path, fmt=a.format, buckets=a.ledger_buckets),
        rules=PathRules(
            root=a.root,
            bucket_marker=a.bucket_marker,
            landing_marker=a.landing_marker,
            bucket_ignore_case=a.bucket_ignore_case,
            keep_tail=a.keep_tail,
            strip_ext=a.strip_ext,
        ),
        glob=a.glob,
        listing=a.listing,
        retry_failed=a.retry_failed,
        on_unmapped=a.on_unmapped,
        on_collision=a.on_collision,
        max_files=a.max_files,
        copy_threads=a.copy_threads,
        num_tasks=a.tasks,
        preview_rows=a.preview,
        keep_staging=a.keep_staging,
    )


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    cfg = parse(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("quayside-landing").getOrCreate()
    result = run_landing(spark, cfg)
    print(json.dumps({"copied": result.count, "run_dir": result.run_dir, **result.stats}, default=str))
    status = result.stats.get("status", {})
    return 1 if status and STATUS_SUCCESS not in status else 0  # every copy failed


if __name__ == "__main__":
    sys.exit(main())
