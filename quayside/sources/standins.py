"""Map the supplied test tables onto the shapes the landing operators consume.

The test tables hold no files, so their rows stand in for inventory, manifest
and ledger rows: a key becomes a source path, a date becomes a modification
time, a count becomes a size. Every mapping is a projection over the whole
table (no row subset), so its cost grows with the table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quayside.functions.paths import landing_path, path_after, size_mb
from quayside.operators.manifest import PathRules, build_manifest
from quayside.schema import STATUS_ERROR, STATUS_SUCCESS
from quayside.sources.fsuri import FileSystems, storage_settings

# Fixed values shared with the DuckDB oracle SQL in __spark_entry__.py.
PREFIX = "abfss://ws@lake.example/id/Files/bucket-a/raw/"
LANDING_ROOT = "Files/Landing/raw"
PAGES_ROOT = "Files/Landing/pages"
DOC_EPOCH = "2020-01-01 00:00:00"
AUDIT_TIME = "2024-01-01 00:00:00"

#: Rows of a batch of whole texts.
TEXT_ROWS = 1_000

STANDIN_RULES = PathRules(root=LANDING_ROOT, bucket_marker="/Files/", landing_marker="/raw/")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _key_path(sub: str, key: str, ext: str):
    return F.concat(F.lit(f"{PREFIX}{sub}/"), F.col(key).cast("string"), F.lit(ext))


def ntz(text: str):
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def documents_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source_path = PREFIX + source/lang/doc_id.txt, n_chars."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.concat(
            F.lit(PREFIX), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"),
            F.col("doc_id").cast("string"), F.lit(".txt"),
        ).alias("source_path"),
        "n_chars",
    )


def documents_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory rows: size from n_chars with factor 1024, time = DOC_EPOCH + doc_id s."""
    d = documents_paths(spark, sf_dir)
    return d.select(
        "source_path",
        F.expr(f"timestampadd(SECOND, doc_id, TIMESTAMP_NTZ '{DOC_EPOCH}')").alias("source_modified_at"),
        size_mb("n_chars", 1024).alias("source_size_mb"),
    )


def orders_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest side: one file per order, o_orderdate as its modification time."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        _key_path("orders", "o_orderkey", ".csv").alias("source_path"),
        F.col("o_orderdate").alias("source_modified_at"),
        size_mb(F.floor("o_totalprice")).alias("source_size_mb"),
    )


def orders_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_manifest(orders_inventory(spark, sf_dir), STANDIN_RULES)


def lineitem_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger side: one landed version per line item, l_shipdate as the version."""
    li = table(spark, sf_dir, "lineitem")
    path = _key_path("orders", "l_orderkey", ".csv")
    return li.select(
        path.alias("source_path"),
        F.col("l_shipdate").alias("source_modified_at"),
        size_mb(F.floor("l_extendedprice")).alias("source_size_mb"),
        path_after(path, STANDIN_RULES.bucket_marker).alias("bucket_path"),
        landing_path(path, STANDIN_RULES.landing_marker, LANDING_ROOT).alias("lakehouse_path"),
        F.col("l_shipdate").alias("copied_at"),
        F.lit(STATUS_SUCCESS).alias("status"),
        F.lit(None).cast("string").alias("error"),
    )


def events_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger with statuses: one row per event, error events as failed copies."""
    e = table(spark, sf_dir, "events")
    path = _key_path("events", "user_id", ".json")
    return e.select(
        path.alias("source_path"),
        F.col("ts").alias("source_modified_at"),
        F.lit(0.0).alias("source_size_mb"),
        path_after(path, STANDIN_RULES.bucket_marker).alias("bucket_path"),
        landing_path(path, STANDIN_RULES.landing_marker, LANDING_ROOT).alias("lakehouse_path"),
        F.col("ts").alias("copied_at"),
        F.when(F.col("event_type") == "error", F.lit(STATUS_ERROR)).otherwise(F.lit(STATUS_SUCCESS)).alias("status"),
        F.when(F.col("event_type") == "error", F.lit("copy failed")).alias("error"),
    )


def documents_tree(spark: SparkSession, sf_dir: str, root: str, flat: bool = False) -> DataFrame:
    """One real file for each row of ``documents``, written by the executors as
    ``root/raw/<source>/<lang>/<doc_id>.txt`` (the text's UTF-8 bytes): ``path, size``; ``flat``: all
    in one folder, ``root/raw/<source>-<lang>-<doc_id>.txt``."""
    settings, sep = storage_settings(spark), "-" if flat else "/"

    def write(batches):
        import posixpath

        import pandas as pd

        resolve, made = FileSystems(settings).resolve, set()
        for pdf in batches:
            paths, sizes = [], []
            for doc_id, source, lang, text in zip(pdf.doc_id, pdf.source, pdf.lang, pdf.text):
                path, data = f"{root}/raw/{sep.join((source, lang, str(doc_id)))}.txt", (text or "").encode()
                fs, at = resolve(path)
                parent = posixpath.dirname(at)
                if parent not in made:
                    fs.create_dir(parent, recursive=True)
                    made.add(parent)
                # on a disk a plain file costs less than a stream
                with open(at, "wb", buffering=0) if fs.type_name == "local" else fs.open_output_stream(at) as out:
                    out.write(data)
                paths.append(path)
                sizes.append(len(data))
            yield pd.DataFrame({"path": paths, "size": sizes})

    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(TEXT_ROWS))  # whole texts: a task's Python holds a batch of them several times over
    try:
        rows.mapInPandas(write, "path string, size long").write.parquet(f"{root}-written")
    finally:
        spark.conf.set(name, before)
    return spark.read.parquet(f"{root}-written")


def landed_content(audit: DataFrame) -> DataFrame:
    """The audit rows with ``target_bytes`` and ``content_md5`` of what stands at their landing paths (null: nothing), read in
    the tasks that hold the rows: no list of files on the driver, and no scan task for every few files."""
    settings = storage_settings(audit.sparkSession)

    def read(batches):
        import hashlib

        import pyarrow as pa

        resolve = FileSystems(settings).resolve

        def content(uri):
            seen, size = hashlib.md5(usedforsecurity=False), 0
            try:
                fs, path = resolve(uri)
                with fs.open_input_stream(path) as src:
                    while block := src.read(1 << 20):
                        seen.update(block)
                        size += len(block)
            except FileNotFoundError:
                return None, None
            return size, seen.hexdigest()

        for rb in batches:
            found = [content(uri) if uri is not None else (None, None) for uri in rb.column("lakehouse_path").to_pylist()]
            columns = [*rb.columns, pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rb.schema.names, "target_bytes", "content_md5"])

    schema = StructType([*audit.schema.fields, StructField("target_bytes", LongType()), StructField("content_md5", StringType())])
    return audit.mapInArrow(read, schema)


PAGES_RULES = PathRules(root=PAGES_ROOT, bucket_marker="://", landing_marker="/en/", strip_ext="*")


def pages_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page URL as a source path; time = DOC_EPOCH + page_id s; size from the html length."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.col("url").alias("source_path"),
        F.expr(f"timestampadd(SECOND, page_id, TIMESTAMP_NTZ '{DOC_EPOCH}')").alias("source_modified_at"),
        size_mb(F.length("html"), 1024).alias("source_size_mb"),
    )
