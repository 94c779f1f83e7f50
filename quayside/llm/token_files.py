"""Token-id output as directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first. Level k holds the k-th
chunks of all ids that have one, a bitmap tells which of them go on in level
k + 1, and a rank directory holds the ones before every 512 bits of the bitmap.
Token i is read by following it down: its place in level k + 1 is its rank in
level k. No block is decoded, and a range costs its own length.

A shard file: ``b"DACTOK1\\0"``; little-endian u64 n_tokens, n_docs, n_levels, then a
byte length for each section; the sections: doc_ids (i64), which of them are null
(bitmap), doc starts in the shard (u64, one more than documents), and for each
level chunks (u8), bitmap (bits from the low end), ranks (u64).

Documents are range-partitioned by (doc_id, text hash), so a shard is written by one
task in ascending order, in files of at most about ``FILE_TOKENS``. A task names its
files anew on each attempt and hands on a manifest row for each; the manifest, which
Spark commits, says which files count and where each starts, so a lost executor
leaves at most files that nobody names.

Nulls: a null text has no ids but the end id; null doc_ids come first. Rows of one
doc_id follow each other in the order of their text hashes. Empty tables write no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import pick, run_dir, staged, steps, table, text_bytes
from quayside.llm.word_ids import WordIds, remembered
from quayside.sources.fsuri import FileSystems

MAGIC = b"DACTOK1\0"
CHUNK_BITS = 8
RANK_BITS = 512
FILE_TOKENS = 16 << 20
END_ID = 2

_MANIFEST = "shard int, part int, file string, n_tokens long, n_docs long"
_RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- the file format
def dac_encode(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(chunks, bitmap, ranks)`` of each level."""
    levels, left = [], ids.astype(np.uint32)
    while True:
        more = left >> np.uint32(CHUNK_BITS)
        on = more > 0
        before = np.concatenate(([0], np.cumsum(np.add.reduceat(on, np.arange(0, len(on), RANK_BITS), dtype=np.uint64)))) if len(on) else [0]
        levels.append(((left & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8), np.packbits(on, bitorder="little"), np.array(before, np.uint64)))
        left = more[on]
        if not len(left):
            return levels


def write_shard(out, ids: np.ndarray, starts: np.ndarray, doc_ids: list[int | None]) -> None:
    null = np.array([d is None for d in doc_ids], bool)
    sections = [np.array([d or 0 for d in doc_ids], "<i8"), np.packbits(null, bitorder="little"), starts.astype("<u8")]
    levels = dac_encode(ids)
    for chunks, bitmap, ranks in levels:
        sections += [chunks, bitmap, ranks.astype("<u8")]
    out.write(MAGIC + struct.pack(f"<{3 + len(sections)}Q", len(ids), len(doc_ids), len(levels), *[s.nbytes for s in sections]))
    for s in sections:
        out.write(memoryview(np.ascontiguousarray(s)).cast("B"))


class Shard:
    """Random access to a shard's bytes (a buffer, such as a memory map)."""

    def __init__(self, data):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token shard")
        self.n_tokens, self.n_docs, n_levels = struct.unpack_from("<3Q", data, 8)
        sizes = struct.unpack_from(f"<{3 + 3 * n_levels}Q", data, 32)
        at, sections = 32 + 8 * len(sizes), []
        for size in sizes:
            sections.append(memoryview(data)[at : at + size])
            at += size
        ids = np.frombuffer(sections[0], "<i8").tolist()
        null = np.unpackbits(np.frombuffer(sections[1], np.uint8), count=self.n_docs, bitorder="little")
        self.doc_ids = [None if x else d for d, x in zip(ids, null)]
        self.starts = np.frombuffer(sections[2], "<u8").astype(np.int64)
        self.levels = [tuple(np.frombuffer(s, t) for s, t in zip(sections[k : k + 3], (np.uint8, np.uint8, "<u8"))) for k in range(3, len(sections), 3)]

    def _rank(self, level: int, at: int) -> int:
        """Ones of a level's bitmap before bit ``at``."""
        _, bitmap, ranks = self.levels[level]
        block = at // RANK_BITS
        rest = np.unpackbits(bitmap[block * RANK_BITS // 8 : -(-at // 8)], count=at - block * RANK_BITS, bitorder="little")
        return int(ranks[block]) + int(rest.sum())

    def token(self, at: int) -> int:
        """One id, without decoding any other."""
        return int(self.range(at, at + 1)[0])

    def range(self, a: int, b: int) -> np.ndarray:
        """Ids ``a .. b - 1``."""
        if not 0 <= a <= b <= self.n_tokens:
            raise IndexError((a, b))
        out, which = np.zeros(b - a, np.uint32), np.arange(b - a)
        for k, (chunks, bitmap, _) in enumerate(self.levels):
            out[which] |= chunks[a:b].astype(np.uint32) << np.uint32(CHUNK_BITS * k)
            if k + 1 == len(self.levels) or a == b:
                break
            bits = np.unpackbits(bitmap[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
            which = which[bits]
            a = self._rank(k, a)
            b = a + len(which)
            if a == b:
                break
        return out

    def document(self, k: int) -> np.ndarray:
        return self.range(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self, at_once: int = 1 << 20) -> Iterator[memoryview]:
        """The bytes of each document's ids, in order; ranges of about ``at_once`` tokens are followed down together."""
        k = 0
        while k < self.n_docs:
            end = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + at_once, "right")) - 1)
            cuts = (4 * (self.starts[k : end + 1] - self.starts[k])).tolist()
            data = memoryview(self.range(int(self.starts[k]), int(self.starts[end])).astype("<u4")).cast("B")
            yield from (data[a:b] for a, b in zip(cuts, cuts[1:]))
            k = end


# ---------------------------------------------------------------- Spark jobs
def _write(folder: str, tokenizer, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, files = remembered(WordIds, tokenizer.value, end_id), FileSystems()
        shard, part = TaskContext.get().partitionId(), 0
        ids, sizes, doc_ids, held = [], [], [], 0

        def flush():
            name = f"tokens-{shard:06d}-{part:04d}-{uuid.uuid4().hex[:12]}.dac"
            fs, at = files.resolve(f"{folder}/{name}")
            if fs.type_name == "local":
                fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
            starts = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
            with fs.open_output_stream(at) as out:
                write_shard(out, np.concatenate(ids), starts, doc_ids)
            row = {"shard": [shard], "part": [part], "file": [name], "n_tokens": [held], "n_docs": [len(doc_ids)]}
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), kinds)], names=list(row))

        for rb in steps(batches):
            buf, offs = text_bytes(rb.column("text"))
            got, starts = words.ids(buf.tobytes(), offs.tolist())
            ids.append(got)
            sizes.append(np.diff(starts))
            doc_ids += rb.column("doc_id").to_pylist()
            held += len(got)
            if held >= FILE_TOKENS:
                yield flush()
                part, ids, sizes, doc_ids, held = part + 1, [], [], [], 0
        if doc_ids:
            yield flush()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the shards under ``folder`` and return the manifest: ``shard, part, file, n_tokens, n_docs, start``."""
    spark = docs.sparkSession
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    rows = pick(docs, doc_id="long", text="string").withColumn("tie", F.xxhash64("text"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    ordered = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    manifest = staged(spark, ordered.select("doc_id", "text").mapInArrow(_write(f"{folder}/shards", tokenizer, end_id), _MANIFEST), f"{folder}/written")
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, 0)
    return staged(spark, manifest.withColumn("start", F.sum("n_tokens").over(before) - F.col("n_tokens")), f"{folder}/manifest")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = FileSystems()
        for rb in batches:
            for row in rb.to_pylist():
                fs, at = files.resolve(f"{folder}/{row['file']}")
                with fs.open_input_file(at) as f:
                    shard = Shard(f.read_buffer())
                if (shard.n_tokens, shard.n_docs) != (row["n_tokens"], row["n_docs"]):
                    raise OSError(f"{row['file']} is not what the manifest says")
                crcs = [zlib.crc32(ids) for ids in shard.documents()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64()), pa.array(row["start"] + shard.starts[:-1]),
                        pa.array(np.diff(shard.starts)), pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files that the manifest names."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(_read(f"{folder}/shards"), _RESULT)


def token_output(docs: DataFrame, tokenizer_path: str | None = None, folder: str | None = None) -> DataFrame:
    folder = folder or run_dir(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer_path)
    return read_tokens(docs.sparkSession, folder)


def q_op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))
