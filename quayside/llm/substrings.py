"""Substring dedup by level-wise doubling.

Word windows that repeat are found at one length, and only where two of them
adjoin or overlap to twice that length is the longer window looked at: lengths
``window / 2**k .. window``, ending early when no candidate is left. At the full
length every window that also starts earlier (smaller doc_id, or same document
and earlier start) is dropped: its words are removed.

The texts are written once, in blocks, to a table bucketed by block, so no later
step shuffles a text. For each level a block sends its distinct window hashes to
hash buckets, 4 bytes each, with a flag for those it holds twice; a bucket
answers one bit a hash. Whatever a block holds often it sends once, so a window
that makes up a third of the corpus is one entry for each block. Short hashes only
choose candidates; the last level compares 64 bits within a bucket chosen by
an independent 64-bit hash, and blocks send the first holder of each window.

Nulls: a null text has no words. Rows with a null doc_id come after all others.
Rows that share a doc_id count as separate documents in the order of their
blocks, so of two equal rows one keeps its words. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from quayside.llm.common import (
    covered, pick, run_dir, steps, table, text_bytes, windows, word_hashes, word_spans,
)

#: Text bytes of a block, and those whose windows one bucket gets.
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
_LAST = np.iinfo(np.int64).max

_REQUEST = "bucket int, block long, hashes binary, twice binary, docs binary, runs binary"
_REPLY = "block long, level int, bucket int, bits binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def lengths(window: int, start: int = 10) -> list[int]:
    """Window lengths, each at most twice the one before."""
    out = [window]
    while out[0] > start:
        out.insert(0, -(-out[0] // 2))
    return out


# ---------------------------------------------------------------- blocks
def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, block, held, row = TaskContext.get().partitionId(), 0, 0, 0
    for rb in steps(batches, size=BLOCK_BYTES // 4):
        size = pc.sum(pc.binary_length(rb.column("text"))).as_py() or 0
        if held and held + size > BLOCK_BYTES:
            block, held, row = block + 1, 0, 0
        n, held = rb.num_rows, held + size
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, (part << 32) | block)), pa.array(np.arange(row, row + n)), rb.column("doc_id"), rb.column("text")],
            names=["block", "row", "doc_id", "text"],
        )
        row += n


def blocked(docs: DataFrame, path: str) -> DataFrame:
    """The texts in a table bucketed by block of about BLOCK_BYTES."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id="long", text="string")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    name = "llm_blocks_" + path.rstrip("/").rsplit("-", 1)[-1]
    (
        rows.mapInArrow(_blocks, "block long, row long, doc_id long, text string")
        .write.bucketBy(n, "block").option("path", f"{path}/blocks").option("compression", "zstd").saveAsTable(name)
    )
    return spark.table(name)


class _Block:
    """The words of a block in the order (doc_id, row), and its windows level by level."""

    def __init__(self, rows: pa.Table, levels: list[int], buckets: int):
        self.levels, self.buckets = levels, buckets
        rows = rows.sort_by([("doc_id", "ascending"), ("row", "ascending")]).combine_chunks()
        ids = rows.column("doc_id").combine_chunks()
        self.doc_ids, self.doc_key = ids, pc.fill_null(ids, _LAST).to_numpy(zero_copy_only=False)
        text = rows.column("text")
        text = text.combine_chunks() if text.num_chunks != 1 else text.chunk(0)
        self.buf, offs = text_bytes(text)
        self.starts, self.ends, self.woff = word_spans(self.buf, offs)
        self.words = [word_hashes(self.buf, self.starts, self.ends, which) for which in (0, 1)]

    def entries(self, k: int, candidates: np.ndarray | None):
        """Of level k: its windows' positions, for each the index of its entry, the entries' buckets and
        values, the position of each entry's first window, and how many windows it has."""
        length, last = self.levels[k], k + 1 == len(self.levels)
        pos, h = windows(self.words[0], self.woff, length, 0)
        if candidates is not None:
            keep = candidates[pos]
            pos, h = pos[keep], h[keep]
        bucket = ((h >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int32)
        value = h & np.uint64(0xFFFFFFFF)
        if last:
            at, other = windows(self.words[1], self.woff, length, 1)
            value = other[np.searchsorted(at, pos)]
        order = np.lexsort((value, bucket))  # stable: by position within equal windows
        new = np.ones(len(pos), bool)
        new[1:] = (value[order[1:]] != value[order[:-1]]) | (bucket[order[1:]] != bucket[order[:-1]])
        entry = np.empty(len(pos), np.int64)
        entry[order] = np.cumsum(new) - 1
        first = order[new]
        if last:  # by bucket and position, so that the documents come in runs
            again = np.lexsort((first, bucket[first]))
            rank = np.empty(len(first), np.int64)
            rank[again] = np.arange(len(first))
            entry, first = rank[entry], first[again]
        return pos, entry, bucket[first], value[first], first, np.bincount(entry, minlength=len(first))

    def request(self, k: int, candidates: np.ndarray | None, block: int) -> pa.Table:
        pos, _, bucket, value, first, count = self.entries(k, candidates)
        last, rows = k + 1 == len(self.levels), {x: [] for x in ("bucket", "block", "hashes", "twice", "docs", "runs")}
        doc = self.doc_key[np.searchsorted(self.woff, pos[first], "right") - 1] if last else None
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
            rows["bucket"].append(int(bucket[a]))
            rows["block"].append(block)
            rows["hashes"].append(value[a:b].astype(np.uint64 if last else np.uint32).tobytes())
            rows["twice"].append(None if last else np.packbits(count[a:b] > 1).tobytes())
            at = np.flatnonzero(np.diff(doc[a:b], prepend=doc[a] - 1)) if last else None
            rows["docs"].append(doc[a:b][at].tobytes() if last else None)
            rows["runs"].append(np.diff(at, append=b - a).astype(np.uint32).tobytes() if last else None)
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(rows.items(), kinds)})

    def answered(self, k: int, candidates: np.ndarray | None, replies: dict):
        """Positions of level k's windows, their entries, first windows and each entry's bit."""
        pos, entry, bucket, _, first, _ = self.entries(k, candidates)
        bits = np.zeros(len(bucket), bool)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
            bits[a:b] = np.unpackbits(np.frombuffer(replies[k, int(bucket[a])], np.uint8), count=b - a)
        return pos, entry, first, bits

    def candidates(self, k: int, replies: dict) -> np.ndarray | None:
        """Word positions where a window of level k may repeat, after the answers to all shorter levels."""
        found = None
        for j in range(k):
            pos, entry, _, bits = self.answered(j, found, replies)
            repeats = np.zeros(len(self.starts) + 1, bool)
            repeats[pos[bits[entry]]] = True
            shift = self.levels[j + 1] - self.levels[j]
            found = np.zeros(len(repeats), bool)
            found[: len(repeats) - shift] = repeats[: len(repeats) - shift] & repeats[shift:]
        return found


def _replies(rows: pa.Table) -> dict:
    return {(k, b): bits for k, b, bits in zip(*(rows.column(c).to_pylist() for c in ("level", "bucket", "bits")))}


# ---------------------------------------------------------------- levels
def _ask(levels: list[int], k: int, buckets: int):
    def alone(key, rows):
        return _Block(rows, levels, buckets).request(0, None, key[0].as_py())

    def after(key, rows, replies):
        block = _Block(rows, levels, buckets)
        return block.request(k, block.candidates(k, _replies(replies)), key[0].as_py())

    return after if k else alone


def _answer(k: int, last: bool):
    def run(key, rows):
        bucket, blocks = key[0].as_py(), rows.column("block").to_pylist()
        values = [np.frombuffer(x.as_py(), np.uint64 if last else np.uint32) for x in rows.column("hashes")]
        sizes = [len(v) for v in values]
        all_ = np.concatenate(values)
        if last:
            doc = np.concatenate([
                np.repeat(np.frombuffer(d.as_py(), np.int64), np.frombuffer(r.as_py(), np.uint32))
                for d, r in zip(rows.column("docs"), rows.column("runs"))
            ])
            order = np.lexsort((np.repeat(np.array(blocks), sizes), doc, all_))
            bit = np.ones(len(all_), bool)
            bit[order[1:]] = all_[order[1:]] != all_[order[:-1]]  # the first to hold it
        else:
            twice = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=n) for x, n in zip(rows.column("twice"), sizes)])
            order = np.argsort(all_)
            same = all_[order[1:]] == all_[order[:-1]]
            cut = np.flatnonzero(np.concatenate(([True], ~same)))
            many = np.diff(cut, append=len(all_)) > 1
            many |= np.maximum.reduceat(twice[order], cut) > 0
            bit = np.empty(len(all_), bool)
            bit[order] = np.repeat(many, np.diff(cut, append=len(all_)))
        ends = np.cumsum(sizes)
        bits = [np.packbits(bit[e - n : e]).tobytes() for e, n in zip(ends, sizes)]
        n = len(blocks)
        return pa.table({
            "block": pa.array(blocks, pa.int64()), "level": pa.array([k] * n, pa.int32()),
            "bucket": pa.array([bucket] * n, pa.int32()), "bits": pa.array(bits, pa.binary()),
        })

    return run


def _finish(levels: list[int], buckets: int, last: int):
    def run(key, rows, replies):
        block, replies = _Block(rows, levels, buckets), _replies(replies)
        gone = np.zeros(len(block.starts), bool)
        if last + 1 == len(levels):
            pos, entry, first, wins = block.answered(last, block.candidates(last, replies), replies)
            keeps = np.zeros(len(pos), bool)
            keeps[first[wins]] = True
            gone = covered(len(block.starts), pos[~keeps], levels[last])
        data, woff = block.buf.tobytes(), block.woff
        keep, shas, removed = ~gone, [], []
        for a, b in zip(woff[:-1].tolist(), woff[1:].tolist()):
            kept = np.flatnonzero(keep[a:b]) + a
            removed.append(b - a - len(kept))
            words = [data[s:e] for s, e in zip(block.starts[kept].tolist(), block.ends[kept].tolist())]
            shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
        return pa.table({
            "doc_id": block.doc_ids.cast(pa.int64()), "n_words": pa.array(np.diff(woff), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string()),
        })

    return run


def substring_dedup(docs: DataFrame, window: int = 20, start: int = 10, path: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (of the kept words, one space between) of every document."""
    spark = docs.sparkSession
    path = path or run_dir(spark, "substrings")
    texts, levels = blocked(docs, path), lengths(window, start)
    n_blocks = texts.select("block").distinct().count()
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), n_blocks * BLOCK_BYTES // BUCKET_BYTES)
    answers, last = None, -1
    for k in range(len(levels)):
        by_block = texts.groupBy("block")
        ask = _ask(levels, k, buckets)
        asked = by_block.cogroup(answers.groupBy("block")).applyInArrow(ask, _REQUEST) if k else by_block.applyInArrow(ask, _REQUEST)
        reply = asked.groupBy("bucket").applyInArrow(_answer(k, k + 1 == len(levels)), _REPLY)
        reply.write.parquet(f"{path}/level-{k}")
        now = spark.read.parquet(f"{path}/level-{k}")
        if not now.limit(1).count():
            break
        answers, last = now if answers is None else answers.union(now), k
    if answers is None:
        answers = spark.createDataFrame([], _REPLY)
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_finish(levels, buckets, last), _RESULT)


def q_op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


ORACLE_OP2 = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20),
wins AS (SELECT doc_id, i, list_aggregate(w[i:i + 19], 'string_agg', ' ') AS s FROM places),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM wins),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM ranked WHERE r > 1),
gone_list AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
kept AS (
  SELECT words.doc_id, len(w) AS n, coalesce(len(g), 0) AS n_removed,
         CASE WHEN g IS NULL THEN w ELSE [w[j] FOR j IN range(1, len(w) + 1) IF NOT list_contains(g, j)] END AS k
  FROM words LEFT JOIN gone_list USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept"""
