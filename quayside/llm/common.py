"""Helpers shared by the operators of this subpackage.

Words are the maximal runs of bytes other than ASCII white space
(``[^\\x20\\x09-\\x0D]+`` over UTF-8). Texts stay in their Arrow buffers: a
batch is one byte array with document offsets, and words, hashes and windows
are numpy arrays over it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import new_run_dir

#: Text bytes that one step inside a task works on at a time (a longer document is a step of its own).
STEP_BYTES = 4 << 20

#: Rows of an Arrow batch.
BATCH_ROWS = 1_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_RNG = np.random.default_rng(20_240_229)
_BYTE_CODES = [_RNG.integers(0, 2**64, 256, dtype=np.uint64) for _ in _BASES]
_CHUNK = 1 << 19
_powers: dict[int, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts go to the tasks' Python in batches of at most BATCH_ROWS rows; a batch is held several
    times over (JVM, pipe, Python), so the session's default of 10,000 rows is too many for long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def pick(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast: other columns of the input cannot clash with what an operator adds."""
    bounded_batches(df.sparkSession)
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()])


def staged(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_dir(spark: SparkSession, label: str) -> str:
    return new_run_dir(spark, f"llm-{label}")


# ---------------------------------------------------------------- batches
def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, document offsets)`` of a string column; a null is an empty text."""
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``size`` text bytes (one row at least)."""
    for rb in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(rb.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < rb.num_rows:
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
            yield rb.slice(a, b - a)
            a = b


# ---------------------------------------------------------------- words
def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each document the number of words before it."""
    if not buf.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    on = ~SPACE[buf]
    first, last = on.copy(), on.copy()
    first[1:] &= ~on[:-1]
    last[:-1] &= ~on[1:]
    cuts = offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < buf.size)]
    first[cuts] = on[cuts]
    last[cuts - 1] = on[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        p = np.full(max(n, _CHUNK + 1), base, np.uint64)
        p[0] = 1
        _powers[base] = np.cumprod(p, dtype=np.uint64)
    return _powers[base][:n]


def _range_sums(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """sum of values[i] * base**(i - start) over each range, modulo 2**64."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * _power(pow(base, -1, 1 << 64), len(values) + 1)[starts]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``which`` chooses one of two independent ones."""
    out, a = np.empty(len(starts), np.uint64), 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + _CHUNK)))
        lo, hi = starts[a], ends[b - 1]
        s, e = starts[a:b] - lo, ends[a:b] - lo
        h = _range_sums(_BYTE_CODES[which][buf[lo:hi]], _BASES[which], s, e)
        out[a:b] = mix64(h + (e - s).astype(np.uint64))
        a = b
    return out


def windows(hashes: np.ndarray, woff: np.ndarray, length: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions (over the batch's words) of all windows of ``length`` words that stay
    within one document, and their 64-bit hashes."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = np.ones(n, bool)
    for back in range(1, length):
        at = woff[1:] - back
        ok[at[at >= woff[:-1]]] = False
    pos = np.flatnonzero(ok[: n - length + 1])
    out, base = np.empty(len(pos), np.uint64), _BASES[1 - which]
    for a in range(0, len(pos), _CHUNK):
        p = pos[a : a + _CHUNK]
        lo = p[0]
        h = _range_sums(hashes[lo : p[-1] + length], base, p - lo, p - lo + length)
        out[a : a + _CHUNK] = mix64(h)
    return pos, out


def covered(n: int, pos: np.ndarray, length: int) -> np.ndarray:
    """Which of n words lie in one of the windows that start at ``pos``."""
    if not len(pos):
        return np.zeros(n, bool)
    change = np.bincount(pos, minlength=n + 1) - np.bincount(pos + length, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` within each document's range."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[offs[1:]] - c[offs[:-1]]

