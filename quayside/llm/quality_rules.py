"""Quality rules: base counts of each document and cross-document line frequency.

Lines are normalised (ASCII lower case, one space between words) and hashed; a
line held by more than ``max_docs`` documents of one host is removed from all of
them, and a document is rejected when what is left is depleted: less than
``min_left`` of its words, or fewer than ``min_words``. A document is a row of
the input; it counts once for a line it repeats.

One pass over the texts writes the counts and line hashes (a few per cent of the
text); line counts are pre-aggregated before their shuffle, and only lines above
the limit are joined back. A host or line that holds a third of all rows is
spread by the (host, line) key and by partial counts.

Nulls: a null text has no words (and fails the base rule), a null host is a host
of its own, a null doc_id passes through. Repeated rows are documents each by itself; a document with exactly
the limits stays. Very long texts are read whole. Empty tables give no rows. Of the input only the named columns
are read: others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import (
    SPACE, bounded_batches, covered, run_dir, staged, steps, sums, table, text_bytes, windows, word_hashes, word_spans, mix64,
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_WORD_CHAR = ~SPACE
_WORD_CHAR[0x80:0xC0] = False  # UTF-8 continuation bytes

_MEASURED = (
    "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<long>, line_words array<int>"
)


def repeated_words(hashes: np.ndarray, woff: np.ndarray, length: int) -> np.ndarray:
    """Words of windows that are found twice or more in their document."""
    pos, h = windows(hashes, woff, length)
    if not len(pos):
        return np.zeros(len(hashes), bool)
    doc = np.searchsorted(woff, pos, "right")
    h ^= mix64(doc.astype(np.uint64))
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(pos), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return covered(len(hashes), pos[twice], length)


def line_profile(data: bytes) -> tuple[list[int], list[int], int]:
    """Hashes and word counts of a text's normalised lines with words, and how many raw lines repeat an earlier one."""
    seen, hashes, words, dup = set(), [], [], 0
    for line in data.split(b"\n"):
        parts = line.lower().split()
        if not parts:
            continue
        if line in seen:
            dup += 1
        else:
            seen.add(line)
        h = xxhash.xxh64_intdigest(b" ".join(parts))
        hashes.append(h - (1 << 64) if h >> 63 else h)
        words.append(len(parts))
    return hashes, words, dup


def _measure(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in steps(batches):
            buf, offs = text_bytes(rb.column("text"))
            starts, ends, woff = word_spans(buf, offs)
            repeat = repeated_words(word_hashes(buf, starts, ends), woff, window)
            data = buf.tobytes()
            lines = [line_profile(data[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    rb.column("doc_id"), rb.column("host"), pa.array(np.diff(woff)),
                    pa.array(sums(_WORD_CHAR[buf], offs)), pa.array(sums(_SYMBOL[buf], offs)),
                    pa.array([x[2] for x in lines], pa.int64()), pa.array(sums(repeat, woff)),
                    pa.array([x[0] for x in lines], pa.list_(pa.int64())),
                    pa.array([x[1] for x in lines], pa.list_(pa.int32())),
                ],
                names=[x.split()[0] for x in _MEASURED.split(", ")],
            )

    return run


def measure(docs: DataFrame, host: str = "source", window: int = 8) -> DataFrame:
    """Base counts and line hashes of every document."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col("`doc_id`").cast("long").alias("doc_id"),
        F.col(f"`{host}`").cast("string").alias("host"),
        F.col("`text`").cast("string").alias("text"),
    )
    return rows.mapInArrow(_measure(window), _MEASURED)


def frequent_lines(measured: DataFrame, max_docs: int) -> DataFrame:
    """``host, line, n_docs`` of the lines in more than ``max_docs`` documents of a host."""
    return (
        measured.select("host", F.explode(F.array_distinct("lines")).alias("line"))
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") > max_docs)
    )


def quality_rules(
    docs: DataFrame, host: str = "source", max_docs: int = 50, min_left: float = 0.3, min_words: int = 20,
    window: int = 8, path: str | None = None,
) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``removed_words`` (in lines above the limit) and ``kept``."""
    spark = docs.sparkSession
    path = path or run_dir(spark, "rules")
    measured = staged(spark, measure(docs, host, window).withColumn("row", F.monotonically_increasing_id()), f"{path}/measured")
    frequent = staged(spark, frequent_lines(measured, max_docs), f"{path}/frequent")
    held = measured.select("row", F.col("host").alias("_host"), F.explode(F.arrays_zip("lines", "line_words")).alias("x")).select(
        "row", "_host", F.col("x.lines").alias("_line"), F.col("x.line_words").alias("words")
    )
    gone = held.join(frequent, held["_host"].eqNullSafe(frequent["host"]) & (held["_line"] == frequent["line"]), "left_semi")
    gone = gone.groupBy(F.col("row").alias("_row")).agg(F.sum("words").alias("removed"))
    left = F.col("n_words") - F.col("removed_words")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        measured.drop("lines", "line_words")
        .join(gone, F.col("row") == F.col("_row"), "left")
        .withColumn("removed_words", F.coalesce("removed", F.lit(0)).cast("long"))
        .withColumn("base_failed", base)
        .withColumn("kept", ~base & (left >= min_words) & (left >= min_left * F.col("n_words")))
        .drop("row", "_row", "removed")
    )


def q_op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"
    )


ORACLE_OP9 = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
places AS (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) >= 8),
wins AS (SELECT r, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS s FROM places),
twice AS (SELECT r, unnest(range(i, i + 8)) AS j FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM wins) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT j) AS n FROM twice GROUP BY r),
lines AS (
  SELECT r, source, line, regexp_extract_all(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS lw
  FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
frequent AS (
  SELECT source, x FROM (SELECT DISTINCT r, source, array_to_string(lw, ' ') AS x FROM lines)
  GROUP BY source, x HAVING count(*) > 50),
gone AS (
  SELECT r, CAST(sum(len(lw)) AS BIGINT) AS n FROM lines l JOIN frequent f
    ON array_to_string(l.lw, ' ') = f.x AND l.source IS NOT DISTINCT FROM f.source
  GROUP BY r),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS removed_words
  FROM docs LEFT JOIN repeats USING (r) LEFT JOIN dups USING (r) LEFT JOIN gone USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND n_words - removed_words >= 20 AND n_words - removed_words >= 0.3 * n_words AS kept
FROM judged"""
