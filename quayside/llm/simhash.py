"""SimHash near-duplicates by anchor-point covering.

Fingerprint: majority of the bits of all shingles' XXH64 (seed 42). Two
fingerprints link when they differ in at most three bits, so in one of their
32-bit halves they differ in at most one. The anchors of a half are the words of
a perfect covering code, the (31, 26) Hamming code with one free bit: every half
has exactly one anchor within the covering radius 1. A fingerprint lives at that
anchor and is replicated to every anchor within covering radius plus threshold,
1 + 1 = 2 bits: 17 at most. If x and y link, y visits the anchor where x lives,
and they are compared there by the bits in which they differ.

Fingerprints are made distinct first (a group of exact copies is one of them).
An anchor where more than ``busy`` fingerprints live is split further: halves
apart, a link leaves one of the four bytes of the other half equal, so its
visitors are dealt by (byte number, byte) and compared there, which hands on
one link for each fingerprint and cluster instead of all pairs. No link is lost.

Nulls: a null text has no words; no words give fingerprint zero, linked like any
other. A null doc_id passes through, and is no candidate for a component's
smallest doc_id (a component of such rows alone has a null one). Repeated rows
share a component. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import pick, run_dir, staged, steps, table, text_bytes
from quayside.llm.components import components
from quayside.llm.names import unused

SEED = 42
#: Fingerprints that live at one anchor before it is split.
BUSY = 64

#: For each byte its eight bits, one in each byte of a 64-bit integer: sums of up to 255 of them count bits.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64).ravel()


def shingle_hashes(data: bytes, width: int = 3) -> list[int]:
    words = data.lower().split()
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < width:
        return [digest(join(words), SEED)] if words else []
    return [digest(join(s), SEED) for s in zip(*(words[k:] for k in range(width)))]


def majority(hashes: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """For each document's range of hashes, the bits set in over half of them."""
    out = np.zeros(len(offs) - 1, np.uint64)
    counts = np.diff(offs)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    parts = -(-counts[full] // 255)  # runs of at most 255 hashes
    first = np.concatenate(([0], np.cumsum(parts)))[:-1]
    run = np.arange(parts.sum()) - np.repeat(first, parts)
    cuts = np.repeat(offs[:-1][full], parts) + 255 * run
    data = hashes.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        runs = np.add.reduceat(_SPREAD[data[:, k]], cuts).view(np.uint8).reshape(-1, 8).astype(np.uint32)
        ones = np.add.reduceat(runs, first, axis=0)
        for bit in range(8):
            out[full] |= (2 * ones[:, bit] > counts[full]).astype(np.uint64) << np.uint64(8 * k + bit)
    return out


def _fingerprint(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in steps(batches):
            buf, offs = text_bytes(rb.column("text"))
            data = buf.tobytes()
            each = [np.array(shingle_hashes(data[a:b], width), np.uint64) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            at = np.concatenate(([0], np.cumsum([len(x) for x in each])))
            prints = majority(np.concatenate(each), at)
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), rb.column("text_hash"), pa.array(prints.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp``: the fingerprint as a signed long; doc_id and text_hash tell rows apart."""
    rows = pick(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(_fingerprint(width), "doc_id long, text_hash long, fp long")


# ---------------------------------------------------------------- anchors
def _syndromes(low: np.ndarray) -> np.ndarray:
    """Hamming (31, 26) syndrome of the low 31 bits: the XOR of the positions (1..31) of the ones."""
    s = np.zeros(len(low), np.uint64)
    for place in range(1, 32):
        s ^= ((low >> np.uint64(place - 1)) & np.uint64(1)) * np.uint64(place)
    return s


_BIT = np.array([0] + [1 << (p - 1) for p in range(1, 32)], np.uint64)  # of a position; none for 0
#: For each syndrome, the pairs of positions whose XOR it is.
_PAIRS = [np.array([(i, i ^ s) for i in range(1, 32) if i < i ^ s], np.int64).reshape(-1, 2) for s in range(32)]


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(index, anchor, lives)``: for 32-bit halves, all anchors within two bits; ``lives`` marks the one within the radius."""
    syn = _syndromes(half)
    own = half ^ _BIT[syn.astype(np.int64)]
    all_ = np.arange(len(half))
    index, anchor, lives = [all_, all_], [own, own ^ np.uint64(1 << 31)], [np.ones(len(half), bool), np.zeros(len(half), bool)]
    for s in range(1, 32):
        at = np.flatnonzero(syn == s)
        if len(at):
            flips = _BIT[_PAIRS[s][:, 0]] ^ _BIT[_PAIRS[s][:, 1]]
            flips = flips[flips != _BIT[s]]
            index.append(np.repeat(at, len(flips)))
            anchor.append((half[at][:, None] ^ flips[None, :]).ravel())
            lives.append(np.zeros(len(at) * len(flips), bool))
    return np.concatenate(index), np.concatenate(anchor), np.concatenate(lives)


def _visit(lives_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for a in range(0, rb.num_rows, 20_000):
                fp = rb.column("fp").slice(a, 20_000).to_numpy(zero_copy_only=False).view(np.uint64)
                for side in (0, 1):
                    half = (fp >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)
                    index, anchor, lives = anchors(half)
                    if lives_only:
                        index, anchor = index[lives], anchor[lives]
                    place = (anchor | np.uint64(side << 32)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(fp[index].view(np.int64))], names=["place", "fp"])

    return run


def _bits_apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _cluster(most: int):
    """Links of one dealt group, as spanning links: each fingerprint not yet reached opens a cluster
    and links to all others near it; one that was reached links on to those near it not yet reached."""

    def run(key, pdf):
        import pandas as pd

        fps = np.unique(pdf["fp"].to_numpy()).view(np.uint64)
        open_, links = np.ones(len(fps), bool), []
        while open_.any():
            queue = [int(np.flatnonzero(open_)[0])]
            open_[queue[0]] = False
            while queue:
                at = queue.pop()
                rest = np.flatnonzero(open_)
                hit = rest[np.bitwise_count(fps[rest] ^ fps[at]) <= most]
                open_[hit] = False
                queue.extend(hit.tolist())
                links.extend((fps[at], fps[x]) for x in hit)
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def links(spark: SparkSession, distinct: DataFrame, path: str, most: int = 3, busy: int = BUSY) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that join exactly those connected by steps of at
    most ``most`` (3) differing bits."""
    if not 0 <= most <= 3:
        raise ValueError("halves with threshold 1 cover distances up to 3")
    homes = staged(spark, distinct.mapInArrow(_visit(True), "place long, fp long"), f"{path}/homes")
    crowded = staged(spark, homes.groupBy("place").count().filter(F.col("count") > busy).select("place"), f"{path}/crowded")
    visits = distinct.mapInArrow(_visit(False), "place long, fp long").withColumnRenamed("fp", "other")
    calm = homes.join(crowded, "place", "left_anti")
    pairs = calm.join(visits, "place").filter((F.col("fp") != F.col("other")) & (_bits_apart("fp", "other") <= most))
    found = pairs.select(F.greatest("fp", "other").alias("a"), F.least("fp", "other").alias("b")).distinct()
    if not crowded.limit(1).count():
        return found
    other_half = F.when(F.col("place") < (1 << 32), F.shiftright("other", 32)).otherwise(F.col("other"))
    pieces = F.array(*[F.shiftright(other_half, 8 * k).bitwiseAND(F.lit(255)) for k in range(4)])
    dealt = visits.join(crowded, "place", "left_semi").select(
        "place", F.posexplode(pieces).alias("piece", "byte"), F.col("other").alias("fp")
    )
    return found.union(dealt.groupBy("place", "piece", "byte").applyInPandas(_cluster(most), "a long, b long"))


def _grouped(docs: DataFrame, width: int, most: int, busy: int, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' fingerprints, the distinct ones with their smallest doc_id, and the root of each linked one."""
    spark = docs.sparkSession
    prints = staged(spark, fingerprints(docs, width), f"{path}/prints")
    distinct = staged(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("least")), f"{path}/distinct")
    roots = components(spark, links(spark, distinct.select("fp"), f"{path}/links", most, busy), f"{path}/components")
    return prints, distinct, roots.select(F.col("node").alias("fp"), "root")


def simhash_groups(docs: DataFrame, width: int = 3, most: int = 3, busy: int = BUSY, path: str | None = None) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) ``, component_id``: the smallest doc_id reachable over links."""
    prints, distinct, roots = _grouped(docs, width, most, busy, path or run_dir(docs.sparkSession, "simhash"))
    linked = roots.join(distinct, "fp")
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = linked.select("fp", "root").join(named, "root").select("fp", "component_id")
    groups = distinct.join(groups, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return prints.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = 3, most: int = 3, busy: int = BUSY, path: str | None = None) -> DataFrame:
    """One document of each group, with all its columns: the smallest doc_id (null last), then text hash.
    Of rows equal in both, one stays."""
    spark = docs.sparkSession
    path = path or run_dir(spark, "simhash")
    prints, _, roots = _grouped(docs, width, most, busy, path)
    rows = prints.groupBy("fp", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "n")).alias("r")
    new = unused(docs, "keep_id", "keep_text", "keep_n", "share", "turn")
    chosen = [F.col(f"r.{c}").alias(new[k]) for k, c in (("keep_id", "doc_id"), ("keep_text", "text_hash"), ("keep_n", "n"))]
    keep = staged(spark, rows.groupBy("root").agg(first).select(*chosen), f"{path}/keep")
    same = F.col("`doc_id`").cast("long").eqNullSafe(F.col(new["keep_id"])) & (F.xxhash64(F.col("`text`").cast("string")) == F.col(new["keep_text"]))
    kept, n = docs.join(keep, same), F.col(new["keep_n"])
    names = [F.col(f"`{c}`") for c in docs.columns]
    if not keep.filter(n > 1).limit(1).count():
        return kept.select(*names)
    repeated = kept.filter(n > 1)
    for share in (F.pmod(F.monotonically_increasing_id(), F.lit(64)), F.lit(0)):  # one row may be a third of all: first one of each share
        repeated = repeated.withColumn(new["share"], share)
        one = F.row_number().over(Window.partitionBy(new["keep_id"], new["keep_text"], new["share"]).orderBy(F.lit(0)))
        repeated = repeated.withColumn(new["turn"], one).filter(F.col(new["turn"]) == 1).drop(new["turn"])
    return kept.filter(n == 1).select(*names).union(repeated.select(*names))


def q_op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
