"""Best-fit packing of token pieces by exact complements.

Documents become token ids with an end id; one longer than a sequence is cut into full pieces, the first of them
the shorter. Which sequences to make depends on nothing but how many pieces there are of each length, at most
``CAPACITY`` counts, so that is all the driver sees:

1. One pass over the texts encodes them, and notes for each piece how many of its length its task had before.
2. ``plan`` packs the counts. From the longest length down it opens a sequence and looks up, in tables by sum
   (direct-address hash tables), a single length, a pair or a triple that fills the gap exactly and is available;
   where there is none, the longest length that fits goes in and the gap is looked up again. The pattern found is
   consumed as often as its availability counts allow. Singles are tried for all lengths first, then pairs, then
   triples; what comes to no exact end is packed by best fit. (Should best fit alone need fewer sequences, as it can with few
   pieces of each length, it is taken.)
3. A piece's rank among all pieces of its length is its number in its task and the count of earlier tasks;
   ranks are dealt to the pattern's places by binary search. Neither a frequent length nor copies meet in one task: the
   pieces are joined with counts by (task, length), never ordered.

A pattern leaves at least one of its lengths with fewer pieces than it takes, so the plan has at most about
``CAPACITY * ln(CAPACITY)`` rows, whatever the input; it is broadcast.

Nulls: a null text counts as empty, its piece is the end id; a null doc_id stays null. Repeated rows are packed each
by itself, very long texts are cut as any other, empty tables give no pieces. Pieces of equal length are
interchangeable: which one goes where depends on the partitioning, the number of sequences does not. Of the input only doc_id
and text are read: other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import pick, run_dir, staged, steps, table, text_bytes
from quayside.llm.word_ids import SpacedWordIds, remembered

CAPACITY = 2048
END_ID = 0

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- the plan
class Complements:
    """Counts of the lengths at hand, and tables by sum of the single lengths and pairs that make it."""

    def __init__(self, counts: np.ndarray):
        self.free, self.one = counts.astype(np.int64), np.zeros(len(counts), bool)
        self.pairs = np.zeros(len(counts), np.int64)  # ordered pairs of two different lengths, by their sum
        for x in np.flatnonzero(self.free):
            self._switch(int(x), True)

    def _switch(self, x: int, on: bool) -> None:
        others = self.one[: len(self.one) - x].copy()
        if x < len(others):
            others[x] = False
        self.pairs[x:][others] += 2 if on else -2
        self.one[x] = on

    def put(self, x: int, n: int) -> None:
        """n more (fewer, if negative) of length x."""
        was, self.free[x] = self.free[x], self.free[x] + n
        if (was > 0) != (self.free[x] > 0):
            self._switch(x, was == 0)

    def longest(self, gap: int) -> int:
        """The longest length at hand that fits, 0 if none does."""
        found = np.flatnonzero(self.one[: gap + 1])
        return int(found[-1]) if len(found) else 0

    def pair(self, gap: int) -> list[int] | None:
        if gap < 2 or not (self.pairs[gap] or (gap % 2 == 0 and self.free[gap // 2] > 1)):
            return None
        if gap % 2 == 0 and self.free[gap // 2] > 1 and not self.pairs[gap]:
            return [gap // 2] * 2
        both = self.one[1:gap] & self.one[gap - 1 : 0 : -1]
        if gap % 2 == 0:
            both[gap // 2 - 1] = False
        a = int(np.flatnonzero(both)[-1]) + 1
        return [a, gap - a]

    def triple(self, gap: int) -> list[int] | None:
        if gap < 3:
            return None
        third = np.arange(gap - 1)
        rest = gap - third
        even = (rest % 2 == 0) & (self.free[rest // 2] > 1)
        for x in np.flatnonzero(self.one[: gap - 1] & ((self.pairs[rest] > 0) | even))[::-1].tolist():
            self.put(x, -1)
            two = self.pair(gap - x)
            self.put(x, 1)
            if two:
                return [x, *two]
        return None

    def filling(self, gap: int, most: int) -> list[int] | None:
        """One to ``most`` (three) lengths at hand that make exactly ``gap``."""
        if self.one[gap]:
            return [gap]
        return (most > 1 and self.pair(gap)) or (most > 2 and self.triple(gap)) or None


Pattern = tuple[tuple[int, int], ...]


def plan(counts: np.ndarray) -> list[tuple[Pattern, int]]:
    """``(((length, times), ...), sequences)`` that hold all pieces; ``counts[x]`` pieces have length x, at most ``len(counts) - 1``."""
    capacity, at_hand, out = len(counts) - 1, Complements(counts), []
    for most in (1, 2, 3):  # what one length completes need not cost two short ones
        first = capacity
        while first := at_hand.longest(first):
            pattern, gap = [], capacity
            take: list[int] | None = [first]
            while take:
                for x in take:
                    at_hand.put(x, -1)
                pattern += take
                gap -= sum(take)
                take = gap and (at_hand.filling(gap, most) or [x for x in [at_hand.longest(gap)] if x])
            for x in pattern:
                at_hand.put(x, 1)
            if gap:
                first -= 1
                continue
            need = tuple(sorted(Counter(pattern).items(), reverse=True))
            times = min(int(at_hand.free[x]) // k for x, k in need)
            for x, k in need:
                at_hand.put(x, -k * times)
            out.append((need, times))
    # with few pieces of each length, those left over may fit each other worse than all pieces do
    return min(out + best_fit(at_hand.free), best_fit(counts), key=lambda entries: sum(n for _, n in entries))


def best_fit(counts: np.ndarray) -> list[tuple[Pattern, int]]:
    """The longest first, each into the fullest sequence that has room; equal sequences are one entry."""
    capacity = len(counts) - 1
    open_: list[Counter] = [Counter() for _ in range(capacity + 1)]  # by room left: how many of each pattern
    room = np.zeros(capacity + 1, bool)

    def move(to: int, pattern: Pattern, n: int) -> None:
        if n:
            open_[to][pattern] += n
            room[to] = True

    for x in range(capacity, 0, -1):
        left = int(counts[x])
        while left:
            fits = np.flatnonzero(room[x:])
            if not len(fits):
                each = capacity // x
                move(capacity - each * x, ((x, each),), left // each)
                if left % each:
                    move(capacity - left % each * x, ((x, left % each),), 1)
                break
            gap = x + int(fits[0])
            pattern, n = open_[gap].popitem()
            each = min(gap // x, left)
            some = min(n, left // each)
            move(gap - each * x, (*pattern, (x, each)), some)
            if n > some:
                open_[gap][pattern] = n - some
            room[gap] = bool(open_[gap])
            left -= each * some
    return [entry for group in open_ for entry in group.items()]


def places(entries: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows ``length, first rank, times, first sequence, offset``, sorted: a piece of this length and of rank r, counted from
    the row's first rank, is in sequence ``first + r // times`` at ``offset + r % times * length``."""
    rows, used, sequence = [], Counter(), 0
    for pattern, n in entries:
        offset = 0
        for x, times in pattern:
            rows.append((x, used[x], times, sequence, offset))
            used[x] += times * n
            offset += x * times
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# ---------------------------------------------------------------- Spark jobs
def _pieces(tokenizer, end_id: int, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, seen = remembered(SpacedWordIds, tokenizer.value, end_id), TaskContext.get().partitionId(), Counter()
        for rb in steps(batches):
            buf, offs = text_bytes(rb.column("text"))
            ids, starts = words.ids(buf.tobytes(), offs.tolist())
            data, rows = memoryview(ids).cast("B"), []
            for doc_id, a, b in zip(rb.column("doc_id").to_pylist(), starts.tolist(), starts[1:].tolist()):
                start, end = a, a + ((b - a - 1) % capacity + 1)
                for piece in range(-(-(b - a) // capacity)):
                    x = end - start
                    part = data[4 * start : 4 * end]
                    rows.append((doc_id, piece, start - a, x, zlib.crc32(part), task, seen[x], *([bytes(part)] if keep_ids else [])))
                    seen[x] += 1
                    start, end = end, end + capacity
            names = [c.split()[0] for c in _PIECES.split(", ")] + ["ids"] * keep_ids
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def _place(table_, extra: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table_.value
        keys = (rows[:, 0] << 48) + rows[:, 1]
        for rb in batches:
            if not rb.num_rows:
                continue
            length, rank = (rb.column(c).to_numpy() for c in ("length", "rank"))
            row = rows[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            nth = rank - row[:, 1]
            placed = [pa.array(row[:, 3] + nth // row[:, 2]), pa.array(row[:, 4] + nth % row[:, 2] * length)]
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            more = ["ids"] if extra else []
            yield pa.RecordBatch.from_arrays([rb.column(c) for c in kept] + placed + [rb.column(c) for c in more], names=[*kept, "sequence_id", "offset", *more])

    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, keep_ids: bool = False, folder: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece; with ``keep_ids`` also ``ids``
    (little-endian 32-bit integers), of which ``sequences`` makes the training rows."""
    spark = docs.sparkSession
    path = folder or run_dir(spark, "packing")
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    extra = ", ids binary" if keep_ids else ""
    rows = pick(docs, doc_id="long", text="string")
    pieces = staged(spark, rows.mapInArrow(_pieces(tokenizer, end_id, capacity, keep_ids), _PIECES + extra), f"{path}/pieces")
    sizes = staged(spark, pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), f"{path}/sizes")
    counts = np.zeros(capacity + 1, np.int64)
    for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    table_ = spark.sparkContext.broadcast(places(plan(counts)))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = sizes.select("length", "task", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    return ranked.mapInArrow(_place(table_, keep_ids), _PACKED + extra)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids`` of the pieces of ``pack(..., keep_ids=True)``, end to end."""
    runs = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("run"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate("run.ids", F.lit(b""), lambda a, b: F.concat(a, b))
    return runs.select("sequence_id", "n_tokens", joined.alias("ids"))


def q_op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
