"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Tokens are lower-cased runs of letters and digits. A document leaks an item when
some ``WINDOW`` (13) tokens of the item and as many of the document agree in at
least ``NEEDED`` (11) places: up to two substituted tokens in any window. Every
such window holds one of two spaced seeds without a substitution: masks of six
token positions that skip the others, whose two shapes together cover all pairs of
substituted places (``test_masks_cover_all_pairs_of_substitutions`` tries them all).
Seeds of the items are joined with those at every place of every document; the
tokens around each hit are cut out, and all windows that hold the seed are compared
token by token, in the same stage, so only verified hits are shuffled. Up to the cut
everything is one generated loop over a document's tokens: a token array is never
copied for a place, which would cost the square of a text's length.

The items' seeds are broadcast in blocks of at most ``BLOCK_SEEDS`` rows, counted
beforehand; a larger benchmark takes several passes. The documents never move.

Shorter items have windows as long as they are, and their own masks: of 8 to 12 tokens one may be substituted, so the
even or the odd places stand (``SHORT``); of fewer none may, and the mask is the whole run. A one-word item
therefore leaks wherever its word stands: ``min_tokens`` leaves such items out where that is not wanted (default 1: none).
In scripts without spaces (Han, kana, Thai, Lao, Khmer, Burmese) every character is a token.

Null and empty items have no tokens and leak nowhere. A null text has no tokens. Very long texts are searched whole. Items that
share a seed and the tokens around it are one row of the join. Rows that share a key count as one.
Empty tables give no rows. Columns of any other name may be there, ``clean`` returns them unchanged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import run_dir, staged, table
from quayside.llm.names import unused

WINDOW = 13
NEEDED = 11
#: Items of so many tokens, and fewer than WINDOW, may have one substituted token.
SHORT = 8
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
BLOCK_SEEDS = 100_000
#: Tokens that a window can have before its seed.
_BEFORE = WINDOW - 1 - min(m[-1] for m in MASKS)

_GAP = "[^\\p{L}\\p{N}]+"
#: Characters of scripts without spaces; the range is tried first, as it is far cheaper to leave by than the scripts.
_UNSPACED = "([\\x{0E00}-\\x{3FFFF}&&[\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}]])"


def tokens(text: Column) -> Column:
    text = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _UNSPACED, " $1 ")
    return F.split(F.regexp_replace(text, f"^{_GAP}|{_GAP}$", ""), _GAP)


def needed(n: int) -> int:
    """Equal tokens that a window of n tokens (at most ``WINDOW``) must have."""
    return NEEDED if n >= WINDOW else n - 1 if n >= SHORT else n


def short_masks(n: int) -> list[tuple[tuple[int, ...], int]]:
    """Masks of an item of n tokens, fewer than ``WINDOW``, from their first place on, and that place."""
    if n < SHORT:
        return [(tuple(range(n)), 0)]
    return [(tuple(range(0, n - first, 2)), first) for first in (0, 1)]


def _seed(mask: tuple[int, ...], array: str, at: Column) -> Column:
    """Hash of the tokens that the mask looks at; its shape goes into the hash."""
    return F.xxhash64(F.lit(str(mask)), *[F.get(F.col(array), at + k) for k in mask])


def item_seeds(benchmark: DataFrame, path: str, min_tokens: int = 1) -> DataFrame:
    """``key, back, around, window, needed, items``: a seed, the items' tokens in the windows that can
    hold it, how many of these tokens stand before the seed, and all items that have them."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("`item_id`").cast("long").alias("item_id"), tokens(F.col("`text`").cast("string")).alias("t"))
    items = items.withColumn("n", F.size("t")).filter((F.col("n") >= min_tokens) & (F.get("t", F.lit(0)) != ""))
    items = staged(spark, items, f"{path}/items")
    parts = []
    for mask in MASKS:
        at = items.filter(F.col("n") >= WINDOW).select("*", F.explode(F.sequence(F.lit(0), F.col("n") - mask[-1] - 1)).alias("at"))
        reach = WINDOW - mask[-1] - 1
        lo = F.greatest(F.lit(0), F.col("at") - reach)
        parts.append(at.select(
            _seed(mask, "t", F.col("at")).alias("key"), "item_id", (F.col("at") - lo).alias("back"),
            F.slice("t", lo + 1, F.col("at") + WINDOW - lo).alias("around"),
            F.lit(WINDOW).alias("window"), F.lit(NEEDED).alias("needed"),
        ))
    for n in range(max(1, min_tokens), WINDOW):
        for mask, first in short_masks(n):
            parts.append(items.filter(F.col("n") == n).select(
                _seed(mask, "t", F.lit(first)).alias("key"), "item_id", F.lit(first).alias("back"),
                F.col("t").alias("around"), F.lit(n).alias("window"), F.lit(needed(n)).alias("needed"),
            ))
    seeds = reduce(DataFrame.union, parts).groupBy("key", "back", "around", "window", "needed")
    return staged(spark, seeds.agg(F.collect_list(F.struct("item_id")).alias("items")), f"{path}/seeds")


def _verified(hits: DataFrame) -> DataFrame:
    """``best`` of each hit: the window with the most equal tokens, where it has enough. A generator, as
    a filter would become part of the join, for which the hits' tokens are not yet cut out."""
    agree = F.transform("around", lambda x, j: F.when(F.get(F.col("near"), j + _BEFORE - F.col("back")) == x, 1).otherwise(0))
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, b: a + b)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("agree") - F.col("window")),
        lambda s: F.struct(
            add(F.slice(F.col("agree"), s + 1, F.col("window"))).alias("n_equal"),
            (F.col("back") - F.col("at") - s).alias("minus_start"),
        ),
    )
    enough = F.filter(F.array(F.array_max(windows)), lambda w: w["n_equal"] >= F.col("needed"))
    scored = hits.select("*", F.explode(F.array(agree)).alias("agree"))
    return scored.withColumn("best", F.explode(enough))


def leaks(
    docs: DataFrame, benchmark: DataFrame, keys: tuple[str, ...] = ("doc_id",), path: str | None = None, min_tokens: int = 1
) -> DataFrame:
    """``keys.., item_id, n_equal, window, first_token``: the best window of each leaked item and the
    document token where it starts (the earliest of equals)."""
    spark = docs.sparkSession
    path = path or run_dir(spark, "leaks")
    seeds = item_seeds(benchmark, path, min_tokens)
    by_window = {r["window"]: r["n"] for r in seeds.groupBy("window").agg(F.count(F.lit(1)).alias("n")).collect()}
    masks = sorted({*(MASKS if WINDOW in by_window else ()), *(m for n in by_window if n < WINDOW for m, _ in short_masks(n))})
    passes = max(1, -(-sum(by_window.values()) // BLOCK_SEEDS))
    named = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    own = [f"_key{i}" for i in range(len(keys))]
    texts = docs.select(*named, tokens(F.col("`text`").cast("string")).alias("t"))
    places = texts.select(*own, "t", F.explode(F.sequence(F.lit(0), F.size("t") - 1)).alias("at")) if masks else None
    found = []
    for p in range(passes if masks else 0):
        block = F.broadcast(seeds.filter(F.pmod("key", F.lit(passes)) == p) if passes > 1 else seeds)
        keyed = places.select(*own, "t", "at", F.explode(F.array(*[_seed(m, "t", F.col("at")) for m in masks])).alias("key"))
        hits = keyed.join(block, "key").select(
            *own, "items", "at", "back", "around", "window", "needed",
            F.array(*[F.get(F.col("t"), F.col("at") + k) for k in range(-_BEFORE, WINDOW)]).alias("near"),
        )
        found.append(_verified(hits).select(*own, F.explode("items.item_id").alias("item_id"), "best", "window"))
    if not found:
        found = [texts.select(*own, F.lit(0).cast("long").alias("item_id")).filter(F.lit(False)).select(
            "*", F.lit(None).cast("struct<n_equal:int,minus_start:int>").alias("best"), F.lit(0).alias("window"))]
    out = reduce(DataFrame.union, found).groupBy(*own, "item_id").agg(F.max(F.struct("best", "window")).alias("b"))
    return out.select(
        *[F.col(o).alias(k) for o, k in zip(own, keys)], "item_id", F.col("b.best.n_equal").alias("n_equal"), F.col("b.window").alias("window"),
        (-F.col("b.best.minus_start")).alias("first_token"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, path: str | None = None) -> DataFrame:
    """The documents that leak nothing, with all their columns. Rows are told apart by doc_id and text."""
    new = unused(docs, "id", "hash", "bad_id", "bad_hash")
    named = docs.select("*", F.col("`doc_id`").alias(new["id"]), F.xxhash64(F.col("`text`").cast("string")).alias(new["hash"]))
    path = path or run_dir(docs.sparkSession, "leaks")
    bad = leaks(named, benchmark, (new["id"], new["hash"]), path)
    bad = bad.select(F.col(new["id"]).alias(new["bad_id"]), F.col(new["hash"]).alias(new["bad_hash"])).distinct()
    bad = staged(docs.sparkSession, bad, f"{path}/bad")  # its size is known before the documents are read again
    same = F.col(new["id"]).eqNullSafe(F.col(new["bad_id"])) & (F.col(new["hash"]) == F.col(new["bad_hash"]))
    return named.join(bad, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def q_op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
