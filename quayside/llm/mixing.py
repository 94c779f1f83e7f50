"""Mixing sources to target weights by hash-threshold histograms.

Every source gets a target number of words from its weight; documents are
taken whole. A target of ``k`` times its source and a remainder takes each
document ``k`` times, and once more those whose hash lies under a threshold
that spends the remainder. The threshold comes from histograms: words by
(source, hash bucket), the buckets that fit the remainder are nested inside it,
and only the bucket at its boundary is split again by the next bits of the hash.
Nothing is sorted; the choice depends on ``doc_id`` and ``seed`` alone.

The threshold ends at the first document that overspends the remainder. With ``fill``, as in the
query and the pipeline, documents that do not fit are stepped over and later ones go on
spending what is left, until nothing that fits is left out. What is left only shrinks, so of the
documents of one size those taken are the first by hash, at most ``left / size`` of them. That bounds what
one task has to walk through for a source by ``left * ln(left)`` rows, with ``left`` less than the words of the document that
did not fit, however many documents the source has.

Nulls: a null text has size 0, a null source is a source of its own (last), a
null doc_id hashes like the empty string. Rows of one doc_id share a hash and are
taken together. Zero-size documents are taken 0 times. An empty table gives none.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import pick, run_dir, staged
from quayside.llm.names import unused

WORD_GAP = "[\\x20\\x09-\\x0D]+"
HASH_BITS = 60
LEVEL_BITS = 12


def n_words(text: str | Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0."""
    body = F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.coalesce(body, F.lit("")) == "", 0).otherwise(F.size(F.split(body, WORD_GAP, -1))).cast("long")


def doc_hash(doc_id: str, seed: str) -> Column:
    """60 bits of an MD5, the same in any engine."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, cycle: int = 3, cap: int = 3) -> DataFrame:
    """One row per source: ``source_size`` and ``target``. Weights 1..cycle repeat over the
    sources by code point (null last); no target exceeds ``cap`` times its source, what it
    gives up is shared again by weight (water-filling: with sources in ascending order of
    cap / weight, the first that stays under its cap fixes the words a unit of weight gets)."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    src = src.withColumn("weight", (F.row_number().over(by_name) - 1) % cycle + 1)
    src = src.withColumn("most", cap * F.col("source_size")).withColumn("full_at", F.col("most") / F.col("weight"))
    whole = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    src = (
        src.withColumn("rank", F.row_number().over(whole))
        .withColumn("spent", F.sum("most").over(whole.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most"))
        .withColumn("left_weight", F.sum("weight").over(whole.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("unit", (F.col("total") - F.col("spent")) / F.col("left_weight"))
    )
    fits = F.when(F.col("full_at") >= F.col("unit"), F.struct("rank", "unit"))
    unit = F.min(fits).over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))["unit"]
    target = F.least(F.col("most").cast("double"), F.col("weight") * unit)
    return src.select("source", "source_size", F.coalesce(target, F.col("most").cast("double")).alias("target"))


def budgets(targets: DataFrame) -> DataFrame:
    """``copies`` of the whole source and the ``rest`` of the target in words."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return targets.withColumn("copies", copies.cast("long")).withColumn(
        "rest", F.col("target") - F.col("copies") * F.col("source_size")
    )


def thresholds(spark: SparkSession, sizes: DataFrame, budget: DataFrame, path: str, level_bits: int = LEVEL_BITS) -> DataFrame:
    """``budget`` with ``below``: taking once more all documents of a smaller hash spends the rest."""
    state = budget.withColumn("below", F.lit(0).cast("long")).withColumn("open", F.lit(True))
    for level, used in enumerate(range(0, HASH_BITS, level_bits)):
        shift = HASH_BITS - used - level_bits
        state = staged(spark, state, f"{path}/state-{level}")
        if not state.filter("open").limit(1).count():
            return state
        edge = state.filter("open").select(F.col("source").alias("_source"), "below")
        inside = sizes.join(
            edge,
            sizes["source"].eqNullSafe(edge["_source"])
            & (F.shiftright(sizes["hash"], shift + level_bits) == F.shiftright(edge["below"], shift + level_bits)),
        )
        bins = inside.groupBy("source", F.shiftright("hash", shift).alias("bin")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("least"), F.max("hash").alias("most")
        )
        ahead = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        bins = bins.withColumn("upto", F.sum("words").over(ahead))
        rest = state.select(F.col("source").alias("_source"), F.col("rest").alias("_rest"))
        over = (
            bins.join(rest, bins["source"].eqNullSafe(rest["_source"]))
            .filter("upto > _rest")
            .groupBy("source")
            .agg(F.min(F.struct("bin", "upto", "words", "least", "most")).alias("b"))
            .select(F.col("source").alias("_source"), "b.*")
        )
        joined = state.join(over, state["source"].eqNullSafe(over["_source"]), "left")
        found, was = F.col("bin").isNotNull(), F.col("open")
        state = joined.select(
            "source", "source_size", "target", "copies",
            F.when(was & found, F.col("rest") - (F.col("upto") - F.col("words"))).otherwise(F.col("rest")).alias("rest"),
            F.when(was & found, F.shiftleft("bin", shift))
            .when(was, F.lit(1 << HASH_BITS)).otherwise(F.col("below")).cast("long").alias("below"),
            (was & found & (F.col("least") < F.col("most"))).alias("open"),
        )
    return staged(spark, state, f"{path}/state")


def _first_fit(docs: pd.DataFrame) -> pd.DataFrame:
    """The documents of one source that fit one after another, in ascending order of the hash."""
    docs = docs.sort_values("hash")
    left, fits = float(docs["left"].iloc[0]), []
    for size in docs["size"].tolist():
        fits.append(size <= left)
        left -= size * fits[-1]
    return docs.loc[fits, ["source", "hash"]]


def fillers(spark: SparkSession, sizes: DataFrame, state: DataFrame, path: str) -> DataFrame:
    """``_of, _at`` (source, hash) of the documents behind the threshold to be taken once more: in ascending order of the
    hash, each that fits what is still left."""
    edge = state.select(F.col("source").alias("_source"), F.col("below").alias("_low"), F.col("rest").alias("left"))
    behind = sizes.join(edge, sizes["source"].eqNullSafe(edge["_source"])).filter("hash >= _low")
    docs = behind.groupBy("source", "hash", "left").agg(F.sum("size").alias("size")).filter("size > 0 AND size <= left")
    # the first by hash of each size: in 64 shares of a size first, so that no size is ordered whole in one task
    for share in (F.pmod(F.xxhash64("hash"), F.lit(64)), F.lit(0)):
        order = Window.partitionBy("source", "size", share).orderBy("hash")
        docs = docs.withColumn("nth", F.row_number().over(order)).filter("nth <= floor(left / size)").drop("nth")
    picked = docs.groupBy("source").applyInPandas(_first_fit, "source string, hash long")
    return staged(spark, picked.toDF("_of", "_at"), f"{path}/picked")


def _planned(docs: DataFrame, seed: str, cycle: int, cap: int, path: str, fill: bool) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The documents' sizes, for each source (``_source``) its target, copies and threshold, and what is taken behind it."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id="long", source="string", text="string")
    sizes = rows.select("doc_id", "source", n_words("text").alias("size"), doc_hash("doc_id", seed).alias("hash"))
    sizes = staged(spark, sizes, f"{path}/sizes")
    state = thresholds(spark, sizes, budgets(source_targets(sizes, cycle, cap)), path)
    return sizes, state.withColumnRenamed("source", "_source"), fillers(spark, sizes, state, path) if fill else None


def mix_sources(
    docs: DataFrame, seed: str = "mix-1", cycle: int = 3, cap: int = 3, path: str | None = None, fill: bool = False
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every document; ``taken`` is a whole multiple of ``size``."""
    sizes, state, more = _planned(docs, seed, cycle, cap, path or run_dir(docs.sparkSession, "mix"), fill)
    out = sizes.join(state, sizes["source"].eqNullSafe(state["_source"]))
    once = F.col("hash") < F.col("below")
    if fill:
        here = F.col("source").eqNullSafe(F.col("_of")) & (F.col("hash") == F.col("_at"))
        out, once = out.join(more, here, "left"), once | F.col("_at").isNotNull()
    times = F.col("copies") + once.cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mixed(
    docs: DataFrame, seed: str = "mix-1", cycle: int = 3, cap: int = 3, path: str | None = None, fill: bool = False
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns."""
    _, state, more = _planned(docs, seed, cycle, cap, path or run_dir(docs.sparkSession, "mix"), fill)
    new = unused(docs, "source", "copies", "below", "hash", "of", "at", "turn")
    state = state.select(F.col("_source").alias(new["source"]), F.col("copies").alias(new["copies"]), F.col("below").alias(new["below"]))
    names = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn(new["hash"], doc_hash("`doc_id`", seed))
    out = marked.join(state, F.col("`source`").cast("string").eqNullSafe(F.col(new["source"])))
    once = F.col(new["hash"]) < F.col(new["below"])
    if fill:
        more = more.select(F.col("_of").alias(new["of"]), F.col("_at").alias(new["at"]))
        here = F.col(new["source"]).eqNullSafe(F.col(new["of"])) & (F.col(new["hash"]) == F.col(new["at"]))
        out, once = out.join(more, here, "left"), once | F.col(new["at"]).isNotNull()
    times = (F.col(new["copies"]) + once.cast("long")).cast("int")
    return out.withColumn(new["turn"], F.explode(F.array_repeat(F.lit(1), times))).select(*names)


def q_op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.common import table

    return mix_sources(table(spark, sf_dir, "documents"), fill=True).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_OP8 = """
WITH RECURSIVE sizes AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sizes GROUP BY source),
ranked AS (
  SELECT *, 3 * source_size AS most, CAST(3 * source_size AS DOUBLE) / weight AS full_at,
         CAST(sum(source_size) OVER () AS BIGINT) AS total
  FROM src),
units AS (
  SELECT *, row_number() OVER (ORDER BY full_at, source ASC NULLS LAST) AS rank,
         CAST(total - (sum(most) OVER (ORDER BY full_at, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING) - most) AS DOUBLE)
         / CAST(sum(weight) OVER (ORDER BY full_at, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS unit
  FROM ranked),
unit AS (SELECT arg_min(unit, rank) AS unit FROM units WHERE full_at >= unit),
targets AS (
  SELECT source, source_size, coalesce(least(CAST(most AS DOUBLE), weight * unit.unit), CAST(most AS DOUBLE)) AS target
  FROM units LEFT JOIN unit ON true),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies
  FROM targets),
docs AS (
  SELECT source, hash, CAST(sum(size) AS BIGINT) AS size, row_number() OVER (PARTITION BY source ORDER BY hash) AS k
  FROM sizes GROUP BY source, hash),
walk(source, k, rest, fits) AS (
  SELECT source, CAST(0 AS BIGINT), target - copies * source_size, 0 FROM budget
  UNION ALL
  SELECT w.source, d.k, w.rest - CASE WHEN d.size <= w.rest THEN d.size ELSE 0 END, CASE WHEN d.size <= w.rest THEN 1 ELSE 0 END
  FROM walk w JOIN docs d ON d.source IS NOT DISTINCT FROM w.source AND d.k = w.k + 1)
SELECT s.doc_id, s.size, b.source_size, b.target, s.size * (b.copies + w.fits) AS taken
FROM sizes s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source
JOIN docs d ON d.source IS NOT DISTINCT FROM s.source AND d.hash = s.hash
JOIN walk w ON w.source IS NOT DISTINCT FROM s.source AND w.k = d.k"""
