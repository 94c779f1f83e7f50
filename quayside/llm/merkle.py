"""A Merkle manifest of a dataset, and the check of each leaf against its root by a recursive query.

Every row is a leaf. The leaves of one lang, in ascending order of doc_id, are the bottom of a
tree in which every ``FAN`` consecutive nodes (the last run: fewer) become one; the roots of all
langs, null first, are the bottom of one more such tree, whose root stands for the dataset.

1. ``leaves``: one pass over the texts makes each row's digest and the digest of its tampered form.
   From here on rows are small.
2. Leaves are sorted by (lang, doc_id, digest, place in the written table) over range partitions. The key
   is unique, so neither a lang nor a repeated row can make a partition large. A leaf's position in its
   tree is its row in the partition and the number of leaves of its lang in earlier partitions.
3. Each level is a grouping of at most ``FAN`` digests by (tree, position div FAN) and is written as node rows
   with a link to the parent, ``up_*``; a lang's root links to the tree of langs.
4. ``WITH RECURSIVE climb``: the leaves below one node of the second level (at most ``FAN ** 2``) climb in one row, as all
   that they meet above it is the same. The anchor folds each tampered digest with its siblings of the two lowest
   levels; a step joins the parent's row, folds each digest with the siblings on the left and right, and appends these
   siblings to the common upper part of the proofs. Spark keeps each step's rows in shuffle
   files and computes lost ones anew. Node rows are repeated for each ``BLOCK`` climbing rows beneath, so that a
   join key never has more than ``BLOCK`` rows, whatever the size of a tree.

Nulls: a null value enters the digest as ``-``; a null lang is a tree of its own, before the others; null
doc_ids come first and are not tampered. Rows of one doc_id follow each other by digest; equal rows are leaves of their
own. An empty text is a value of 0 bytes, a very long one is hashed whole. Empty tables give no rows. Of the input only the
five named columns are read: others cannot clash.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import pick, run_dir, staged, table

#: Consecutive nodes that become one.
FAN = 8
#: Climbing rows that share a copy of the nodes above them.
BLOCK = 8
#: The tree of langs; the others are ``0`` (null) and ``1`` and the lang.
TOP = "2"
#: Levels of the tree of langs are counted from here, so that they differ from those of a lang's tree.
TOP_LEVEL = 100

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, leaf, tampered`` of every row; tampered is leaf where the row is not tampered with."""
    rows = pick(docs, doc_id="long", source="string", lang="string", n_chars="long", text="string")
    head = F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")])
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    rows = rows.select("doc_id", "lang", "text", head.alias("head"), hit.alias("hit"))
    rows = rows.withColumn("leaf", F.sha2(F.concat("head", _field(F.col("text"))), 256))
    other = F.sha2(F.concat("head", _field(F.translate("text", _UPPER, _LOWER))), 256)
    tree = F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "lang"))
    return rows.select("doc_id", tree.alias("tree"), "leaf", F.when(F.col("hit"), other).otherwise(F.col("leaf")).alias("tampered"))


def _numbered(spark: SparkSession, path: str, rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows of a written table with ``pos``, their place from 0 in the group by ``order`` (then by place in the files),
    and ``n``, the group's size."""
    names = rows.columns
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    keys = [group, *order, "_file", "_row"]
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    ordered = rows.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys)
    ordered = staged(spark, ordered.select(*names, F.monotonically_increasing_id().alias("at")), f"{path}/ordered")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    runs = ordered.groupBy(group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.select(
        group, "part", (F.col("first") - F.sum("size").over(earlier) + F.col("size")).alias("shift"), F.sum("size").over(Window.partitionBy(group)).alias("n")
    )
    return ordered.join(runs, [group, "part"]).withColumn("pos", F.col("at") - F.col("shift")).drop("part", "at", "shift")


def _digest(children: Column) -> tuple[Column, Column]:
    joined = F.array_join(children, "")
    return joined.alias("children"), F.sha2(joined, 256).alias("hash")


def _up(n: Column) -> Column:
    """How many nodes n nodes become."""
    return F.ceil(n / F.lit(FAN)).cast("long")


def _levels(spark: SparkSession, path: str, nodes: DataFrame, level: int, most: int) -> list[DataFrame]:
    """The written levels above ``nodes`` (``tree, idx, hash, n``; n the number of the tree's nodes at their level), each
    ``tree, level, idx, children, hash, n``; trees leave when one node remains. ``most``: the largest n."""
    out = []
    while most > 1:
        groups = nodes.filter(F.col("n") > 1).groupBy("tree", F.expr(f"idx div {FAN}").alias("idx"))
        above = groups.agg(F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("run"), _up(F.max("n")).alias("n"))
        above = above.select("tree", F.lit(level).alias("level"), "idx", *_digest(F.col("run.hash")), "n")
        nodes = staged(spark, above, f"{path}/level-{level:02d}")
        out.append(nodes)
        level, most = level + 1, -(-most // FAN)
    return out


def _fold(digest: str, children: str, place: str) -> str:
    """SQL for the parent's digest, with ``digest`` in a place of the parent's children."""
    return f"sha2(concat(substr({children}, 1, 64 * {place}), {digest}, substr({children}, 64 * {place} + 65)), 256)"


#: ``bundles`` are the nodes of the second level with the runs of leaves below them, ``nodes`` all that lies above. A tree of one
#: run, or of one leaf, has a level less, or two.
CLIMB = f"""
WITH RECURSIVE climb(tree, bundle, folded, upper, subroot, root, up_level, up_idx, up_place, up_own) AS (
  SELECT tree, idx,
         flatten(transform(runs, (run, j) -> transform(run.tampered, (t, i) ->
           CASE WHEN n_leaves = 1 THEN t WHEN n_leaves <= {FAN} THEN {_fold('t', 'run.children', 'i')}
                ELSE {_fold(_fold('t', 'run.children', 'i'), 'children', 'j')} END))),
         '', hash, hash, up_level, up_idx, up_place, up_own
  FROM {{bundles}}
  UNION ALL
  SELECT c.tree, c.bundle, transform(c.folded, t -> {_fold('t', 'n.children', 'c.up_place')}),
         concat(c.upper, substr(n.children, 1, 64 * c.up_place), substr(n.children, 64 * c.up_place + 65)),
         CASE WHEN c.up_own THEN n.hash ELSE c.subroot END, n.hash, n.up_level, n.up_idx, n.up_place, n.up_own
  FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.bundle div {BLOCK} = n.block AND c.up_level = n.level AND c.up_idx = n.idx)
SELECT tree, bundle AS idx, folded, upper, subroot, root FROM climb WHERE up_level IS NULL LIMIT ALL"""


def _link(level: Column, pos: str, own: bool) -> list[Column]:
    """Where the parent stands: its level and idx, the place among its children, and whether it is in the same tree."""
    return [
        (level + 1).cast("int").alias("up_level"), F.expr(f"{pos} div {FAN}").alias("up_idx"),
        F.expr(f"cast({pos} % {FAN} as int)").alias("up_place"), F.lit(own).alias("up_own"),
    ]


def _no_link() -> list[Column]:
    kinds = {"up_level": "int", "up_idx": "long", "up_place": "int", "up_own": "boolean"}
    return [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]


def _linked(nodes: DataFrame, places: DataFrame | None) -> DataFrame:
    """A lang tree's nodes with their links; the last one's leads to the tree of langs (``places``; None: there is but one lang)."""
    inner = nodes.filter(F.col("n") > 1).select("*", *_link(F.col("level"), "idx", True))
    last = nodes.filter(F.col("n") == 1)
    if places is None:
        return inner.union(last.select("*", *_no_link()))
    return inner.union(last.join(places, "tree").select(*nodes.columns, *_link(F.lit(TOP_LEVEL), "pos", False)))


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


_NODE = ["tree", "block", "level", "idx", "children", "hash", "up_level", "up_idx", "up_place", "up_own"]


def _node_rows(own: list[DataFrame], top: list[DataFrame], ranked: DataFrame, places: DataFrame | None) -> DataFrame:
    """The nodes above the bundles, each repeated for the blocks of bundles beneath it."""
    sizes = own[0].groupBy("tree").agg(F.max("idx").alias("last_bundle"))
    parts = []
    for k, nodes in enumerate(own[1:], 1):
        wide = FAN**k  # bundles beneath a node
        blocks = F.expr(f"sequence(idx * {wide} div {BLOCK}, least((idx + 1) * {wide} - 1, last_bundle) div {BLOCK})")
        parts.append(_linked(nodes, places).join(sizes, "tree").select("*", F.explode(blocks).alias("block")).select(*_NODE))
    routes = ranked.join(sizes, "tree").select("tree", "pos", F.explode(F.expr(f"sequence(0L, last_bundle div {BLOCK})")).alias("block"))
    for k, nodes in enumerate(top, 1):
        nodes = nodes.drop("tree")
        nodes = nodes.filter("n > 1").select("*", *_link(F.col("level"), "idx", False)).union(nodes.filter("n = 1").select("*", *_no_link()))
        parts.append(routes.withColumn("idx", F.expr(f"pos div {FAN**k}")).join(nodes, "idx").select(*_NODE))
    return _all(parts) if parts else own[0].filter("false").select("tree", F.col("idx").alias("block"), "level", "idx", "children", "hash", *_no_link())


def _bundles(rows: DataFrame) -> DataFrame:
    """The numbered leaves gathered by runs, and these by nodes of the second level: ``tree, level, idx, children, hash, n``, the
    number of leaves of the tree, and the runs with their leaves."""
    runs = rows.groupBy("tree", F.expr(f"pos div {FAN}").alias("idx")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "doc_id", "leaf", "tampered"))).alias("run"), F.max("n").alias("n_leaves")
    )
    children, digest = _digest(F.col("run.leaf"))
    digest = F.when(F.col("n_leaves") == 1, F.col("run.leaf")[0]).otherwise(digest)
    run = F.struct("idx", digest.alias("hash"), children, F.col("run.doc_id").alias("doc_ids"), F.col("run.tampered").alias("tampered"))
    above = runs.groupBy("tree", F.expr(f"idx div {FAN}").alias("idx")).agg(F.sort_array(F.collect_list(run)).alias("runs"), F.max("n_leaves").alias("n_leaves"))
    children, digest = _digest(F.col("runs.hash"))
    lone = F.col("n_leaves") <= FAN
    return above.select(
        "tree", F.lit(2).alias("level"), "idx", children, F.when(lone, F.col("runs.hash")[0]).otherwise(digest).alias("hash"), _up(_up(F.col("n_leaves"))).alias("n"), "n_leaves", "runs"
    )


def _result(bundles: DataFrame) -> DataFrame:
    """A row for each leaf of ``bundles`` with ``folded, upper, subroot, root``."""
    rows = bundles.select("children", "runs", "n_leaves", "folded", "upper", "subroot", "root", F.posexplode(F.flatten("runs.doc_ids")).alias("at", "doc_id"))
    rows = rows.select("*", F.expr(f"runs[at div {FAN}].children").alias("run"), F.expr(f"at div {FAN}").alias("j"), F.expr(f"at % {FAN}").alias("i"))
    beside = [F.expr(f"substr({c}, 1, 64 * {k})") for c, k in (("run", "i"), ("children", "j"))], [F.expr(f"substr({c}, 64 * {k} + 65)") for c, k in (("run", "i"), ("children", "j"))]
    second = F.when(F.col("n_leaves") > FAN, F.concat(beside[0][1], beside[1][1])).otherwise("")
    rows = rows.select(
        "doc_id", F.expr("substr(run, 64 * i + 1, 64)").alias("leaf"), "subroot", "root",
        F.sha2(F.concat(beside[0][0], beside[1][0], second, F.col("upper")), 256).alias("proof_sha256"), F.expr("folded[at]").alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def verify(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``.

    ``folder`` keeps the manifest: ``bundles`` (leaves, by runs) and ``nodes``, all with their links, and ``proofs``."""
    spark = docs.sparkSession
    path = folder or run_dir(spark, "merkle")
    rows = _numbered(spark, f"{path}/leaves", staged(spark, leaves(docs), f"{path}/rows"), "tree", ["doc_id", "leaf"])
    bundles = staged(spark, _bundles(rows), f"{path}/gathered")
    most = bundles.agg(F.max("n")).first()[0]
    if most is None:  # an empty table
        nothing = {"folded": F.flatten("runs.tampered"), "upper": F.lit(""), "subroot": F.col("hash"), "root": F.col("hash")}
        return _result(bundles.withColumns(nothing))
    own = [bundles, *_levels(spark, f"{path}/lang", bundles.select("tree", "idx", "hash", "n"), 3, most)]
    subroots = _all([nodes.filter("n = 1").select("tree", "hash") for nodes in own]).withColumn("all", F.lit(TOP))
    ranked = staged(spark, _numbered(spark, f"{path}/top", staged(spark, subroots, f"{path}/subroots"), "all", ["tree"]), f"{path}/ranked")
    n_trees = ranked.agg(F.max("n")).first()[0]
    top = _levels(spark, f"{path}/top", ranked.select(F.col("all").alias("tree"), F.col("pos").alias("idx"), "hash", "n"), TOP_LEVEL + 1, n_trees)
    places = ranked.select("tree", "pos") if n_trees > 1 else None
    nodes = staged(spark, _node_rows(own, top, ranked, places), f"{path}/nodes")
    bundles = staged(spark, _linked(bundles, places), f"{path}/bundles")
    views = {name: f"llm_merkle_{name}_{uuid.uuid4().hex}" for name in ("bundles", "nodes")}
    bundles.createOrReplaceTempView(views["bundles"])
    nodes.createOrReplaceTempView(views["nodes"])
    try:
        proofs = staged(spark, spark.sql(CLIMB.format(**views)), f"{path}/proofs")
    finally:
        for name in views.values():
            spark.catalog.dropTempView(name)
    return _result(bundles.select("tree", "idx", "children", "runs", "n_leaves").join(proofs, ["tree", "idx"]))


def q_op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(table(spark, sf_dir, "documents"))


def _oracle_field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


_ORACLE_LEAF = " || ".join(_oracle_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

#: DuckDB has no crc32: it is folded bit by bit over the decimal digits. ``anc`` are the ancestors of each leaf with the
#: siblings met below them; a tampered hash is folded over them by list_reduce.
ORACLE_OP13 = f"""
WITH RECURSIVE leaf0 AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS tree,
         sha256({_ORACLE_LEAF} || {_oracle_field('text')}) AS leaf,
         sha256({_ORACLE_LEAF} || {_oracle_field(f"translate(text, '{_UPPER}', '{_LOWER}')")}) AS other,
         list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(8 * strlen(CAST(doc_id AS VARCHAR))),
           lambda i: CAST((ascii(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS BIGINT), 1)) >> CAST(i % 8 AS INTEGER)) & 1 AS BIGINT))),
           lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)) AS crc
  FROM documents),
leaf AS (
  SELECT doc_id, tree, leaf, CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN other ELSE leaf END AS tampered,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaf0),
low(tree, level, idx, hash, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM leaf
  UNION ALL
  SELECT tree, any_value(level) + 1, idx // {FAN}, sha256(string_agg(hash, '' ORDER BY idx)), CAST(ceil(any_value(n) / {FAN}) AS BIGINT)
  FROM low WHERE n > 1 GROUP BY tree, idx // {FAN}),
sub AS (SELECT tree, hash AS subroot, level AS depth, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high(level, idx, hash, n) AS (
  SELECT 0, pos, subroot, n FROM sub
  UNION ALL
  SELECT any_value(level) + 1, idx // {FAN}, sha256(string_agg(hash, '' ORDER BY idx)), CAST(ceil(any_value(n) / {FAN}) AS BIGINT)
  FROM high WHERE n > 1 GROUP BY idx // {FAN}),
side AS (
  SELECT tree, level, idx, coalesce(string_agg(hash, '') OVER (PARTITION BY tree, level, idx // {FAN} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(hash, '') OVER (PARTITION BY tree, level, idx // {FAN} ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT tree, level, idx, hash FROM low WHERE n > 1 UNION ALL SELECT '{TOP}', {TOP_LEVEL} + level, idx, hash FROM high WHERE n > 1)),
met AS (
  SELECT f.doc_id, f.tree, f.pos, s.level, s.l, s.r FROM leaf f JOIN side s ON s.tree = f.tree AND s.idx = f.pos // CAST(pow({FAN}, s.level) AS BIGINT)
  UNION ALL
  SELECT f.doc_id, f.tree, f.pos, s.level, s.l, s.r FROM leaf f JOIN sub b ON b.tree = f.tree
  JOIN side s ON s.tree = '{TOP}' AND s.idx = b.pos // CAST(pow({FAN}, s.level - {TOP_LEVEL}) AS BIGINT)),
path AS (SELECT tree, pos, list(l || '|' || r ORDER BY level) AS steps, sha256(string_agg(l || r, '' ORDER BY level)) AS proof FROM met GROUP BY tree, pos)
SELECT f.doc_id, f.leaf, b.subroot, h.hash AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
       coalesce(list_reduce(list_concat([f.tampered], p.steps), lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))), f.tampered) AS folded_root,
       coalesce(list_reduce(list_concat([f.tampered], p.steps), lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))), f.tampered) = h.hash AS verified
FROM leaf f JOIN sub b ON b.tree = f.tree CROSS JOIN (SELECT hash FROM high WHERE n = 1) h LEFT JOIN path p ON p.tree = f.tree AND p.pos = f.pos"""
