"""Fill-in-the-middle transformation by one counted regular expression a row.

A text is cut into n units (lines by default; ``regexp_count`` gives n). Two cuts 0 <= a <= b <= n
come from a hash of doc_id, and a pattern made for the row,
``\\A((?:unit){a}+)((?:unit){b-a}+)(.*)\\z``, captures prefix, middle and suffix in one match.
Possessive counted groups are matched in a loop without backtracking, so that the number of
units does not deepen the matcher's stack. The three pieces are joined behind the markers
``<P>``, ``<S>``, ``<M>``: psm is prefix, suffix, middle; spm is suffix, prefix, middle. A text that
holds a marker stays plain, so the pieces can always be told apart again (``restored``).

Everything is a projection of DataFrame functions: no shuffle, no Python.

A null text counts as empty and stays plain, as every empty text does; a null doc_id counts as
an empty string in the hash. Repeated rows give equal rows, very long texts are matched whole,
empty tables give none. Of the input only doc_id and text are read: other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import pick, table

#: A unit of a text: a line with its line feed.
LINE_UNIT = "[^\\n]*+\\n|[^\\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents so many are transformed, and of these so many as spm.
FIM_PERCENT, SPM_PERCENT = 100, 50
SEED = 7


def _draws(seed: int) -> list[Column]:
    """Four unsigned 32-bit integers from the hash of seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, unit: str = LINE_UNIT, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """``doc_id, text, n, form, prefix, middle, suffix, output`` of every row; the three pieces are null where form is plain.

    ``unit``: a regular expression that never matches nothing and, matched again and again from the left, covers any text."""
    h1, h2, h3, h4 = _draws(seed)
    rows = pick(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(unit)).cast("long")).withColumns({"c1": h1 % (F.col("n") + 1), "c2": h2 % (F.col("n") + 1)})
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.length("text") == 0) | marked | (h3 % 100 >= fim_percent)
    rows = rows.withColumn("form", F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm"))
    a, b = F.least("c1", "c2").cast("string"), F.abs(F.col("c1") - F.col("c2")).cast("string")
    pattern = F.concat(F.lit(f"(?s)\\A((?:{unit}){{"), a, F.lit(f"}}+)((?:{unit}){{"), b, F.lit("}+)(.*+)\\z"))
    # no marker is in the text, and none can arise where a piece meets one: the split gives the captured groups
    cut = F.regexp_replace("text", pattern, F.lit(f"$1{PREFIX}$2{PREFIX}$3"))
    rows = rows.withColumn("cut", F.when(F.col("form") != "plain", F.split(cut, PREFIX, -1)))
    rows = rows.select("doc_id", "text", "n", "form", *[F.col("cut")[k].alias(c) for k, c in enumerate(("prefix", "middle", "suffix"))])
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    return rows.withColumn("output", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text")))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``transform`` was made of."""
    piece = F.split(output, "<[PSM]>", -1)
    psm = F.concat(piece[1], piece[3], piece[2])
    spm = F.concat(piece[2], piece[3], piece[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def q_op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = transform(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE_OP11 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units
  FROM documents),
c AS (
  SELECT *, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT doc_id, text, n, form,
         array_to_string(list_slice(units, 1, least(c1, c2)), '') AS prefix,
         array_to_string(list_slice(units, least(c1, c2) + 1, greatest(c1, c2)), '') AS middle,
         array_to_string(list_slice(units, greatest(c1, c2) + 1, n), '') AS suffix
  FROM c),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
  FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM o"""
