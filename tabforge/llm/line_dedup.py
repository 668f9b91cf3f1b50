"""Line deduplication with SQL functions only.

Lines are split, normalised and hashed (128 bits) where they lie; only hash, id
and position travel.  Distinct documents are counted per hash; a hash over the
threshold keeps its lines in the least document holding it and loses them
elsewhere.  The dropped positions of a document come back to its text, whose
remaining lines are joined in their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import materialize

_WHITE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    """The pieces between ``\\n``; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(text: Column) -> Column:
    """Keys of all lines in order: A-Z lower-cased, ASCII white space stripped at both ends."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.transform(F.split(lower, "\n"), lambda x: F.trim(x, F.lit(_WHITE)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
               min_docs: int = 2, info_col: str = "line_dedup") -> DataFrame:
    """``docs`` with ``info_col`` added: struct(n_lines, n_dropped, kept).

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents (distinct ids) loses all its lines except in the least id holding
    it; a line repeated inside that document stays.  Null and empty texts have one
    empty line and keep it.  Rows with a null id are not counted and lose nothing;
    rows sharing an id count as one document.  All columns of ``docs`` are kept;
    a column already called ``info_col`` is replaced.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th"),
                       F.col(text_col).alias("_text"))
    keys = F.transform(line_keys(F.col("_text")), lambda x: F.when(
        F.char_length(x) >= min_chars, F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(7), x).alias("h2"))))
    lines = materialize(rows.where("_id IS NOT NULL").select("_id", "_th", F.posexplode(keys).alias("pos", "k"))
                        .where("k IS NOT NULL").select("_id", "_th", "pos", "k.h1", "k.h2"), "ld-lines")
    common = materialize(lines.groupBy("h1", "h2")
                         .agg(F.min("_id").alias("low"), F.countDistinct("_id").alias("docs"))
                         .where(F.col("docs") >= min_docs).select("h1", "h2", "low"), "ld-common")
    drops = materialize(lines.join(common, ["h1", "h2"]).where("_id > low")
                        .groupBy("_id", "_th").agg(F.collect_set("pos").alias("_drop")), "ld-drops")

    keep = [F.col(c) for c in docs.columns if c != info_col]
    own = docs.select(F.struct(*keep).alias("_row"), F.col(id_col).alias("_id"),
                      F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th"))
    d = drops.select(F.col("_id").alias("_did"), F.col("_th").alias("_dth"), "_drop")
    j = own.join(d, F.col("_id").eqNullSafe(F.col("_did")) & (F.col("_th") == F.col("_dth")), "left")
    j = j.withColumn("_own", F.coalesce(F.col("_row").getField(text_col), F.lit("")))
    # _lines is used twice above, so that it is computed once for a text and not inside the lambda
    j = j.withColumn("_lines", lines_of(F.col("_own")))
    # hash-based difference, so that a text of very many lines stays linear
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    kept = F.when(F.col("_drop").isNull(), F.col("_own")).otherwise(
        F.array_join(F.transform(places, lambda i: F.get(F.col("_lines"), i)), "\n"))
    info = F.struct(F.size("_lines").cast("bigint").alias("n_lines"),
                    F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint").alias("n_dropped"), kept.alias("kept"))
    return j.select("_row.*", info.alias(info_col))


ORACLE = """
WITH l AS (
  SELECT doc_id, pos, string_split(t, chr(10))[pos] AS line,
         trim(translate(string_split(t, chr(10))[pos], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT doc_id, coalesce(text, '') AS t,
               unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos FROM documents)
), c AS (
  SELECT k, min(doc_id) AS low FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT l.doc_id, l.pos, l.line, (c.low IS NOT NULL AND l.doc_id > c.low) AS gone FROM l LEFT JOIN c USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
