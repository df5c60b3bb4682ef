"""Dropping lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions.columns import col
from cohorts.llm.tables import SPACES, ascii_lower, row_key, table, two_hashes
from cohorts.session import materialize

MIN_CHARS, MIN_DOCS = 40, 5


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Rows of ``docs`` with shared lines removed from the text, and ``n_lines`` and ``n_dropped`` added.

    A line's key is the line stripped of white space and lower-cased (A-Z). A key of at
    least ``min_chars`` characters that occurs in at least ``min_docs`` different ids keeps
    its lines only in the largest id that holds it; all its lines there stay.

    Lines are exploded once into (row, position, 128-bit digest) and written; counting,
    the exact distinct count of the few frequent digests, and the positions to drop all
    come from that narrow table. Texts are shuffled once, to meet their positions. A
    digest that a third of all lines share is counted by partial aggregates, and joined
    as the split side of a skewed join.

    Null and empty texts are one empty line (a null text becomes an empty one). A null id
    counts as no document: its lines are dropped where others keep the key. Equal rows
    are treated alike and all returned. Columns of the input named ``n_lines`` or
    ``n_dropped`` are replaced; all others are passed on.
    """
    spark = docs.sparkSession
    keyed = row_key(docs, id_col, text_col)
    lines = keyed.select("_id", "_t1", "_t2", F.posexplode(F.split(col(text_col), "\n", -1)).alias("pos", "line"))
    lines = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    first, second = two_hashes(F.col("key"))
    lines = materialize(lines.select("_id", "_t1", "_t2", "pos", first.alias("h1"), second.alias("h2")), "lines")

    often = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")
    hits = materialize(lines.join(materialize(often, "often"), ["h1", "h2"]), "hits")
    holders = hits.select("h1", "h2", "_id").distinct().groupBy("h1", "h2").agg(
        F.count("_id").alias("n"), F.max("_id").alias("keeper")
    )
    shared = materialize(holders.where(F.col("n") >= min_docs).drop("n"), "shared")
    goes = F.coalesce(F.col("_id") < F.col("keeper"), F.lit(True))
    drops = hits.join(shared, ["h1", "h2"]).where(goes)
    drops = drops.groupBy("_id", "_t1", "_t2").agg(F.collect_set("pos").alias("drop"))
    drops = materialize(drops.withColumnsRenamed({"_id": "_did", "_t1": "_d1", "_t2": "_d2"}), "drops")

    on = F.col("_id").eqNullSafe(F.col("_did")) & (F.col("_t1") == F.col("_d1")) & (F.col("_t2") == F.col("_d2"))
    joined = keyed.join(drops.hint("shuffle_hash"), on, "left")
    parts = F.split(F.coalesce(col(text_col), F.lit("")), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("drop"))
    kept = F.array_join(F.transform(F.array_sort(stay), lambda i: F.get(parts, i)), "\n")
    text = F.when(F.col("drop").isNull(), F.coalesce(col(text_col), F.lit(""))).otherwise(kept)
    out = joined.withColumns(
        {
            "n_lines": F.size(parts).cast("long"),
            "n_dropped": F.coalesce(F.size("drop"), F.lit(0)).cast("long"),
            text_col: text,
        }
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*[col(c) for c in names], "n_lines", "n_dropped")


def op10_line_dedup(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


LINE_SQL = """
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.pos, l.line, s.key IS NOT NULL AND l.doc_id < s.keeper AS dropped
  FROM lines l LEFT JOIN shared s ON l.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES = {"op10_line_dedup": op10_line_dedup}
SQL = {"op10_line_dedup": LINE_SQL}
