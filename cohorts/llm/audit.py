"""Filter interaction audit: what every filter removes, repeats and loses in every order of the filters."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohorts.functions.columns import col
from cohorts.llm.tables import UPPER, table, two_hashes

# The filters in the order of their bits, and their limits.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
SPACE, SYMBOL = r"[ \t\n\x0B\f\r]+", r"[#$%&*|]"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.get(F.transform(F.array(F.array_remove(F.split(text, SPACE, -1), "")), lambda w: F.struct(
        F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("distinct")
    )), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    shape = F.when(100 * capitals > MAX_CAPITALS * F.length(text), 4).otherwise(0) + F.when(text.rlike(SYMBOL), 8).otherwise(0)
    return F.get(F.transform(F.array(words), lambda w: F.when(w["all"] < MIN_WORDS, 1).otherwise(0)
                             + F.when(100 * w["distinct"] < MIN_DISTINCT * w["all"], 2).otherwise(0)), F.lit(0)) + shape


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Rows (part, mask, n, n_good, n_toxic): documents by the set of filters they fail, at most 32 a part.

    Bit E is set for rows whose text another row with a smaller id has. Rows are counted by text, part, labels and
    other failures before texts meet, each group with its smallest id and the rows that have it; so a text of a third
    of all rows is a handful of rows, and no copy is joined to another.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    first, second = two_hashes(text)
    facts = docs.select(
        col(id_col).alias("id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"), first.alias("t1"),
        second.alias("t2"), failures(text).alias("mask"),
    )
    rows = facts.where("id is not null").groupBy("id", "part", "t1", "t2", "mask").agg(F.count(F.lit(1)).alias("n"))
    marked = labels.select(col("doc_id").alias("id"), col("quality").alias("q"), col("toxic").alias("t")).groupBy("id").agg(
        F.coalesce(F.max(F.col("q") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("t") == 1), F.lit(False)).alias("toxic")
    )
    rows = rows.join(marked, "id", "left").na.fill(False, ["good", "toxic"])
    texts = rows.groupBy("t1", "t2", "part", "good", "toxic", "mask").agg(
        F.sum("n").alias("n"), F.min("id").alias("low"), F.min_by("n", "id").alias("n_low")
    )
    lowest = F.min("low").over(Window.partitionBy("t1", "t2"))
    texts = texts.select("part", "good", "toxic", "mask", "n", F.when(F.col("low") == lowest, F.col("n_low")).otherwise(0).alias("firsts"))
    either = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("firsts").alias("n")), F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - F.col("firsts")).alias("n"))
    )).alias("c")
    counted = texts.select("part", "good", "toxic", either).select("part", "good", "toxic", "c.mask", "c.n").where("n > 0")
    nameless = facts.where("id is null").select("part", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "mask", F.lit(1).cast("long").alias("n"))
    return counted.unionByName(nameless).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("n_toxic"),
    )


def fold_orders(found: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Rows (part, filter_order, step, filter, figures) from rows (part, mask, n, n_good, n_toxic); zeros included.

    Every cell folds over the array of all orders: a fold along an order carries whether the cell is still there, and
    leaves a struct of weighted figures a step. The structs of a part's cells are added place by place.
    """
    fields = ", ".join(f"{c}: bigint" for c in COUNTS)
    kind = f"array<struct<filter_order: string, step: int, filter: string, {fields}>>"
    bit = f"shiftleft(1, instr('{filters}', f) - 1)"
    fails = f"((mask & {bit}) > 0)"
    weighted = {
        "kept": f"s.there and not {fails} then n", "removed": f"s.there and {fails} then n", "redundant": f"not s.there and {fails} then n",
        "unique_fails": f"mask = {bit} then n", "good_lost": f"s.there and {fails} then n_good", "toxic_lost": f"s.there and {fails} then n_toxic",
    }
    figures = ", ".join(f"'{name}', case when {rule} else 0L end" for name, rule in weighted.items())
    one = f"named_struct('filter_order', o, 'step', size(s.done) + 1, 'filter', f, {figures})"
    fold = (
        f"flatten(transform(orders, o -> aggregate(filter(split(o, ''), f -> f <> ''), "
        f"named_struct('there', true, 'done', cast(array() as {kind})), "
        f"(s, f) -> named_struct('there', s.there and not {fails}, 'done', concat(s.done, array({one}))), s -> s.done)))"
    )
    orders = F.lit(["".join(p) for p in permutations(filters)])
    steps = found.withColumn("orders", orders).select("part", F.explode(F.expr(fold)).alias("s")).select("part", "s.*")
    return steps.groupBy("part", "filter_order", "step", "filter").agg(*[F.sum(c).alias(c) for c in COUNTS])


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Five filters on ``docs``, applied in all 120 orders: a row for each part, order and step.

    Filters fail a text that has under 100 words (A), under 80 % distinct words (B), over 10 % capitals A-Z (C), one of
    ``#$%&*|`` (D), or equals the text of a row with a smaller id (E, over the whole table). Counts are rows of the part:
    ``kept`` after the step, ``removed`` by it, ``redundant`` (failing it, but gone before), ``unique_fails`` (failing it
    alone), ``good_lost`` and ``toxic_lost`` (removed and labelled so), ``shapley`` (its filter's removals over all
    orders). Only digests and bits leave the scan of the texts; orders are folded over at most 32 cells a part.

    Null texts are empty texts: they fail A, and are equal to each other. A null part is the empty one. Rows that repeat id
    and text are no copies of each other. A row without id has no label and is no copy. An id with several labels is good,
    or toxic, if one says so. An empty table has no rows. Other columns are not read.
    """
    out = fold_orders(cells(docs, labels, id_col, text_col, part_col))
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return out.select("part", "filter_order", "step", "filter", *COUNTS, shapley.alias("shapley"))


def op12_filter_audit(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text", "lang")
    return audit_filters(docs, table(spark, base, "labels")).drop("filter")


AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), facts AS (
  SELECT doc_id, part,
         [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
          100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
          regexp_matches(text, '[#$%&*|]'), doc_id > min(doc_id) OVER (PARTITION BY text)] AS fails,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM d
), grouped AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM facts GROUP BY part, fails
), letters AS (SELECT unnest(range(1, 6)) AS k),
orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
), walked AS (
  SELECT part, array_to_string([chr(CAST(64 + x AS INTEGER)) for x in o], '') AS filter_order, l.k AS step, o[l.k] AS f, fails[o[l.k]] AS now,
         len([x for x in o[1:l.k - 1] if fails[x]]) > 0 AS before, len([x for x in fails if x]) AS n_fails, n, n_good, n_toxic
  FROM grouped, orders, letters l
), steps AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT before AND NOT now THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT before AND now THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN before AND now THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN now AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT before AND now THEN n_good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT before AND now THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM walked GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM steps
"""

QUERIES = {"op12_filter_audit": op12_filter_audit}
SQL = {"op12_filter_audit": AUDIT_SQL}
