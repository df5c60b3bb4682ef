"""Benchmark decontamination by winnowing: shared passages found through a few fingerprints of each text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohorts.functions.columns import col
from cohorts.llm.tables import ascii_lower, let, row_key, same, table, two_hashes
from cohorts.session import materialize, materialize_with

# Every shared passage of SPAN words is found; a fingerprint covers GRAM words.
SPAN, GRAM = 10, 5
# Words of a text that are fingerprinted at a time.
STEP = 4096
# What separates words: ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Contexts of fingerprints, about 200 bytes each, and their items, up to which these tables are broadcast.
BROADCAST_CONTEXTS, BROADCAST_ITEMS = 200_000, 500_000


def word_list(text: Column) -> Column:
    """Words as written."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN, -1), "")


def word_hash(word: Column) -> Column:
    """Hash of the word with A-Z lower-cased; words of ASCII alone, most of all, take the quicker function."""
    return F.xxhash64(F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(ascii_lower(word)))


def stretches(words: Column, span: int, step: int = STEP) -> Column:
    """Overlapping stretches of word hashes as structs (base, words): every ``span`` words lie whole in one of them."""

    def cut(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(hashes) - 1, F.lit(0)), F.lit(step))
        return F.transform(starts, lambda s: F.struct(s.alias("base"), F.slice(hashes, s + 1, F.lit(step + span - 1)).alias("words")))

    return let(F.transform(words, word_hash), cut)


def rolling(values: Column, size: int, combine, use, have: int = 1) -> Column:
    """``use`` of the array whose place i combines ``size`` values from i on; the last ``size - 1`` places hold no whole window.

    Windows of 1, 2, 4, ... values are combined to the next, so a window costs the logarithm of its size.
    """
    step = min(have, size - have)
    if step == 0:
        return let(values, use)
    wider = lambda v: F.transform(v, lambda x, i: combine(x, F.get(v, i + step)))
    return let(values, lambda v: rolling(wider(v), size, combine, use, have + step))


def fingerprints(words: Column, base: Column, span: int, gram: int = GRAM) -> Column:
    """Winnowed fingerprints of word hashes for passages of ``span`` words.

    Of the hashes of ``gram`` consecutive words, each window of ``span - gram + 1`` gives its lowest, the first of equal ones.
    Structs (span, hash, first, before, context): the place of the first word, and the words around the gram, as many
    as a passage can have there; ``before`` of them stand in front.
    """
    gram = min(gram, span)
    reach = span - gram

    def choose(grams: Column, low: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(words) - span)
        if reach == 0:
            return F.transform(every, lambda i: place(grams, i))
        first = lambda j: j - 1 + F.array_position(F.slice(grams, j + 1, F.lit(reach + 1)), F.get(low, j)).cast("int")
        return F.transform(F.transform(F.filter(every, lambda j: moves(grams, low, j)), first), lambda i: place(grams, i))

    def moves(grams: Column, low: Column, j: Column) -> Column:
        """Whether window ``j`` has its lowest hash at another place than the window before."""
        return (j == 0) | (F.get(low, j) != F.get(low, j - 1)) | (F.get(grams, j - 1) == F.get(low, j))

    def place(grams: Column, i: Column) -> Column:
        before = F.least(i, F.lit(reach))
        return F.struct(
            F.lit(span).alias("span"), F.get(grams, i).alias("hash"), (base + i).alias("first"), before.alias("before"),
            F.slice(words, i - before + 1, before + (gram + reach)).alias("context"),
        )

    picked = rolling(words, gram, F.xxhash64, lambda g: rolling(g, reach + 1, F.least, lambda low: choose(g, low)))
    none = F.array().cast("array<struct<span:int,hash:bigint,first:int,before:int,context:array<bigint>>>")
    return F.when(F.size(words) >= span, picked).otherwise(none)


def common(left: Column, right: Column) -> Column:
    """How many elements two arrays agree in from their start."""
    equal = F.zip_with(left, right, lambda a, b: F.coalesce(a == b, F.lit(False)))
    differs = F.array_position(equal, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(equal)).cast("int")


def find_passages(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", span: int = SPAN, gram: int = GRAM, step: int = STEP,
    broadcast_contexts: int = BROADCAST_CONTEXTS, broadcast_items: int = BROADCAST_ITEMS,
) -> DataFrame:
    """Rows of ``docs`` with ``n_words``, ``n_hit``, ``spans`` and ``items`` added: what they share with the benchmark.

    A word is hit if it lies in an occurrence of ``span`` consecutive words of an item; an item of fewer words, but
    not none, counts as a whole. ``spans`` lists stretches of hit words (first, end exclusive), ``items`` the ids,
    sorted as text, of items with an occurrence.

    Both sides are winnowed alike, so a shared passage has a fingerprint in common. The fingerprint brings the words
    next to it, enough for a passage; joined by hash, both sides are compared outwards as long as words agree. Equal
    contexts on the benchmark's side are one row, whatever the number of items. Texts don't leave the scan, and
    are taken up in stretches of ``step`` words. Lengths of short items have fingerprints of their own, of at
    most ``span`` kinds. Words are compared by 64-bit hashes, of which a passage holds several.

    Null and empty texts have no words, nor hits. Items without an id make hits, but are not listed. Equal rows have equal
    results and are all returned. Columns of ``docs`` with the added names are replaced, all others passed on.
    """
    words = word_list(col(item_text))
    items = benchmark.select(col(item_col).cast("string").alias("item"), words.alias("words"))
    items = items.where(F.size("words") > 0).withColumn("kind", F.least(F.size("words"), F.lit(span)))
    items = materialize(items, "items")
    kinds = [r[0] for r in items.select("kind").distinct().collect()]

    def marks(frame: DataFrame, *keep: str, kind: Column | None = None) -> DataFrame:
        cut = frame.select(*keep, F.explode(stretches(F.col("words"), span, step)).alias("_s"))
        listed = [fingerprints(F.col("_s.words"), F.col("_s.base"), k, gram) for k in kinds]
        if kind is not None:
            listed = [F.when(kind == k, found) for k, found in zip(kinds, listed)]
            return cut.select(*keep, F.explode(F.coalesce(*listed)).alias("_f")).select(*keep, "_f.*")
        return cut.select(*keep, F.explode(F.concat(*listed)).alias("_f")).select(*keep, "_f.*")

    names = [c for c in docs.columns if c not in ("n_words", "n_hit", "spans", "items")]
    keyed = row_key(docs, id_col, text_col)
    if not kinds:
        nothing = [F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<struct<first:int,end:int>>").alias("spans")]
        none = F.array().cast("array<string>").alias("items")
        return docs.select(*[col(c) for c in names], F.size(word_list(col(text_col))).cast("long").alias("n_words"), *nothing, none)

    gram_of = F.least(F.col("span"), F.lit(gram))
    left = F.reverse(F.slice("context", F.lit(1), F.col("before")))
    right = F.slice("context", F.col("before") + gram_of + 1, F.greatest(F.size("context") - F.col("before") - gram_of, F.lit(0)))
    sides = [left.alias("left"), right.alias("right")]

    known = marks(items, "item", "kind", kind=F.col("kind")).select("item", "span", "hash", *sides)
    first, second = two_hashes(F.struct("span", "hash", "left", "right"))
    known = known.select("*", first.alias("c1"), second.alias("c2"))
    contexts, size = materialize_with(known.drop("item").distinct(), "contexts", n="count(1)")
    members, holders = materialize_with(known.select("c1", "c2", "item").distinct(), "members", n="count(1)")

    key = ["_id", "_t1", "_t2"]
    found = marks(keyed.select(*key, word_list(col(text_col)).alias("words")), *key)
    theirs = contexts.select("span", "hash", F.col("left").alias("l"), F.col("right").alias("r"), "c1", "c2")
    met = found.join(F.broadcast(theirs) if size["n"] <= broadcast_contexts else theirs, ["span", "hash"])
    met = met.select(*key, "span", "first", common(left, F.col("l")).alias("ahead"), common(right, F.col("r")).alias("after"), "c1", "c2")
    met = met.where(F.col("ahead") + gram_of + F.col("after") >= F.col("span"))
    met = met.select(*key, (F.col("first") - F.col("ahead")).alias("first"), (F.col("first") + gram_of + F.col("after")).alias("end"), "c1", "c2")
    hits = materialize(met, "hits")

    order = Window.partitionBy(*key).orderBy("first", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first") > before, F.lit(True)).cast("int")
    runs = hits.select(*key, "first", "end").distinct().select("*", opens.alias("opens"))
    runs = runs.select("*", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    runs = runs.groupBy(*key, "run").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    spans = runs.groupBy(*key).agg(
        F.sum(F.col("end") - F.col("first")).cast("long").alias("n_hit"), F.array_sort(F.collect_list(F.struct("first", "end"))).alias("spans")
    )
    listed = hits.select(*key, "c1", "c2").distinct().join(F.broadcast(members) if holders["n"] <= broadcast_items else members, ["c1", "c2"])
    listed = listed.groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    both = spans.join(listed, same(spans, listed, *key)).select(*[spans[k].alias(f"_k{k}") for k in key], "n_hit", "spans", "items")
    both = materialize(both, "found")

    on = F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("_t1") == F.col("_k_t1")) & (F.col("_t2") == F.col("_k_t2"))
    plain = keyed.drop(*[c for c in ("n_words", "n_hit", "spans", "items") if c in docs.columns])
    out = plain.withColumn("n_words", F.size(word_list(col(text_col))).cast("long")).join(both, on, "left")
    return out.select(
        *[col(c) for c in names], "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def op11_winnowing(spark: SparkSession, base: str) -> DataFrame:
    found = find_passages(table(spark, base, "documents").select("doc_id", "text"), table(spark, base, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


PASSAGE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS passage
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
        FROM (SELECT item_id, w, least(len(w), 10) AS size FROM i WHERE len(w) > 0))
), places AS (
  SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS passage
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
        FROM d, (SELECT DISTINCT size FROM windows))
), hits AS (
  SELECT doc_id, item_id, p, size FROM places JOIN windows USING (size, passage)
), words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

QUERIES = {"op11_winnowing": op11_winnowing}
SQL = {"op11_winnowing": PASSAGE_SQL}
