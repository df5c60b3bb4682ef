"""Secret scans: fixed patterns, and parts of credentials that count only where complementary parts stand close by."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohorts.functions.columns import col
from cohorts.llm.tables import let, row_key, table
from cohorts.session import materialize

# Base patterns; kinds in the order in which spans of one start are listed.
KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN, ASSIGN_VALUE = KEYWORD + r"[A-Za-z0-9+/_.=-]+", r"[A-Za-z0-9+/_.=-]+$"
# A run that fails its least length cannot hold a longer one, so these two carry it in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6
KINDS = ["assign", "access", "hex", "identifier", "material", "endpoint"]

# Weak parts: who (names and key ids), what (random-looking material), where (hosts with a scheme or port).
PARTS = {
    "identifier": r"""(?i:\b(?:user(?:name)?|login|account|client_?id|key_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9@_.+-]{3,}|\b[AS]KIA[A-Z0-9]{8,}""",
    "material": r"""(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}={0,2}""",
    "endpoint": r"""\b(?:https?|ftp|ssh|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]{3,}|(?i:\b(?:host|server|endpoint|hostname)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9.-]{3,}""",
}
# Parts are complementary if at most so many characters stand between them.
SCOPE = 400
# Matches whose positions are added up together.
RUN = 128


SPAN = "struct<start:int,kind:int,end:int,match:string>"


def spans(text: Column, pattern: str, kind: int) -> Column:
    """All leftmost, non-overlapping matches as structs (start, kind, end, match); code points, end exclusive.

    Positions are running sums of the text between matches and the matches. They are added up in runs of RUN matches, then
    over runs, so the work for a text grows with its matches, however many there are.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, match: F.struct(
        F.length(gap).alias("gap"), match.alias("match"), F.length(match).alias("size")
    ))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["size"]).alias("end"), x["match"].alias("match"))
        return F.struct((start + x["size"]).alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    def cut(listed: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(listed), F.lit(RUN))
        return F.transform(starts, lambda i: F.slice(listed, i, F.lit(RUN)))

    def total(state: Column, run: Column) -> Column:
        return F.struct((state["at"] + run["at"]).alias("at"), F.concat(state["before"], F.array(state["at"])).alias("before"))

    def placed(run: Column, before: Column) -> Column:
        return F.transform(run["out"], lambda s: F.struct(
            (s["start"] + before).alias("start"), s["kind"].alias("kind"), (s["end"] + before).alias("end"), s["match"].alias("match")
        ))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before"))
    runs = let(sizes, lambda listed: F.transform(cut(listed), lambda run: F.aggregate(run, empty, add)))
    listed = let(runs, lambda r: F.flatten(F.zip_with(r, F.aggregate(r, none, total, lambda state: state["before"]), placed)))
    return F.when(text.rlike(pattern), listed).otherwise(F.array().cast(f"array<{SPAN}>"))


def bare(found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def listing(found: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(F.array_sort(found), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    ))
    return F.array_join(text, ",")


def linked_parts(parts: DataFrame, keys: list[str], scope: int = SCOPE) -> DataFrame:
    """Rows of ``parts`` (``keys``, ``start``, ``kind``, ``end``) with at most ``scope`` characters to a complementary kind.

    An identifier needs material close by, material an identifier or an endpoint, an endpoint material. An interval
    join by cells of ``scope`` characters, in which parts stand by their start: a cell keeps the first start and the last end of
    each kind, and learns the last end of all cells before it and the first start of all after it. Of parts that start
    before, the last end is the nearest, also if it covers whole cells; those that start in the same cell are close.
    No pair is ever listed, and a crowded text costs no more than its parts.
    """
    at = parts.withColumn("cell", F.floor(F.col("start") / scope).cast("int"))
    ends = [F.min(F.when(F.col("kind") == k, F.col("start"))).alias(f"low{k}") for k in (3, 4, 5)]
    ends += [F.max(F.when(F.col("kind") == k, F.col("end"))).alias(f"high{k}") for k in (3, 4, 5)]
    cells = at.groupBy(*keys, "cell").agg(*ends)
    earlier = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    known = cells.select(*keys, "cell", *[
        expr for k in (3, 4, 5) for expr in (
            F.max(f"high{k}").over(earlier).alias(f"left{k}"), F.col(f"low{k}").alias(f"own{k}"), F.min(f"low{k}").over(later).alias(f"right{k}"),
        )
    ])

    def has(k: int) -> Column:
        left, right = F.col("start") - F.col(f"left{k}") <= scope, F.col(f"right{k}") - F.col("end") <= scope
        return F.col(f"own{k}").isNotNull() | F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))

    wanted = F.when(F.col("kind") == 4, has(3) | has(5)).otherwise(has(4))
    return at.join(known, [*keys, "cell"]).where(wanted).select(*keys, "start", "kind", "end")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs``: its id, ``base`` and ``linked``, arrays of (start, kind, end), kinds numbered as in KINDS.

    ``base`` has what the fixed patterns find, leftmost and non-overlapping per kind. ``linked`` has
    weak parts (identifiers, material, endpoints) with at most ``scope`` characters between them and a complementary
    one. Texts are scanned once, whole, and only positions leave the scan: parts are joined by text and cell, and their
    results by text, never the texts themselves.

    Null and empty texts have no spans. Equal rows get equal results; all rows are returned. Other columns are not read.
    """
    own = row_key(docs, id_col, text_col)
    text = F.coalesce(col(text_col), F.lit(""))
    assign = F.filter(spans(text, ASSIGN, 0), lambda s: F.length(
        F.regexp_replace(s["match"], "^" + KEYWORD, "")
    ) >= MIN_VALUE)
    base = F.concat(bare(assign), bare(spans(text, ACCESS, 1)), bare(spans(text, HEX, 2)))
    weak = F.concat(*[bare(spans(text, pattern, k + 3)) for k, pattern in enumerate(PARTS.values())])
    # parts of one kind only link to nothing
    kinds = F.array_distinct(F.transform(weak, lambda s: s["kind"]))
    weak = F.when(F.array_contains(kinds, 4) & (F.size(kinds) > 1), weak)
    found = materialize(own.select("_id", "_t1", "_t2", base.alias("base"), weak.alias("weak")), "spans")

    keys = ["_t1", "_t2"]
    parts = found.where("weak is not null").select(*keys, F.explode("weak").alias("w")).select(*keys, "w.*").distinct()
    links = linked_parts(parts, keys, scope).groupBy(*keys).agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("linked")
    )
    links = materialize(links.withColumnsRenamed({"_t1": "_l1", "_t2": "_l2"}), "linked")
    on = reduce(lambda a, b: a & b, (F.col("_t1") == F.col("_l1"), F.col("_t2") == F.col("_l2")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return found.join(links, on, "left").select(F.col("_id").alias(id_col), "base", F.coalesce("linked", none).alias("linked"))


def op5_secrets(spark: SparkSession, base: str) -> DataFrame:
    found = find_secrets(table(spark, base, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listing(F.col("base")), 256).alias("base_sha256"), listing(F.concat("base", "linked")).alias("spans"),
    )


QUERIES = {"op5_secrets": op5_secrets}
SQL: dict[str, str] = {}
