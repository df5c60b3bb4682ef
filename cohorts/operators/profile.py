"""Profiling of numeric columns: the figures behind tables and plots."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorts.functions import kernels
from cohorts.functions.columns import col, double_sql, ident, number, numeric_columns
from cohorts.operators.quantiles import DIRECT_ROWS, exact_quantiles
from cohorts.operators.validate import null_shares
from cohorts.schema import KEY

QUARTILES = [0.25, 0.5, 0.75]
STATISTICS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
DESCRIBE_SCHEMA = "ord int, column string, count bigint, " + ", ".join(f"{s} double" for s in STATISTICS[1:])
WHISKER = 1.5
DENSITY_GRID = 200
# Cells per bandwidth, and bandwidths beyond which a row adds nothing (under 1e-13 of its peak).
DENSITY_CELLS, DENSITY_REACH = 64, 8.0
SAMPLE_ROWS = 1000
STRONG_CORRELATION = 0.7


def column_facts(df: DataFrame, columns: list[str], direct_rows: int = DIRECT_ROWS) -> dict[str, dict]:
    """Count, moments, range and exact quartiles per column: a driver table as wide as ``columns``."""
    wanted = []
    for i, c in enumerate(columns):
        value = double_sql(df, c)
        wanted += [
            f"count({value}) as n{i}", f"avg({value}) as m{i}", f"try_divide(var_pop({value}) * count({value}), count({value}) - 1) as v{i}",
            f"min({value}) as lo{i}", f"max({value}) as hi{i}", f"skewness({value}) as k{i}",
        ]
    row = df.selectExpr(*wanted).first()
    counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    quartiles = exact_quantiles(df, columns, QUARTILES, counts, direct_rows)
    return {
        c: {
            "count": counts[c], "mean": row[f"m{i}"], "std": None if row[f"v{i}"] is None else math.sqrt(row[f"v{i}"]),
            "min": row[f"lo{i}"], "q25": quartiles[c][0], "q50": quartiles[c][1], "q75": quartiles[c][2],
            "max": row[f"hi{i}"], "skewness": row[f"k{i}"],
        }
        for i, c in enumerate(columns)
    }


def describe(
    df: DataFrame, columns: list[str] | None = None, facts: dict[str, dict] | None = None
) -> DataFrame:
    """One row per numeric column: count, mean, sample deviation, range, exact quartiles."""
    columns = columns or numeric_columns(df)
    facts = facts or column_facts(df, columns)
    rows = [(i, c, *[facts[c][s] for s in STATISTICS]) for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per text column: count, distinct values, most frequent value and its count; ties go to the smallest value.

    One scan for all columns: cells are unpivoted and counted by column and value, on the map side first, so a frequent
    value is one row a task when it is shuffled; the second step keeps one row a column and task.
    """
    cells = F.posexplode(F.array(*[col(c).cast("string") for c in columns])).alias("ord", "v")
    counts = df.select(cells).where("v is not null").groupBy("ord", "v").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("ord").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("best")
    )
    # one row a column, also for those without values
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "ord int, column string")
    zero = F.lit(0).cast("bigint")
    return names.join(F.broadcast(found), "ord", "left").select(
        "column", F.coalesce("count", zero).alias("count"), F.coalesce("unique", zero).alias("unique"),
        F.col("best.v").alias("top"), (-F.col("best.n")).alias("freq"),
    )


def describe_all(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column, numbers and texts alike, in the frame's order; what doesn't apply to a column is NULL."""
    columns = columns or df.columns
    numbers = [c for c in numeric_columns(df) if c in columns]
    texts = [c for c in columns if c not in numbers]
    parts = [describe(df, numbers).drop("ord")] if numbers else []
    parts += [describe_text(df, texts)] if texts else []
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    place = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
    have = [
        F.col(s) if s in table.columns else F.lit(None).cast(kind).alias(s)
        for s, kind in [("count", "bigint"), ("unique", "bigint"), ("top", "string"), ("freq", "bigint"), *[(s, "double") for s in STATISTICS[1:]]]
    ]
    return table.select(place[F.col("column")].alias("ord"), "column", *have)


def frame_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records")).withColumn("features", F.lit(len(df.columns)))


def null_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Only columns that have missing values."""
    return null_shares(df, columns or df.columns).where("nulls > 0").select("ord", "column", "nulls")


def bin_layout(fact: dict) -> tuple[float, float, int]:
    """First edge, last edge and number of equal bins.

    Width: the narrower of Sturges' and Freedman-Diaconis', the latter no
    narrower than half the square-root rule, which keeps bins below 2 sqrt(n).
    """
    n, low, high = fact["count"], fact["min"], fact["max"]
    if not n:
        return 0.0, 1.0, 1
    if low == high:
        return low - 0.5, high + 0.5, 1
    span = high - low
    sturges = span / (math.log2(n) + 1.0)
    freedman = 2.0 * (fact["q75"] - fact["q25"]) / n ** (1.0 / 3.0)
    width = min(max(freedman, span / math.sqrt(n) / 2.0), sturges)
    return low, high, int(math.ceil(span / width))


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(ord, value)``, one per present cell."""
    cells = ", ".join(double_sql(df, c) for c in columns)
    return df.selectExpr(f"posexplode(array({cells})) as (ord, value)").where("value is not null")


def histogram(df: DataFrame, columns: list[str] | None = None, facts: dict[str, dict] | None = None) -> DataFrame:
    """Rows ``(column, bin, left, right, count)`` for every bin, empty ones included."""
    spark = df.sparkSession
    columns = columns or numeric_columns(df)
    facts = facts or column_facts(df, columns)
    layout = [(i, c, *bin_layout(facts[c])) for i, c in enumerate(columns)]
    plan = F.broadcast(spark.createDataFrame(layout, "ord int, column string, low double, high double, bins int"))
    width = (F.col("high") - F.col("low")) / F.col("bins")
    place = F.least(F.floor((F.col("value") - F.col("low")) / width), F.col("bins") - 1).cast("int")
    counted = (
        _long(df, columns).join(plan, "ord").groupBy("ord", place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    )
    every = plan.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)))
    return every.join(counted, ["ord", "bin"], "left").select(
        "column", "bin",
        (F.col("low") + F.col("bin") * width).alias("left"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("right"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def density(
    df: DataFrame,
    columns: list[str] | None = None,
    facts: dict[str, dict] | None = None,
    grid: int = DENSITY_GRID,
    cells: int = DENSITY_CELLS,
) -> DataFrame:
    """Gaussian density on a grid of each column, bandwidth by Scott's rule.

    Rows are first folded to cells of 1/``cells`` of the bandwidth. A cell stands at its mean and adds its
    spread by the kernel's second derivative, so folding stays below the sixth digit whatever the column's
    tails, and only cells with rows exist. A cell meets only grid points in its reach. Columns without
    spread have no curve.
    """
    spark = df.sparkSession
    columns = columns or numeric_columns(df)
    facts = facts or column_facts(df, columns)
    rows = []
    for i, c in enumerate(columns):
        f = facts[c]
        if f["count"] > 1 and f["std"]:
            rows.append((i, c, f["min"], f["max"], f["count"], f["std"] * f["count"] ** -0.2))
    plan = F.broadcast(
        spark.createDataFrame(rows, "ord int, column string, low double, high double, n bigint, h double")
    )
    folded = (
        _long(df, columns)
        .join(plan, "ord")
        .groupBy("ord", F.floor((F.col("value") - F.col("low")) / F.col("h") * cells).alias("cell"))
        .agg(F.count(F.lit(1)).alias("weight"), F.avg("value").alias("at"), F.var_pop("value").alias("spread"))
    )
    step = f"((high - low) / {number(grid - 1)})"
    first = F.expr(f"cast(greatest(0, ceil((at - {number(DENSITY_REACH)} * h - low) / {step})) as int)")
    last = F.expr(f"cast(least({grid - 1}, floor((at + {number(DENSITY_REACH)} * h - low) / {step})) as int)")
    x = F.expr(f"low + point * (high - low) / {number(grid - 1)}")
    met = folded.join(plan, "ord").withColumns({"first": first, "last": last}).where("first <= last")
    met = met.withColumn("point", F.explode(F.sequence("first", "last"))).withColumn("u2", F.pow((x - F.col("at")) / F.col("h"), F.lit(2.0)))
    height = F.expr("weight * exp(-0.5D * u2) * (1.0D + 0.5D * spread * (u2 - 1.0D) / (h * h))")
    sums = met.groupBy("ord", "point").agg(F.sum(height).alias("s"))
    every = plan.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))).withColumn("x", x)
    return every.join(sums, ["ord", "point"], "left").select(
        "column", "point", "x", F.expr("coalesce(s, 0.0D) / (n * h * sqrt(2.0D * pi()))").alias("density")
    )


def _fences(fact: dict) -> tuple[float, float]:
    reach = WHISKER * (fact["q75"] - fact["q25"])
    return fact["q25"] - reach, fact["q75"] + reach


def box_stats(df: DataFrame, columns: list[str] | None = None, facts: dict[str, dict] | None = None) -> DataFrame:
    """Quartiles, whiskers at the most extreme rows inside the fences, and the number of rows outside."""
    columns = columns or numeric_columns(df)
    facts = facts or column_facts(df, columns)
    wanted = []
    for i, c in enumerate(columns):
        if facts[c]["count"]:
            value, (low, high) = double_sql(df, c), _fences(facts[c])
            inside = f"{value} between {number(low)} and {number(high)}"
            wanted += [
                f"min(case when {inside} then {value} end) as lo{i}",
                f"max(case when {inside} then {value} end) as hi{i}",
                f"count_if(not ({inside})) as out{i}",
            ]
    row = df.selectExpr(*wanted).first()
    rows = [
        (i, c, facts[c]["q25"], facts[c]["q50"], facts[c]["q75"], row[f"lo{i}"], row[f"hi{i}"], row[f"out{i}"])
        for i, c in enumerate(columns)
        if facts[c]["count"]
    ]
    return df.sparkSession.createDataFrame(
        rows, "ord int, column string, q25 double, q50 double, q75 double, low double, high double, outliers bigint"
    )


def outlier_rows(df: DataFrame, columns: list[str], key: str = KEY, facts: dict[str, dict] | None = None) -> DataFrame:
    """Rows ``(key, column, value)`` of all cells outside the fences."""
    facts = facts or column_facts(df, columns)
    cells = []
    for c in columns:
        value, (low, high) = double_sql(df, c), _fences(facts[c])
        text = c.replace("'", "\\'")
        cells.append(
            f"case when {value} < {number(low)} or {value} > {number(high)} "
            f"then named_struct('column', '{text}', 'value', {value}) end"
        )
    return df.selectExpr(ident(key), f"inline(filter(array({', '.join(cells)}), c -> c is not null))")


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson coefficient of all column pairs over rows where both are present.

    Rows ``(a, b, r)``; NULL where a column has no spread. Each task adds up the
    products of its rows as one small matrix, so a row is read once for all pairs.
    """
    spark = df.sparkSession
    columns = columns or numeric_columns(df)
    p = len(columns)
    if p < 2:
        return spark.createDataFrame([], "a string, b string, r double")
    centre = df.selectExpr(*[f"avg({double_sql(df, c)}) as m{i}" for i, c in enumerate(columns)]).first()
    shifted = df.selectExpr(
        *[f"{double_sql(df, c)} - {number(centre[f'm{i}'] or 0.0)} as c{i}" for i, c in enumerate(columns)]
    )
    parts = shifted.mapInPandas(
        kernels.product_sums(p), "i int, j int, n double, x double, y double, xx double, yy double, xy double"
    )
    names = F.broadcast(spark.createDataFrame(list(enumerate(columns)), "k int, name string"))
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    # A spread below rounding error of its own sum counts as none.
    sums = sums.selectExpr(
        "i", "j", "xy - x * y / nullif(n, 0.0D) as c",
        "case when xx - x * x / nullif(n, 0.0D) > 1e-13D * xx then xx - x * x / n end as vx",
        "case when yy - y * y / nullif(n, 0.0D) > 1e-13D * yy then yy - y * y / n end as vy",
    )
    named = sums.join(names.selectExpr("k as i", "name as a"), "i").join(names.selectExpr("k as j", "name as b"), "j")
    r = F.expr("case when i = j then 1.0D else greatest(-1.0D, least(1.0D, c / sqrt(vx) / sqrt(vy))) end")
    return named.select("a", "b", F.when(F.expr("vx is not null and vy is not null"), r).alias("r"))


def pair_sample(
    df: DataFrame, columns: list[str] | None = None, key: str = KEY, rows: int = SAMPLE_ROWS, seed: int = 42
) -> DataFrame:
    """Pairs of values of a uniform sample, for 2 to 5 numeric columns; no row otherwise.

    The sample is the ``rows`` smallest key hashes: repeatable, and a top-k rather than a sort.
    """
    spark = df.sparkSession
    columns = columns or numeric_columns(df)
    if not 2 <= len(columns) <= 5:
        return spark.createDataFrame([], f"{ident(key)} string, a string, b string, x double, y double")
    picked = (
        df.withColumn("_h", F.md5(F.concat(col(key).cast("string"), F.lit(f":{seed}"))))
        .orderBy("_h", key)
        .limit(rows)
    )
    pairs = ", ".join(
        f"named_struct('a', '{a}', 'b', '{b}', 'x', {double_sql(df, a)}, 'y', {double_sql(df, b)})"
        for i, a in enumerate(columns)
        for b in columns[i:]
    )
    return picked.selectExpr(ident(key), f"inline(array({pairs}))")


def profile_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long table ``(section, column, statistic, value)``: overview, statistics, nulls and what stands out."""
    spark = df.sparkSession
    columns = columns or numeric_columns(df)
    facts = column_facts(df, columns)
    schema = "section string, column string, statistic string, value double"
    rows = [("overview", None, "features", float(len(df.columns)))]
    for c in columns:
        rows += [("statistics", c, s, None if facts[c][s] is None else float(facts[c][s])) for s in STATISTICS]
        rows.append(("insights", c, "skewness", facts[c]["skewness"]))
    small = spark.createDataFrame(rows, schema)
    records = df.selectExpr("'overview' as section", "cast(null as string) as column", "'records' as statistic", "cast(count(1) as double) as value")
    nulls = null_summary(df).selectExpr("'nulls' as section", "column", "'nulls' as statistic", "cast(nulls as double) as value")
    boxes = box_stats(df, columns, facts).selectExpr(
        "'insights' as section", "column", "'outlier_share' as statistic",
        "outliers / " + "element_at(map(" + ", ".join(f"'{c}', {number(max(1, facts[c]['count']))}" for c in columns) + "), column) as value",
    )
    strong = (
        correlations(df, columns)
        .where((F.col("a") < F.col("b")) & (F.abs("r") > STRONG_CORRELATION))
        .selectExpr("'insights' as section", "a as column", "concat('correlation with ', b) as statistic", "r as value")
    )
    return small.unionByName(records).unionByName(nulls).unionByName(boxes).unionByName(strong)
