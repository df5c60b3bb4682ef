"""Column, type and null checks as report rows, and the split of bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorts.functions.columns import (
    INTEGER_PATTERN,
    NUMBER_PATTERN,
    TRUTH_PATTERN,
    as_double,
    blank_to_null,
    col,
    text_to_long,
)
from cohorts.schema import EXPECTED_TYPES, KEY
from cohorts.session import materialize

REPORT_SCHEMA = (
    "ord int, section string, check string, column string, status string, message string, severity string"
)
NULL_THRESHOLD = 50.0


def check_columns(spark: SparkSession, columns: list[str], expected: dict[str, str] = EXPECTED_TYPES) -> DataFrame:
    """One row: are all expected columns there? Needs no pass over the data."""
    missing = [c for c in expected if c not in columns]
    status = "FAIL" if missing else "SUCCESS"
    message = f"Missing columns: {missing}" if missing else "All expected columns present."
    row = (0, "schema_validation", "Column Presence", None, status, message, "hard")
    return spark.createDataFrame([row], REPORT_SCHEMA)


def _type_facts(df: DataFrame, name: str):
    """Aggregates telling what a type-inferring reader would make of the column."""
    kind = df.schema[name].dataType
    c = col(name)
    if isinstance(kind, T.StringType):
        text = blank_to_null(c)
        return {
            "present": F.count(text),
            "words": F.count_if(text.isNotNull() & ~text.rlike(NUMBER_PATTERN)),
            "truths": F.count_if(text.rlike(TRUTH_PATTERN)),
            "decimals": F.count_if(text.isNotNull() & ~text.rlike(INTEGER_PATTERN)),
            "fractions": F.count_if(text.rlike(NUMBER_PATTERN) & text_to_long(text).isNull()),
        }
    zero, present = F.lit(0).cast("bigint"), F.count(c)
    if isinstance(kind, T.BooleanType):
        return {"present": present, "words": present, "truths": present, "decimals": present, "fractions": present}
    if isinstance(kind, T.IntegralType):
        return {"present": present, "words": zero, "truths": zero, "decimals": zero, "fractions": zero}
    if isinstance(kind, T.NumericType):
        value = as_double(df, name)
        fractions = F.count_if(value.isNotNull() & (value != F.floor(value)))
        present = F.count(value)
        return {"present": present, "words": zero, "truths": zero, "decimals": present, "fractions": fractions}
    return {"present": present, "words": present, "truths": zero, "decimals": present, "fractions": present}


def _missing_count(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.count_if(blank_to_null(col(name)).isNull())
    if isinstance(kind, T.NumericType):
        return F.count_if(as_double(df, name).isNull())
    return F.count_if(col(name).isNull())


def inferred_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column the inferred type and whether all its numbers are whole, in one pass.

    All whole and none missing gives int64; numbers with a fraction or a gap
    give float64; a column of truth values gives bool; the rest is object.
    """
    facts = []
    for name in columns:
        f = _type_facts(df, name)
        facts.append(
            F.struct(
                F.lit(name).alias("column"),
                *[v.cast("bigint").alias(k) for k, v in f.items()],
                F.count(F.lit(1)).alias("rows"),
            )
        )
    rows = df.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))
    all_present = F.col("present") == F.col("rows")
    is_bool = (F.col("truths") == F.col("present")) & all_present & (F.col("present") > 0)
    inferred = (
        F.when(is_bool, "bool")
        .when(F.col("words") > 0, "object")
        .when((F.col("decimals") == 0) & all_present & (F.col("rows") > 0), "int64")
        .when(F.col("rows") == 0, "object")
        .otherwise("float64")
    )
    return rows.select(
        "column",
        inferred.alias("inferred"),
        ((F.col("words") == 0) & (F.col("fractions") == 0)).alias("whole"),
        "rows",
        "present",
    )


def check_types(df: DataFrame, expected: dict[str, str] = EXPECTED_TYPES, facts: DataFrame | None = None) -> DataFrame:
    """Type rows of the report: compatible numbers leave no row, a mismatch only warns. ``facts`` are those of :func:`inferred_types`."""
    columns = [c for c in expected if c in df.columns]
    facts = inferred_types(df, columns) if facts is None else facts
    wanted = F.create_map(*[F.lit(x) for c in columns for x in (c, expected[c])])
    order = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i + 1)])
    want, have = wanted[F.col("column")], F.col("inferred")
    compatible = ((want == "float64") & have.isin("int64", "float64")) | (
        (want == "int64") & ((have == "int64") | ((have == "float64") & F.col("whole")))
    )
    equal = want == have
    message = F.format_string(
        "Data type mismatch for column '%s'. Expected: %s, Actual: %s", F.col("column"), want, have
    )
    return facts.where(~compatible).select(
        order[F.col("column")].alias("ord"),
        F.lit("schema_validation").alias("section"),
        F.concat(F.lit("Data Type - "), F.col("column")).alias("check"),
        "column",
        F.when(equal, "SUCCESS").otherwise("FAIL").alias("status"),
        F.when(~equal, message).alias("message"),
        F.lit("warn").alias("severity"),
    )


def whole_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: is every present value a whole number? No value at all counts as yes."""
    value = {c: as_double(df, c) for c in columns}
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(F.bool_and(value[c] == F.floor(value[c])), F.lit(True)).alias("whole"),
        )
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def null_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(column, ord, nulls, rows, percent)`` from one pass; percent is NULL on an empty frame."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(i).alias("ord"),
            _missing_count(df, c).cast("bigint").alias("nulls"),
            F.count(F.lit(1)).alias("rows"),
        )
        for i, c in enumerate(columns)
    ]
    rows = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return _with_percent(rows)


def _with_percent(shares: DataFrame) -> DataFrame:
    percent = F.col("nulls") / F.nullif(F.col("rows"), F.lit(0).cast("bigint")) * F.lit(100.0)
    return shares.withColumn("percent", percent)


def check_nulls(
    df: DataFrame, expected: dict[str, str] = EXPECTED_TYPES, threshold: float = NULL_THRESHOLD, facts: DataFrame | None = None
) -> DataFrame:
    """Null-share rows of the report, in the frame's column order. ``facts`` are those of :func:`inferred_types`."""
    columns = [c for c in df.columns if c in expected]
    if facts is None or not columns:
        shares = null_shares(df, columns)
    else:
        order = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
        gaps = (F.col("rows") - F.col("present")).alias("nulls")
        shares = _with_percent(facts.select("column", order[F.col("column")].alias("ord"), gaps, "rows"))
    too_many = F.col("percent") > F.lit(threshold)
    empty = F.col("rows") == 0
    share = F.format_string("%.2f", F.col("percent"))
    return shares.select(
        "ord",
        F.lit("null_validation").alias("section"),
        F.concat(F.lit("Null Values - "), F.col("column")).alias("check"),
        "column",
        F.when(empty | too_many, "FAIL").otherwise("SUCCESS").alias("status"),
        F.when(empty, "no rows")
        .when(
            too_many,
            F.concat(
                F.lit("Column '"), F.col("column"), F.lit("' has "), share,
                F.lit("% null values, which exceeds threshold."),
            ),
        )
        .otherwise(F.concat(share, F.lit("% nulls.")))
        .alias("message"),
        F.when(empty, "hard").otherwise("warn").alias("severity"),
    )


def validation_report(
    df: DataFrame, expected: dict[str, str] = EXPECTED_TYPES, threshold: float = NULL_THRESHOLD
) -> DataFrame:
    """All checks from one pass over the data: a row of facts per column is written, and types and nulls read it."""
    present = check_columns(df.sparkSession, df.columns, expected)
    columns = [c for c in expected if c in df.columns]
    if not columns:
        return present
    facts = materialize(inferred_types(df, columns), "facts")
    return present.unionByName(check_types(df, expected, facts)).unionByName(check_nulls(df, expected, threshold, facts))


def status_rollup(report: DataFrame) -> DataFrame:
    """Status per section and for the run. Only hard failures fail the schema section and the run."""
    failed = F.col("status") == "FAIL"
    hard = F.count_if(failed & (F.col("severity") == "hard"))
    schema_hard = F.count_if(failed & (F.col("severity") == "hard") & (F.col("section") == "schema_validation"))
    null_any = F.count_if(failed & (F.col("section") == "null_validation"))

    def entry(name, count):
        return F.struct(F.lit(name).alias("section"), F.when(count > 0, "FAIL").otherwise("SUCCESS").alias("status"))

    return report.agg(
        F.array(
            entry("schema_validation", schema_hard), entry("null_validation", null_any), entry("run", hard)
        ).alias("cells")
    ).select(F.inline("cells"))


def split_bad_rows(
    text: DataFrame, expected: dict[str, str] = EXPECTED_TYPES, key: str = KEY, whole: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows whose cells are all usable, and the others with the offending columns named.

    A word or an infinite value where a number is expected makes a row unusable. A fraction in a
    whole-number column does not, unless ``whole`` asks for it.
    """
    reasons = []
    for name, kind in expected.items():
        if name not in text.columns or kind == "object":
            continue
        c = col(name)
        if isinstance(text.schema[name].dataType, T.StringType):
            cell = blank_to_null(c)
            bad = ~cell.rlike(NUMBER_PATTERN) | cell.rlike(r"(?i)^\s*[+-]?inf(inity)?\s*$")
            if whole and kind == "int64":
                bad = bad | text_to_long(cell).isNull()
            reasons.append(F.when(cell.isNotNull() & bad, F.lit(name)))
        else:
            value = as_double(text, name)
            bad = F.abs(value) == float("inf")
            if whole and kind == "int64":
                bad = bad | (value != F.floor(value))
            reasons.append(F.when(value.isNotNull() & bad, F.lit(name)))
    if key in text.columns:
        reasons.append(F.when(col(key).isNull(), F.lit(key)))
    reason = F.concat_ws(",", *reasons) if reasons else F.lit("")
    marked = text.withColumn("reason", reason)
    return marked.where(F.col("reason") == "").drop("reason"), marked.where(F.col("reason") != "")
