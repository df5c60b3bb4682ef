"""Reading the given tables, and small column expressions shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions.columns import col

Query = Callable[[SparkSession, str], DataFrame]

# The white space between words, and the letters that are lower-cased.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where ``use`` needs it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def two_hashes(text: Column) -> tuple[Column, Column]:
    """128 bits in two columns, for keys of tables too large for 64-bit digests."""
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def row_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds ``_id``, ``_t1``, ``_t2``: rows that agree in id and text share a key, and nothing else does."""
    first, second = two_hashes(F.coalesce(col(text_col), F.lit("")))
    return df.withColumns({"_id": col(id_col), "_t1": first, "_t2": second})


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns of two frames."""
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out
