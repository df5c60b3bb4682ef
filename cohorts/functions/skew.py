"""Joins and numbering that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorts.functions.columns import col, ident
from cohorts.session import materialize

# A key is hot when it owns more than one row in HOT_SHARE, so there are fewer than HOT_SHARE of them.
HOT_SHARE = 1000
SAFE_ROWS = 2_000_000


def hot_keys(df: DataFrame, key: str, rows: int, safe_rows: int = SAFE_ROWS) -> list:
    """Values of ``key`` that own more than 1/HOT_SHARE of the rows; none if all rows fit one task."""
    if rows <= safe_rows:
        return []
    counts = df.where(col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return [r[key] for r in counts.where(F.col("_n") * HOT_SHARE > rows).collect()]


def likely_hot_keys(df: DataFrame, key: str, safe_rows: int = SAFE_ROWS) -> list:
    """Like :func:`hot_keys`, by a sketch that every task fills for itself: nothing is shuffled, and a key close to the share may be on either side."""
    rows = df.count()
    if rows <= safe_rows:
        return []
    found = df.agg(F.expr(f"approx_top_k({ident(key)}, {HOT_SHARE}, {10 * HOT_SHARE})").alias("t")).first()["t"]
    return [r["item"] for r in found or [] if r["item"] is not None and r["count"] * HOT_SHARE > rows]


def lookup(big: DataFrame, table: DataFrame, key: str, how: str = "left", hot: list | None = None) -> DataFrame:
    """Join ``table`` (one row per key) to ``big``; hot keys go by broadcast, the rest by shuffle."""
    if not hot:
        return big.join(table, key, how)
    is_hot = F.coalesce(col(key).isin(hot), F.lit(False))
    cold = big.where(~is_hot).join(table, key, how)
    warm = big.where(is_hot).join(F.broadcast(table.where(col(key).isin(hot))), key, how)
    return cold.unionByName(warm)


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """Adds 0, 1, 2, ... in the order of a unique column, without sorting in one task.

    Rows are range-partitioned and sorted; the row counts of the partitions,
    one number each, give every partition its starting number.
    """
    placed = df.repartitionByRange(order).sortWithinPartitions(order)
    mid = F.monotonically_increasing_id()
    placed = materialize(placed.withColumns({"_part": F.shiftright(mid, 33), "_row": mid.bitwiseAND((1 << 33) - 1)}), "order")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    start, rows = 0, []
    for r in sizes:
        rows.append((r["_part"], start))
        start += r["n"]
    offsets = df.sparkSession.createDataFrame(rows, "_part bigint, _start bigint")
    out = placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_start") + F.col("_row"))
    return out.drop("_part", "_row", "_start")
