"""Synthetic customers for trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.schema import FEATURES, KEY


def _uniform(row: Column, tag: str) -> Column:
    """Uniform in [0, 1) from row key and tag: the same after any task retry or repartition."""
    digest = F.md5(F.concat(row.cast("string"), F.lit(f":{tag}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def synthetic_customers(
    keys: DataFrame, row: str = "id", seed: int = 42, span: float = 100.0, step: int = 50, features: list[str] = FEATURES
) -> DataFrame:
    """One synthetic customer per row of ``keys``: ``span`` times a uniform plus a whole number below ``step``."""
    r = F.col(row)
    values = [
        (_uniform(r, f"{f}:a:{seed}") * F.lit(span) + F.floor(_uniform(r, f"{f}:b:{seed}") * F.lit(float(step)))).alias(f)
        for f in features
    ]
    return keys.select(F.concat(F.lit("DUMMY_CUST"), r.cast("string")).alias(KEY), *values)


def generate_customers(spark: SparkSession, n: int, **options) -> DataFrame:
    return synthetic_customers(spark.range(1, n + 1), "id", **options)
