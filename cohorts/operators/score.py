"""Labelling new rows and summing up labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorts.functions.columns import col, double_sql, ident
from cohorts.operators.dbscan import DensityFit, assign_by_model
from cohorts.operators.kmeans import KMeansFit, assign
from cohorts.operators.prepare import FeatureParam, apply_preprocessor, impute, scale
from cohorts.schema import KEY, LABEL
from cohorts.session import materialize


def align(df: DataFrame, params: list[FeatureParam], key: str = KEY) -> DataFrame:
    """Key and the fitted features in fitted order; any input order and extra columns are accepted."""
    missing = [p.feature for p in params if p.feature not in df.columns]
    if missing:
        raise ValueError(f"input lacks the columns {', '.join(missing)}")
    keep = [key] if key in df.columns else []
    return df.select(*keep, *[col(p.feature) for p in params])


def score(
    df: DataFrame, params: list[FeatureParam], model: KMeansFit | DensityFit, label: str = LABEL, places: int | None = None
) -> DataFrame:
    """The input as it is, with the cluster number in ``label``.

    With centres, these and the parameters travel as literals: one narrow stage for any input size. A density model gives
    each row the cluster of its nearest core row; for that, rows are written with numbers of their own, so null and
    repeated keys do no harm.
    """
    align(df, params)
    names = [p.feature for p in params]
    raw = [c for c in df.columns if c != label]
    if isinstance(model, DensityFit):
        rows = df.select(F.monotonically_increasing_id().alias("_id"), F.struct(*[col(c) for c in raw]).alias("_row"))
        rows = materialize(rows, "batch")
        plain = rows.select("_id", *[F.col("_row")[c].alias(c) for c in names])
        labels = assign_by_model(model, apply_preprocessor(plain, params, "_id", places), "_id", "_label")
        return rows.join(labels, "_id").select("_row.*", F.col("_label").alias(label))
    carried = df.select(F.struct(*[col(c) for c in raw]).alias("_row"), *[col(c) for c in names])
    placed = assign(scale(impute(carried, params), params, places), model.features, model.centres, "_label")
    return placed.select("_row.*", F.col("_label").alias(label))


def distribution(labelled: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per label in label order; rows without a label are left out."""
    return (
        labelled.where(col(label).isNotNull())
        .groupBy(col(label).alias(label))
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(label)
    )


def totals(labelled: DataFrame, label: str = LABEL) -> DataFrame:
    """Row count and number of distinct labels, from the per-label counts."""
    per_label = labelled.groupBy(col(label).alias("_l")).agg(F.count(F.lit(1)).alias("n"))
    return per_label.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_customers"), F.count("_l").alias("num_clusters_found")
    )


def means_per_cluster(labelled: DataFrame, features: list[str], label: str = LABEL) -> DataFrame:
    means = [F.expr(f"avg({ident(f)}) as {ident(f)}") for f in features]
    return labelled.groupBy(label).agg(F.count(F.lit(1)).alias("size"), *means)


def summary(labelled: DataFrame, features: list[str], label: str = LABEL) -> DataFrame:
    """One aggregate for all: size and means per label, with the number of rows and of labels on each row."""
    per_label = means_per_cluster(labelled.where(col(label).isNotNull()), features, label)
    every = Window.partitionBy(F.lit(0))  # a row per label, no more
    return per_label.withColumns(
        {"total_customers": F.sum("size").over(every), "num_clusters_found": F.count(F.lit(1)).over(every)}
    )


def label_sums(labelled: DataFrame, features: list[str], label: str = LABEL) -> DataFrame:
    """What means per label are made of, to be added up with those of other batches: rows, and per feature a sum and a count."""
    cells = [e for i, f in enumerate(features) for e in (
        F.expr(f"sum({double_sql(labelled, f)}) as s{i}"), F.expr(f"count({double_sql(labelled, f)}) as n{i}")
    )]
    return labelled.where(col(label).isNotNull()).groupBy(col(label).alias(label)).agg(F.count(F.lit(1)).alias("size"), *cells)


def merged_summary(sums: DataFrame, features: list[str], label: str = LABEL) -> DataFrame:
    """The rows of :func:`summary` from any number of :func:`label_sums`."""
    means = [F.expr(f"sum(s{i}) / nullif(sum(n{i}), 0) as {ident(f)}") for i, f in enumerate(features)]
    per_label = sums.groupBy(label).agg(F.sum("size").alias("size"), *means)
    every = Window.partitionBy(F.lit(0))  # a row per label, no more
    return per_label.withColumns(
        {"total_customers": F.sum("size").over(every), "num_clusters_found": F.count(F.lit(1)).over(every)}
    )


def preview(df: DataFrame, key: str = KEY, rows: int = 20) -> DataFrame:
    """First and last rows by key, ``rows`` at most, each row once, also where rows share a key."""
    half = rows // 2
    if df.limit(rows + 1).count() <= 2 * half:
        return df
    head = df.orderBy(col(key).asc()).limit(half)
    tail = df.orderBy(col(key).desc()).limit(half)
    return head.unionByName(tail)
