"""Batch scoring: CSV in, labelled CSV out."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohorts.operators.dbscan import dbscan
from cohorts.operators.prepare import FeatureParam, apply_preprocessor
from cohorts.operators.score import align, label_sums, merged_summary, score
from cohorts.operators.validate import split_bad_rows
from cohorts.schema import EXPECTED_TYPES, KEY, LABEL
from cohorts.session import materialize, own_scratch
from cohorts.sources.csv import read_csv_text, write_csv
from cohorts.sources.store import load_model, save_report


@dataclass(frozen=True)
class BatchResult:
    output: str
    records: int
    ok: bool
    message: str
    rejected: int = 0


def score_file(
    spark: SparkSession, source: str, model_path: str, output: str, places: int | None = None, rejects: str | None = None,
    summary: str | None = None,
) -> BatchResult:
    """One lazy chain and one write (a density model needs rounds before it); the row count is observed while writing. Failures raise.

    The cells stay the text they were; only the scoring sees numbers. With a folder for ``rejects``, rows with words in
    number columns are written there with the reason, and the others are scored. With a folder for ``summary``, sizes and
    means per label go there as a JSON report, from the rows as they were scored.
    """
    params, model = load_model(spark, model_path)
    rows, rejected = read_csv_text(spark, source), 0
    if rejects:
        rows, bad = split_bad_rows(rows, {**{p.feature: "float64" for p in params}, **EXPECTED_TYPES})
        watch = Observation(f"rejected-{uuid.uuid4().hex}")
        bad.observe(watch, F.count(F.lit(1)).alias("records")).write.mode("overwrite").parquet(rejects)
        rejected = watch.get["records"]
    seen = Observation(f"scored-{uuid.uuid4().hex}")
    with own_scratch(spark):
        labelled = score(rows, params, model, places=places)
        if summary:
            features = [p.feature for p in params]
            labelled = materialize(labelled, "labelled")
            save_report(merged_summary(label_sums(labelled, features), features), summary)
        write_csv(labelled.observe(seen, F.count(F.lit(1)).alias("records")), output)
    return BatchResult(output, seen.get["records"], True, "Batch scoring completed.", rejected)


def density_score(
    df: DataFrame,
    params: list[FeatureParam],
    eps: float,
    min_samples: int,
    key: str = KEY,
    label: str = LABEL,
    places: int | None = None,
) -> DataFrame:
    """The batch clustered anew, by itself; :func:`score_file` with a saved density model labels by nearest core rows instead."""
    scaled = apply_preprocessor(align(df, params, key), params, key, places)
    labels = dbscan(scaled, [p.feature for p in params], eps, min_samples, key, label)
    return df.drop(label).join(labels, key)
