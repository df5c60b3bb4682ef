"""Run snapshots of the raw input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohorts.sources.csv import read_csv_text


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path is there, on whatever file system the session knows."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of the inputs exists: {', '.join(candidates)}")


def holds_parquet(spark: SparkSession, path: str) -> bool:
    """True if the path, or a file in the folder it is, ends in .parquet."""
    if path.rstrip("/").endswith(".parquet"):
        return True
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)]
    return any(n.endswith(".parquet") for n in names)


def load_raw(spark: SparkSession, candidates: list[str], format: str | None = None) -> DataFrame:
    """The first candidate that exists, as ``format`` ("parquet" or "csv"); by default its files' names decide."""
    path = first_existing(spark, candidates)
    if format is None:
        format = "parquet" if holds_parquet(spark, path) else "csv"
    return spark.read.parquet(path) if format == "parquet" else read_csv_text(spark, path)


def snapshot(df: DataFrame, root: str, run_id: str) -> DataFrame:
    """Write the input under ``root/run_id=...`` and hand back what was written."""
    path = f"{root.rstrip('/')}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_snapshot(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """One run of the snapshot root; only that run's folder is listed and read."""
    return spark.read.parquet(f"{root.rstrip('/')}/run_id={run_id}")
