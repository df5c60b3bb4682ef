"""Scoring of CSV files as they land in a folder."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohorts.functions.columns import blank_to_null
from cohorts.operators.score import label_sums, merged_summary, score
from cohorts.operators.validate import split_bad_rows
from cohorts.schema import EXPECTED_TYPES, LABEL
from cohorts.session import materialize, own_scratch
from cohorts.sources.csv import QUOTES
from cohorts.sources.store import load_current


def read_landing(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Stream of ``(value, file)``: the lines of at most ``max_files`` new files a batch."""
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(folder)
    return raw.select("value", F.col("_metadata.file_path").alias("file"))


def bind_by_name(lines: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Text rows of ``columns`` from lines of CSV files, whatever order each file's header has; lines of files without such a header.

    Headers are collected, one per order that occurs, so at most one per file. Rows are lines: cells hold no line breaks.
    """
    spark = lines.sparkSession
    cells = F.transform(F.split(F.replace("value", F.lit('"'), F.lit("")), ","), lambda c: F.trim(c))
    wanted = F.array(*[F.lit(c) for c in columns])
    is_header = F.size(F.array_except(wanted, cells)) == 0
    headers = materialize(lines.where(is_header).groupBy("file").agg(F.min("value").alias("header")), "headers")
    parts = []
    for row in headers.select("header").distinct().collect():
        names = [n.strip() for n in next(csv.reader([row["header"]]))]
        kind = T.StructType([T.StructField(n, T.StringType()) for n in names])
        own = lines.join(F.broadcast(headers.where(F.col("header") == row["header"])), "file").where("value <> header and value <> ''")
        cell = F.from_csv("value", kind.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), QUOTES)
        parts.append(own.select(cell.alias("c")).select(*[blank_to_null(F.col("c")[n]).alias(n) for n in columns]))
    rows = parts[0] if parts else spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows, lines.join(F.broadcast(headers), "file", "left_anti").where("value <> ''")


def score_landing(
    spark: SparkSession,
    folder: str,
    serving_root: str,
    output: str,
    checkpoint: str,
    columns: list[str] | None = None,
    places: int | None = None,
    max_files: int = 1000,
    once: bool = True,
    rejects: str | None = None,
) -> StreamingQuery:
    """Score each micro-batch with the version published when the batch starts.

    Rows that can't be scored, and lines of files without the expected columns, go to ``rejects`` (by default
    beside ``output``) with a reason; the stream goes on. Stateless, so no watermark is needed. A batch writes
    its own folders and replaces them when retried, so each input row is in the result exactly once.
    """
    stream = read_landing(spark, folder, max_files)
    names = columns or list(EXPECTED_TYPES)
    beside = rejects or f"{output.rstrip('/')}-rejects"

    def handle(batch: DataFrame, batch_id: int) -> None:
        with own_scratch(batch.sparkSession):
            params, model = load_current(batch.sparkSession, serving_root)
            lines = batch.repartition(batch.sparkSession.sparkContext.defaultParallelism)  # a batch of few files would keep few cores busy
            rows, lost = bind_by_name(materialize(lines, "landed"), names)
            good, bad = split_bad_rows(materialize(rows, "rows"))
            scored, features = f"{output.rstrip('/')}/batch={batch_id}", [p.feature for p in params]
            score(good, params, model, places=places).write.mode("overwrite").parquet(scored)
            sums = label_sums(read_scored(spark, scored, names, batch=False), features)
            sums = sums.withColumn("features", F.array(*[F.lit(f) for f in features]))
            sums.coalesce(1).write.mode("overwrite").parquet(f"{output.rstrip('/')}-summary/batch={batch_id}")
            lost = lost.select(*[F.lit(None).cast("string").alias(c) for c in names], F.concat(F.lit("no header: "), "value").alias("reason"))
            bad.unionByName(lost).write.mode("overwrite").parquet(f"{beside}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_rejects(spark: SparkSession, rejects: str, columns: list[str] | None = None) -> DataFrame:
    """All rejected rows: the input's text columns and the reason."""
    fields = [T.StructField(c, T.StringType()) for c in [*(columns or EXPECTED_TYPES), "reason"]]
    return spark.read.schema(T.StructType([*fields, T.StructField("batch", T.LongType())])).parquet(rejects).drop("batch")


def read_scored(spark: SparkSession, output: str, columns: list[str] | None = None, batch: bool = True) -> DataFrame:
    """All scored batches, or the folder of one: the input's text columns and the label."""
    fields = [T.StructField(c, T.StringType()) for c in columns or list(EXPECTED_TYPES)] + [T.StructField(LABEL, T.IntegerType())]
    if not batch:
        return spark.read.schema(T.StructType(fields)).parquet(output)
    return spark.read.schema(T.StructType([*fields, T.StructField("batch", T.LongType())])).parquet(output).drop("batch")


def read_summary(spark: SparkSession, output: str) -> DataFrame:
    """Size and means per label of all batches so far, with the number of rows and labels; a few rows a batch are read."""
    sums = spark.read.parquet(f"{output.rstrip('/')}-summary")
    lists = sums.select("features").distinct().limit(2).collect()
    if len(lists) != 1:
        raise ValueError("no batch was scored yet" if not lists else "batches were scored by models of different features")
    return merged_summary(sums, lists[0]["features"])
