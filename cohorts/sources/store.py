"""Reports as JSON rows, fitted parameters as Parquet tables, and publishing a run for scoring."""

from __future__ import annotations

import json

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from cohorts.operators.blocks import Splits
from cohorts.operators.dbscan import CoreIndex, DensityFit, core_index
from cohorts.operators.kmeans import KMeansFit, centres_frame, centres_from_frame
from cohorts.operators.prepare import FeatureParam, params_frame, params_from_frame
from cohorts.sources.snapshot import path_exists

META_SCHEMA = "k int, inertia double, rounds int"


def save_report(report: DataFrame, path: str) -> str:
    """One JSON object per row; a missing number is written as null."""
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def load_report(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


DENSITY_SCHEMA = "eps double, min_samples int"
INDEX_SCHEMA = (
    "features array<string>, depth int, dims array<bigint>, cuts array<double>, ends array<bigint>, middle array<double>, "
    "axes array<double>, top bigint, points bigint"
)


def save_model(spark: SparkSession, params: list[FeatureParam], model: KMeansFit | DensityFit, path: str) -> str:
    """Parameter, centre and summary tables side by side, each as small as the model; of a density model, all core rows and their index."""
    params_frame(spark, params).coalesce(1).write.mode("overwrite").parquet(f"{path}/params")
    if isinstance(model, DensityFit):
        model.cores.write.mode("overwrite").parquet(f"{path}/cores")
        _save_index(spark, core_index(model), path)
        spark.createDataFrame([(model.eps, model.min_samples)], DENSITY_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/density")
        return path
    centres_frame(spark, model.features, model.centres).coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    meta = spark.createDataFrame([(model.k, model.inertia, model.rounds)], META_SCHEMA)
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return path


def _save_index(spark: SparkSession, index: CoreIndex | None, path: str) -> None:
    if index is None:
        return
    index.leaves.write.mode("overwrite").parquet(f"{path}/index/leaves")
    plan = index.splits
    arrays = [np.asarray(a).ravel().tolist() for a in (plan.dims, plan.cuts, plan.ends, plan.middle, plan.axes)]
    row = (list(plan.features), plan.depth, *arrays, index.top, index.points)
    spark.createDataFrame([row], INDEX_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/index/splits")


def _load_index(spark: SparkSession, path: str) -> CoreIndex | None:
    """One row for the splits, of which there are at most some thousand; leaves stay a table."""
    if not path_exists(spark, f"{path}/index/splits"):
        return None
    r = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index/splits").first()
    p = len(r["features"])
    dims, ends = (np.array(r[c], dtype=np.int64) for c in ("dims", "ends"))
    cuts, middle, axes = (np.array(r[c], dtype=float) for c in ("cuts", "middle", "axes"))
    splits = Splits(list(r["features"]), r["depth"], dims, cuts, ends, middle, axes.reshape(p, p))
    return CoreIndex(splits, spark.read.parquet(f"{path}/index/leaves"), r["top"], r["points"])


def load_model(spark: SparkSession, path: str) -> tuple[list[FeatureParam], KMeansFit | DensityFit]:
    """The saved model of either kind; core rows stay a table."""
    params = params_from_frame(spark.read.parquet(f"{path}/params"))
    if path_exists(spark, f"{path}/density"):
        reach = spark.read.parquet(f"{path}/density").first()
        cores = spark.read.parquet(f"{path}/cores")
        return params, DensityFit([p.feature for p in params], reach["eps"], reach["min_samples"], cores, _load_index(spark, path))
    features, centres = centres_from_frame(spark.read.parquet(f"{path}/centres"))
    meta = spark.read.parquet(f"{path}/meta").first()
    return params, KMeansFit(features, centres, meta["inertia"], meta["rounds"])


def _labels_path(root: str, run_id: str, model: str) -> str:
    return f"{root.rstrip('/')}/labels/run_id={run_id}/model={model}"


def save_labels(labels: DataFrame, root: str, run_id: str, model: str) -> str:
    path = _labels_path(root, run_id, model)
    labels.write.mode("overwrite").parquet(path)
    return path


def labels_of(spark: SparkSession, root: str, run_id: str, model: str) -> DataFrame:
    """Key and cluster of every row that ``model`` ("KMeans" or "DBSCAN") was trained on in a run."""
    return spark.read.parquet(_labels_path(root, run_id, model))


POINTER_SCHEMA = "sequence bigint, version string, path string"


def publish(spark: SparkSession, model_path: str, serving_root: str, version: str, replace: bool = False) -> str:
    """Copy a run's tables to the serving area, then point to them.

    A version's folder is written once and never changed; publishing a name again is refused. The pointer is
    written last, so a reader finds either the old or the new version. ``replace`` is for a copy that was cut off before its pointer.
    """
    target = f"{serving_root.rstrip('/')}/versions/{version}"
    if path_exists(spark, target) and not replace:
        raise FileExistsError(f"version {version} is published already; point_to serves it again")
    params, model = load_model(spark, model_path)
    save_model(spark, params, model, target)
    return point_to(spark, serving_root, version)


def _last_pointer(spark: SparkSession, folder: str) -> int:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return 0
    names = [f.getPath().getName() for f in files.listStatus(path)]
    return max([int(n.split(".")[0]) for n in names if n.endswith(".json")], default=0)


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file is this writer's; of several that try the same name, one succeeds."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = files.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or files.exists(target):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def point_to(spark: SparkSession, serving_root: str, version: str, tries: int = 100) -> str:
    """Serve a version that was published before: the way back from a bad one.

    Pointers are numbered files that are only ever created. Writers that find the same next number race for its
    file; who loses takes the number after, so all pointers are kept and all readers see one order.
    """
    root = serving_root.rstrip("/")
    target = f"{root}/versions/{version}"
    if not path_exists(spark, target):
        raise FileNotFoundError(f"version {version} was never published")
    number = _last_pointer(spark, f"{root}/current")
    for _ in range(tries):
        number += 1
        text = json.dumps({"sequence": number, "version": version, "path": target})
        if _put_if_absent(spark, f"{root}/current/{number:012d}.json", text + "\n"):
            return target
    raise RuntimeError(f"no pointer could be written in {tries} tries")


def pointers(spark: SparkSession, serving_root: str) -> DataFrame:
    """Rows (sequence, version, path) of all pointers; one that is being written is left out."""
    found = spark.read.schema(POINTER_SCHEMA).json(f"{serving_root.rstrip('/')}/current")
    return found.where("sequence is not null and version is not null and path is not null")


def current_version(spark: SparkSession, serving_root: str) -> tuple[str, str]:
    """The pointer with the highest number, whatever the versions are called."""
    row = pointers(spark, serving_root).orderBy("sequence", ascending=False).first()
    return row["version"], row["path"]


def load_current(spark: SparkSession, serving_root: str) -> tuple[list[FeatureParam], KMeansFit | DensityFit]:
    return load_model(spark, current_version(spark, serving_root)[1])
