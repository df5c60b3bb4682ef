"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions import rounds
from cohorts.functions.columns import col, number, rounded
from cohorts.mart import customer_mart, embedding_frame
from cohorts.operators import insights as ins
from cohorts.operators import kmeans as km
from cohorts.operators import metrics as met
from cohorts.operators import prepare as prep
from cohorts.operators import profile as prof
from cohorts.operators import score as sc
from cohorts.operators import validate as val
from cohorts.operators.dbscan import assign_to_core, cluster_counts, dbscan, fit_density
from cohorts.plans.batch import density_score, score_file
from cohorts.plans.evaluate import evaluate_clusterings
from cohorts.plans.train import run_summary, train
from cohorts.schema import EXPECTED_TYPES, FEATURES, KEY, LABEL, TrainConfig
from cohorts.session import materialize, new_path
from cohorts.sources import csv as csv_io
from cohorts.sources import snapshot as snap
from cohorts.sources import store
from cohorts.sources.manifest import finished_stages
from cohorts.sources.synthetic import synthetic_customers
from cohorts.streaming.landing import read_rejects, read_scored, read_summary, score_landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

K, ROUNDS = 3, 5
PLACES = 6


def query(name: str):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def mart_table(spark: SparkSession, base: str) -> DataFrame:
    """The mart written once, for queries that pass over it more than once."""
    return materialize(customer_mart(spark, base), "mart")


def scaled_table(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, list[prep.FeatureParam]]:
    mart = mart_table(spark, base)
    params = prep.fit_preprocessor(mart)
    return mart, materialize(prep.apply_preprocessor(mart, params, places=PLACES), "scaled"), params


def lloyd_model(scaled: DataFrame, features: list[str] = FEATURES, k: int = K, max_rounds: int = ROUNDS) -> km.KMeansFit:
    start = km.first_rows_as_centres(scaled, features, k)
    return km.lloyd(scaled, features, start, max_rounds)


def trained(spark: SparkSession, base: str):
    mart, scaled, params = scaled_table(spark, base)
    return mart, scaled, params, lloyd_model(scaled)


def scored_table(spark: SparkSession, base: str) -> DataFrame:
    mart, _, params, model = trained(spark, base)
    return sc.score(mart, params, model, places=PLACES)


def round_features(df: DataFrame, places: int, features: list[str] = FEATURES) -> DataFrame:
    return df.withColumns({f: rounded(col(f), places) for f in features})


def off_tie(value):
    """Six digits after a tiny shift, so that means of few rows do not stand exactly between two digits."""
    return rounded(value + F.lit(1.3e-8))


def defective(mart: DataFrame) -> DataFrame:
    """The mart as raw text with words in one number column and fractions in a whole-number column."""
    half = F.when(F.col("PURCHASES_TRX") > 10, F.lit(0.5)).otherwise(F.lit(0.0))
    return mart.withColumns(
        {
            "MINIMUM_PAYMENTS": F.when(F.col("CREDIT_LIMIT").isNull(), "TEXT").otherwise(
                F.col("MINIMUM_PAYMENTS").cast("string")
            ),
            "TENURE": F.col("TENURE") + half,
        }
    ).select(*[col(c).cast("string").alias(c) for c in mart.columns])


# Sources and sinks


@query("mart")
def q_mart(spark, base):
    return customer_mart(spark, base)


def _csv_of_mart(spark, base) -> str:
    return csv_io.write_csv(customer_mart(spark, base), new_path(spark, "csv"))


@query("s1_csv_typed")
def q_csv_typed(spark, base):
    return csv_io.read_csv(spark, _csv_of_mart(spark, base))


@query("s2_csv_sink")
def q_csv_sink(spark, base):
    path = _csv_of_mart(spark, base)
    text = spark.read.option("header", True).csv(path)
    return csv_io.cast_columns(text.select(*reversed(text.columns))).select(*EXPECTED_TYPES)


@query("s3_snapshot")
def q_snapshot(spark, base):
    root = new_path(spark, "snapshots")
    snap.snapshot(customer_mart(spark, base), root, "run-1")
    return snap.read_snapshot(spark, root, "run-1")


@query("s4_synthetic")
def q_synthetic(spark, base):
    return synthetic_customers(spark.read.parquet(f"{base}/customer.parquet").select("c_custkey"), "c_custkey")


@query("s5_report_json")
def q_report_json(spark, base):
    path = store.save_report(val.check_nulls(customer_mart(spark, base)), new_path(spark, "report"))
    return store.load_report(spark, path, val.REPORT_SCHEMA)


@query("s1_csv_quoted")
def q_csv_quoted(spark, base):
    """Quotes and commas in the key, written and read back."""
    quoted = F.concat(F.lit('C "'), col(KEY), F.lit('"", 1,'))
    path = csv_io.write_csv(customer_mart(spark, base).withColumn(KEY, quoted), new_path(spark, "csv"))
    return csv_io.read_csv(spark, path)


@query("s3_snapshot_runs")
def q_snapshot_runs(spark, base):
    """Two runs of different columns: each comes back whole, and the newer is found to be Parquet."""
    root = new_path(spark, "snapshots")
    mart = customer_mart(spark, base)
    snap.snapshot(mart.select(KEY, "BALANCE"), root, "run-1")
    snap.snapshot(mart.select(KEY, "PURCHASES", F.col("TENURE").cast("double").alias("EXTRA")), root, "run-2")
    first = snap.read_snapshot(spark, root, "run-1")
    second = snap.load_raw(spark, [f"{root}/absent", f"{root}/run_id=run-2"])
    return first.join(second, KEY).select(KEY, "BALANCE", "PURCHASES", "EXTRA")


# Validation


@query("v1_columns")
def q_columns(spark, base):
    return val.check_columns(spark, customer_mart(spark, base).columns)


@query("v2_types")
def q_types(spark, base):
    return val.check_types(defective(customer_mart(spark, base)))


@query("v2a_inferred")
def q_inferred(spark, base):
    mart = customer_mart(spark, base)
    as_text = mart.select(*[col(c).cast("string").alias(c) for c in mart.columns])
    return val.inferred_types(as_text, as_text.columns)


@query("v3_whole")
def q_whole(spark, base):
    return val.whole_numbers(customer_mart(spark, base), FEATURES)


@query("v4_nulls")
def q_nulls(spark, base):
    return val.check_nulls(customer_mart(spark, base))


@query("v5_status")
def q_status(spark, base):
    return val.status_rollup(val.validation_report(defective(mart_table(spark, base))))


@query("v8_quarantine")
def q_quarantine(spark, base):
    _, bad = val.split_bad_rows(defective(customer_mart(spark, base)), whole=True)
    return bad.select(KEY, "reason")


# Feature preparation


@query("t1_t2_features")
def q_features(spark, base):
    return prep.select_features(prep.drop_identifiers(customer_mart(spark, base)))


@query("t3_impute")
def q_impute(spark, base):
    mart = mart_table(spark, base)
    return prep.impute(mart, prep.fit_preprocessor(mart))


@query("t3_impute_infinite")
def q_impute_infinite(spark, base):
    """Infinite cells are set aside with their rows; medians come from the rest."""
    endless = F.when(F.col("PURCHASES_TRX") % 4 == 0, F.lit(float("inf"))).otherwise(F.col("BALANCE"))
    good, _ = val.split_bad_rows(customer_mart(spark, base).withColumn("BALANCE", endless))
    good = materialize(good, "good")
    return prep.impute(good, prep.fit_preprocessor(good))


@query("t4_scale")
def q_scale(spark, base):
    return scaled_table(spark, base)[1]


@query("t5_apply_new")
def q_apply_new(spark, base):
    mart = mart_table(spark, base)
    params = prep.fit_preprocessor(mart)
    fresh = mart.withColumns({f: col(f) * F.lit(1.1) for f in FEATURES})
    return prep.apply_preprocessor(fresh, params, places=PLACES)


def _param_rows(spark, params):
    rows = prep.params_frame(spark, params).drop("method")
    return rows.withColumns({c: rounded(F.col(c)) for c in ("median", "mean", "std")})


@query("t6_one_pass")
def q_one_pass(spark, base):
    return _param_rows(spark, prep.fit_preprocessor(mart_table(spark, base)))


@query("t6_two_pass")
def q_two_pass(spark, base):
    return _param_rows(spark, prep.fit_two_pass(mart_table(spark, base)))


@query("t7_inverse")
def q_inverse(spark, base):
    mart = mart_table(spark, base)
    params = prep.fit_preprocessor(mart)
    back = prep.inverse_scale(prep.apply_preprocessor(mart, params), params)
    return round_features(back, 4)


@query("t8_passthrough")
def q_passthrough(spark, base):
    mart = mart_table(spark, base)
    params = prep.fit_preprocessor(mart)
    wider = mart.withColumn("TICKET", F.col("PURCHASES_TRX") * F.lit(2.0))
    return prep.apply_preprocessor(wider, params, places=PLACES, extra="passthrough")


@query("t8_passthrough_clusters")
def q_passthrough_clusters(spark, base):
    """Density clusters on scaled features and one that is left as it is."""
    mart = mart_table(spark, base)
    params = prep.fit_preprocessor(mart, FEATURES[:-1])
    params += prep.passthrough_params(mart, FEATURES[-1:], len(params))
    mixed = materialize(prep.apply_preprocessor(mart, params, places=PLACES), "mixed")
    return dbscan(mixed, [p.feature for p in params], EPS, MIN_SAMPLES)


# KMeans


@query("m1_kmeans")
def q_kmeans(spark, base):
    _, scaled, _ = scaled_table(spark, base)
    fit = km.fit_kmeans(scaled, FEATURES, K)
    return km.assign(scaled, FEATURES, fit.centres).select(KEY, LABEL)


@query("m1_kmeans_facts")
def q_kmeans_facts(spark, base):
    """What holds for any seed: sizes, nearest centres, and an error no worse than 1.01 times that of plain rounds."""
    _, scaled, _, plain = trained(spark, base)
    fit = km.fit_kmeans(scaled, FEATURES, K)
    placed = km.assign(scaled, FEATURES, fit.centres, keep_distance="d2")
    distances = [
        F.expr(" + ".join(f"pow(`{f}` - {number(c[i])}, 2.0D)" for i, f in enumerate(FEATURES))) for c in fit.centres
    ]
    nearest = F.col("d2") <= F.array_min(F.array(*distances)) + 1e-9
    bound = 1.01 * km.cluster_summary(scaled, FEATURES, plain.centres).agg(F.sum("sse")).first()[0]
    return placed.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(LABEL).alias("centres"), F.bool_and(nearest).alias("nearest"),
        (F.sum("d2") <= F.lit(bound)).alias("close_to_lloyd"), (F.abs(F.sum("d2") / fit.inertia - 1) < 1e-6).alias("error_is_sum"),
    )


@query("m1a_lloyd")
def q_lloyd(spark, base):
    _, scaled, _, model = trained(spark, base)
    return km.assign(scaled, FEATURES, model.centres).select(KEY, LABEL)


@query("m2_centres")
def q_centres(spark, base):
    return km.centres_report(spark, trained(spark, base)[3])


@query("m2_summary")
def q_summary(spark, base):
    _, scaled, _, model = trained(spark, base)
    summary = km.cluster_summary(scaled, FEATURES, model.centres)
    return summary.withColumn("sse", rounded(F.col("sse"), 4))


@query("m6_elbow")
def q_elbow(spark, base):
    _, scaled, _ = scaled_table(spark, base)
    return km.elbow_curve(scaled, FEATURES)


def plain_errors(spark: SparkSession, scaled: DataFrame) -> DataFrame:
    """Rows (k, lloyd): the errors after plain rounds from the first rows as centres."""
    blocks, first = km.pack(scaled, FEATURES), np.array(km.first_rows_as_centres(scaled, FEATURES, 10))
    centres = {k: first[:k] for k in range(2, 11)}
    for _ in range(ROUNDS):
        totals = km.block_sums(blocks, centres, len(FEATURES))
        centres = {k: rounds.means_of(totals[k], c) for k, c in centres.items()}
    totals = km.block_sums(blocks, centres, len(FEATURES))
    return spark.createDataFrame([(k, float(t[:, 1].sum())) for k, t in totals.items()], "k int, lloyd double")


def curve_holds(curve: DataFrame, plain: DataFrame) -> DataFrame:
    """Rows (k, sse, lloyd, holds): falls to within 1 percent, and is no worse than 1.02 times plain rounds."""
    before = curve.select((F.col("k") + 1).alias("k"), F.col("sse").alias("last"))
    joined = curve.select("k", "sse").join(before, "k", "left").join(plain, "k", "left")
    falls, near = F.col("sse") <= F.col("last") * 1.01, F.col("sse") <= F.col("lloyd") * 1.02
    return joined.withColumn("holds", F.coalesce(falls, F.lit(True)) & F.coalesce(near, F.lit(True)))


@query("m6_elbow_facts")
def q_elbow_facts(spark, base):
    """The exact error of k=1, the errors of plain rounds, and a curve that falls and is about as low or lower."""
    _, scaled, _ = scaled_table(spark, base)
    judged = curve_holds(materialize(km.elbow_curve(scaled, FEATURES), "elbow"), plain_errors(spark, scaled))
    exact = F.when(F.col("k") == 1, F.col("sse")).otherwise(F.col("lloyd"))
    return judged.select(F.col("k").cast("int").alias("k"), "holds", rounded(exact, 4).alias("sse_of_one_or_lloyd"))


@query("m6_elbow_k1")
def q_elbow_k1(spark, base):
    _, scaled, _ = scaled_table(spark, base)
    curve = km.elbow_curve(scaled, FEATURES, max_k=1)
    return curve.select("k", F.round("sse", 4).alias("sse"))


# Scoring and summary


@query("flagship")
def flagship(spark, base):
    """How many customers fall in each cluster, and what are their means in original units?"""
    return round_features(sc.means_per_cluster(scored_table(spark, base), FEATURES), 6)


@query("p1_align")
def q_align(spark, base):
    mart = customer_mart(spark, base)
    params = prep.fit_preprocessor(mart)
    shuffled = mart.select(*reversed(mart.columns)).withColumn("EXTRA", F.lit(1))
    return sc.align(shuffled, params)


@query("p2_transform")
def q_transform(spark, base):
    mart, _, params = scaled_table(spark, base)
    stored = prep.params_from_frame(materialize(prep.params_frame(spark, params), "params"))
    return prep.apply_preprocessor(sc.align(mart, stored), stored, places=PLACES)


@query("p3_assign")
def q_assign(spark, base):
    _, scaled, _, model = trained(spark, base)
    placed = km.assign(scaled, FEATURES, model.centres, keep_distance="d2")
    return placed.select(KEY, LABEL, rounded(F.col("d2")).alias("d2"))


@query("p5_scored")
def q_scored(spark, base):
    return scored_table(spark, base)


@query("p7_distribution")
def q_distribution(spark, base):
    return sc.distribution(scored_table(spark, base))


@query("p8_totals")
def q_totals(spark, base):
    return sc.totals(scored_table(spark, base))


@query("p9_means_original")
def q_means(spark, base):
    return flagship(spark, base)


@query("p10_preview")
def q_preview(spark, base):
    return sc.preview(scored_table(spark, base))


def _saved_model(spark, base) -> tuple[DataFrame, str]:
    mart, _, params, model = trained(spark, base)
    return mart, store.save_model(spark, params, model, new_path(spark, "model"))


@query("p11_batch")
def q_batch(spark, base):
    mart, model_path = _saved_model(spark, base)
    source = csv_io.write_csv(mart, new_path(spark, "csv"))
    result = score_file(spark, source, model_path, new_path(spark, "scored"), places=PLACES)
    labelled = spark.read.option("header", True).csv(result.output)
    return csv_io.cast_columns(labelled).withColumn(LABEL, F.col(LABEL).cast("int"))


@query("p11_batch_density")
def q_batch_density(spark, base):
    """A saved and published density model labels a file of new rows by their nearest core rows."""
    mart, scaled, params = scaled_table(spark, base)
    _, model = fit_density(scaled, FEATURES, EPS, MIN_SAMPLES)
    serving = new_path(spark, "serving")
    served = store.publish(spark, store.save_model(spark, params, model, new_path(spark, "model")), serving, "v1")
    fresh = mart.withColumns({f: col(f) * F.lit(1.02) for f in FEATURES})
    result = score_file(spark, csv_io.write_csv(fresh, new_path(spark, "csv")), served, new_path(spark, "scored"), places=PLACES)
    return spark.read.option("header", True).csv(result.output).select(KEY, F.col(LABEL).cast("int").alias(LABEL))


@query("p7_p9_summary")
def q_scored_summary(spark, base):
    """Sizes, totals and means of a scored file from one aggregate."""
    mart, model_path = _saved_model(spark, base)
    source = csv_io.write_csv(mart, new_path(spark, "csv"))
    result = score_file(spark, source, model_path, new_path(spark, "scored"), places=PLACES)
    scored = csv_io.cast_columns(spark.read.option("header", True).csv(result.output))
    return round_features(sc.summary(scored.withColumn(LABEL, F.col(LABEL).cast("int")), FEATURES), 6)


@query("s7_reload")
def q_reload(spark, base):
    mart, model_path = _saved_model(spark, base)
    params, model = store.load_model(spark, model_path)
    return sc.score(mart, params, model, places=PLACES)


@query("s9_publish")
def q_publish(spark, base):
    mart, model_path = _saved_model(spark, base)
    serving = new_path(spark, "serving")
    store.publish(spark, model_path, serving, "v1")
    params, model = store.load_current(spark, serving)
    return sc.score(mart, params, model, places=PLACES)


@query("s9_publish_back")
def q_publish_back(spark, base):
    """v9, then v10 with other centres, then back to v9: the last pointer is served, and v10 was before it."""
    mart, scaled, params, model = trained(spark, base)
    other = lloyd_model(scaled, max_rounds=1)
    serving = new_path(spark, "serving")
    for version, fit in (("v9", model), ("v10", other)):
        store.publish(spark, store.save_model(spark, params, fit, new_path(spark, "model")), serving, version)
    newest = store.current_version(spark, serving)[0]
    store.point_to(spark, serving, "v9")
    params, model = store.load_current(spark, serving)
    return sc.score(mart, params, model, places=PLACES).select(KEY, LABEL, F.lit(newest).alias("before"))


@query("s8_stream")
def q_stream(spark, base):
    mart, model_path = _saved_model(spark, base)
    serving, landing = new_path(spark, "serving"), new_path(spark, "landing")
    store.publish(spark, model_path, serving, "v1")
    csv_io.write_csv(mart, landing)
    output = new_path(spark, "stream-out")
    run = score_landing(spark, landing, serving, output, new_path(spark, "stream-state"), places=PLACES)
    run.awaitTermination()
    return csv_io.cast_columns(read_scored(spark, output))


def _half_defective(mart: DataFrame) -> DataFrame:
    """Text rows of odd PURCHASES_TRX, with words in place of minimum payments where no credit limit is known."""
    words = F.when(F.col("CREDIT_LIMIT").isNull(), "TEXT").otherwise(F.col("MINIMUM_PAYMENTS").cast("string"))
    odd = mart.where("PURCHASES_TRX % 2 = 1").withColumn("MINIMUM_PAYMENTS", words)
    return odd.select(*[col(c).cast("string").alias(c) for c in mart.columns])


@query("s8_stream_rejects")
def q_stream_rejects(spark, base):
    """Two landed sets of files, one with its header reversed and words in number cells: rows are scored or set aside."""
    mart, model_path = _saved_model(spark, base)
    serving, landing = new_path(spark, "serving"), new_path(spark, "landing")
    store.publish(spark, model_path, serving, "v1")
    csv_io.write_csv(mart.where("PURCHASES_TRX % 2 = 0"), landing)
    odd = _half_defective(mart)
    odd.select(*reversed(odd.columns)).write.mode("append").options(header=True, **csv_io.QUOTES).csv(landing)
    output = new_path(spark, "stream-out")
    score_landing(spark, landing, serving, output, new_path(spark, "stream-state"), places=PLACES, max_files=3).awaitTermination()
    scored = read_scored(spark, output).select(KEY, LABEL, F.lit(None).cast("string").alias("reason"))
    return scored.unionByName(read_rejects(spark, f"{output}-rejects").select(KEY, F.lit(None).cast("int").alias(LABEL), "reason"))


@query("s8_running_summary")
def q_running_summary(spark, base):
    """Two batches land; sizes and means of both come from the sums that the batches left."""
    mart, model_path = _saved_model(spark, base)
    serving, landing = new_path(spark, "serving"), new_path(spark, "landing")
    store.publish(spark, model_path, serving, "v1")
    output, state = new_path(spark, "stream-out"), new_path(spark, "stream-state")
    for part in (0, 1):
        half = mart.where(f"PURCHASES_TRX % 2 = {part}")
        half.write.mode("append").options(header=True, **csv_io.QUOTES).csv(landing)
        score_landing(spark, landing, serving, output, state, places=PLACES).awaitTermination()
    return round_features(read_summary(spark, output), 6)


@query("s9_pointers")
def q_pointers(spark, base):
    """Three versions and a way back: every pointer is kept, in one order; the model's size comes from the served version."""
    _, scaled, params, model = trained(spark, base)
    serving = new_path(spark, "serving")
    saved = store.save_model(spark, params, model, new_path(spark, "model"))
    for version in ("v1", "v2", "v3"):
        store.publish(spark, saved, serving, version)
    store.point_to(spark, serving, "v1")
    rows = store.load_current(spark, serving)[0][0].rows
    return store.pointers(spark, serving).select("sequence", "version", F.lit(rows).cast("bigint").alias("rows"))


@query("p11_batch_summary")
def q_batch_summary(spark, base):
    """The summary that scoring a file leaves."""
    mart, model_path = _saved_model(spark, base)
    source, report = csv_io.write_csv(mart, new_path(spark, "csv")), new_path(spark, "summary")
    score_file(spark, source, model_path, new_path(spark, "scored"), PLACES, summary=report)
    means = ", ".join(f"{f} double" for f in FEATURES)
    schema = f"{LABEL} int, size bigint, {means}, total_customers bigint, num_clusters_found bigint"
    return round_features(store.load_report(spark, report, schema), 6)


@query("p11_batch_rejects")
def q_batch_rejects(spark, base):
    mart, model_path = _saved_model(spark, base)
    source = csv_io.write_csv(_half_defective(mart), new_path(spark, "csv"))
    result = score_file(spark, source, model_path, new_path(spark, "scored"), PLACES, new_path(spark, "rejects"))
    scored = spark.read.option("header", True).csv(result.output).select(KEY, F.col(LABEL).cast("int").alias(LABEL))
    return scored.withColumn("rejected", F.lit(result.rejected).cast("bigint"))


# Profiling


@query("e1_describe")
def q_describe(spark, base):
    mart = mart_table(spark, base)
    table = prof.describe(mart, FEATURES)
    return table.withColumns({s: rounded(F.col(s)) for s in prof.STATISTICS[1:]})


@query("e1_describe_scaled")
def q_describe_scaled(spark, base):
    _, scaled, _ = scaled_table(spark, base)
    table = prof.describe(scaled, FEATURES)
    return table.withColumns({s: rounded(F.col(s)) for s in prof.STATISTICS[1:]})


@query("e1a_describe_text")
def q_describe_text(spark, base):
    orders = spark.read.parquet(f"{base}/orders.parquet")
    return prof.describe_text(orders, ["o_orderstatus", "o_orderpriority"])


@query("e1_describe_all")
def q_describe_all(spark, base):
    table = prof.describe_all(mart_table(spark, base))
    return table.withColumns({s: rounded(F.col(s)) for s in prof.STATISTICS[1:]})


@query("e2_counts")
def q_counts(spark, base):
    return prof.frame_counts(customer_mart(spark, base))


@query("e3_nulls")
def q_null_summary(spark, base):
    return prof.null_summary(customer_mart(spark, base))


@query("e4_histogram")
def q_histogram(spark, base):
    bins = prof.histogram(mart_table(spark, base), FEATURES)
    return bins.withColumns({c: off_tie(F.col(c)) for c in ("left", "right")})


@query("e5_density")
def q_density(spark, base):
    _, scaled, _ = scaled_table(spark, base)
    curve = prof.density(scaled, FEATURES)
    return curve.withColumns({"x": rounded(F.col("x"), 5), "density": rounded(F.col("density"), 5)})


@query("e5_density_tail")
def q_density_tail(spark, base):
    """A column whose range is thousands of bandwidths; heights as shares of an even spread over the range."""
    tail = materialize(customer_mart(spark, base).select(F.exp(F.col("BALANCE") / 1000.0).alias("TAIL")), "tail")
    facts = prof.column_facts(tail, ["TAIL"])
    span = facts["TAIL"]["max"] - facts["TAIL"]["min"]
    curve = prof.density(tail, ["TAIL"], facts)
    return curve.select("column", "point", rounded(F.col("x"), 5).alias("x"), rounded(F.col("density") * span, 4).alias("density"))


@query("e6_box")
def q_box(spark, base):
    boxes = prof.box_stats(mart_table(spark, base), FEATURES)
    return boxes.withColumns({c: rounded(F.col(c), 4) for c in ("q25", "q50", "q75", "low", "high")})


@query("e6_outliers")
def q_outliers(spark, base):
    return prof.outlier_rows(mart_table(spark, base), FEATURES)


@query("e7_corr")
def q_corr(spark, base):
    return prof.correlations(mart_table(spark, base), FEATURES).withColumn("r", rounded(F.col("r")))


@query("e8_sample")
def q_sample(spark, base):
    return prof.pair_sample(customer_mart(spark, base), ["BALANCE", "PURCHASES", "CREDIT_LIMIT", "PAYMENTS", "TENURE"])


@query("e10_report")
def q_profile_report(spark, base):
    mart = mart_table(spark, base).select(KEY, *FEATURES)
    return prof.profile_report(mart, FEATURES).withColumn("value", rounded(F.col("value"), 5))


# Density clustering

EPS, MIN_SAMPLES = 1.75, 5


def density_labelled(spark: SparkSession, base: str, features: list[str] = FEATURES, eps: float = EPS):
    mart, scaled, params = scaled_table(spark, base)
    labels = materialize(dbscan(scaled, features, eps, MIN_SAMPLES), "labels")
    return mart, scaled, params, labels


def kmeans_labelled(spark: SparkSession, base: str):
    mart, scaled, params, model = trained(spark, base)
    return mart, scaled, params, materialize(km.assign(scaled, FEATURES, model.centres).select(KEY, LABEL), "labels")


@query("m3_dbscan")
def q_dbscan(spark, base):
    return density_labelled(spark, base)[3]


@query("m3_dbscan_large_branches")
def q_dbscan_large(spark, base):
    """The joins that large inputs take, whatever the size."""
    _, scaled, _ = scaled_table(spark, base)
    return dbscan(scaled, FEATURES, EPS, MIN_SAMPLES, safe_rows=0, finish_edges=0, broadcast_cells=0)


@query("m3_dbscan_five_features")
def q_dbscan_five(spark, base):
    chosen = ["BALANCE", "PURCHASES", "CREDIT_LIMIT", "PAYMENTS", "TENURE"]
    return density_labelled(spark, base, chosen, 0.5)[3]


@query("m3_dbscan_dense")
def q_dbscan_dense(spark, base):
    return density_labelled(spark, base, ["BALANCE", "PURCHASES"], 0.3)[3]


@query("m4_counts")
def q_cluster_counts(spark, base):
    return cluster_counts(density_labelled(spark, base)[3])


@query("m5_labels")
def q_labels(spark, base):
    _, scaled, _, labels = kmeans_labelled(spark, base)
    return scaled.select(KEY).join(labels, KEY)


@query("p4_dbscan_batch")
def q_dbscan_batch(spark, base):
    mart = mart_table(spark, base)
    return density_score(mart, prep.fit_preprocessor(mart), EPS, MIN_SAMPLES, places=PLACES)


@query("p4_nearest_core")
def q_nearest_core(spark, base):
    mart, scaled, params = scaled_table(spark, base)
    fresh = mart.withColumns({f: col(f) * F.lit(1.02) for f in FEATURES})
    fresh = materialize(prep.apply_preprocessor(fresh, params, places=PLACES), "fresh")
    return assign_to_core(scaled, fresh, FEATURES, EPS, MIN_SAMPLES)


@query("p4_nearest_core_small_eps")
def q_nearest_core_small(spark, base):
    """All lengths 8192 times smaller, an exact factor: the same labels."""
    mart, scaled, params = scaled_table(spark, base)
    fresh = mart.withColumns({f: col(f) * F.lit(1.02) for f in FEATURES})
    fresh = prep.apply_preprocessor(fresh, params, places=PLACES)
    small = lambda df: materialize(df.withColumns({f: col(f) * F.lit(2.0**-13) for f in FEATURES}), "small")
    return assign_to_core(small(scaled), small(fresh), FEATURES, EPS * 2.0**-13, MIN_SAMPLES)


# Evaluation and interpretation


def _labelled_scaled(spark, base, kind):
    mart, scaled, params, labels = (kmeans_labelled if kind == "KMeans" else density_labelled)(spark, base)
    return mart, materialize(scaled.join(labels, KEY), "labelled"), params, labels


@query("c1_silhouette")
def q_silhouette(spark, base):
    _, labelled, _, _ = _labelled_scaled(spark, base, "KMeans")
    value = met.silhouette(labelled, FEATURES)
    return spark.createDataFrame([(value,)], "silhouette double").select(rounded(F.col("silhouette")).alias("silhouette"))


@query("c1_silhouette_sq")
def q_silhouette_sq(spark, base):
    _, labelled, _, _ = _labelled_scaled(spark, base, "KMeans")
    value = met.silhouette_sq(labelled, FEATURES)
    return spark.createDataFrame([(value,)], "silhouette double").select(rounded(F.col("silhouette"), 4).alias("silhouette"))


@query("c1_silhouette_embeddings")
def q_silhouette_embeddings(spark, base):
    frame, names = embedding_frame(spark, base)
    value = met.silhouette(frame, names)
    return spark.createDataFrame([(value,)], "silhouette double").select(rounded(F.col("silhouette")).alias("silhouette"))


@query("c2_davies_bouldin")
def q_davies_bouldin(spark, base):
    _, labelled, _, _ = _labelled_scaled(spark, base, "KMeans")
    value = met.davies_bouldin(labelled, FEATURES)
    return spark.createDataFrame([(value,)], "davies_bouldin double").select(rounded(F.col("davies_bouldin")).alias("davies_bouldin"))


@query("c2_davies_bouldin_embeddings")
def q_davies_bouldin_embeddings(spark, base):
    frame, names = embedding_frame(spark, base)
    value = met.davies_bouldin(frame, names)
    return spark.createDataFrame([(value,)], "davies_bouldin double").select(rounded(F.col("davies_bouldin")).alias("davies_bouldin"))


def _rounded_metrics(table: DataFrame) -> DataFrame:
    return table.withColumn("value", rounded(F.col("value")))


@query("c3_metrics")
def q_metrics(spark, base):
    _, labelled, _, _ = _labelled_scaled(spark, base, "DBSCAN")
    return _rounded_metrics(met.evaluate_model(labelled, FEATURES, "DBSCAN", density=True))


@query("c3_metrics_squared")
def q_metrics_squared(spark, base):
    _, labelled, _, _ = _labelled_scaled(spark, base, "KMeans")
    table = met.evaluate_model(labelled, FEATURES, "KMeans", variant="squared")
    return table.withColumn("value", rounded(F.col("value"), 4))


@query("c3_metrics_undefined")
def q_metrics_undefined(spark, base):
    _, scaled, _ = scaled_table(spark, base)
    one = scaled.withColumn(LABEL, F.lit(0))
    return met.metrics_report(
        *[met.evaluate_model(one, FEATURES, how, on_undefined=how) for how in ("minus_one", "nan", "omit")]
    )


@query("c4_library_metrics")
def q_library_metrics(spark, base):
    _, labelled, _, _ = _labelled_scaled(spark, base, "DBSCAN")
    return _rounded_metrics(met.clustering_metrics(labelled, FEATURES, "DBSCAN"))


@query("c5_report")
def q_metrics_report(spark, base):
    _, scaled, _, model = trained(spark, base)
    by_centre = materialize(km.assign(scaled, FEATURES, model.centres), "labelled")
    by_density = materialize(scaled.join(dbscan(scaled, FEATURES, EPS, MIN_SAMPLES), KEY), "labelled")
    return _rounded_metrics(
        met.metrics_report(
            met.evaluate_model(by_centre, FEATURES, "KMeans"),
            met.evaluate_model(by_density, FEATURES, "DBSCAN", density=True),
        )
    )


@query("c6_noise_excluded")
def q_noise_excluded(spark, base):
    return ins.without_noise(density_labelled(spark, base)[3])


def _original(mart, params, labels):
    return prep.impute(mart, params).join(labels, KEY)


@query("c8_profile")
def q_profile(spark, base):
    mart, _, params, labels = density_labelled(spark, base)
    return round_features(ins.profile(_original(mart, params, labels), FEATURES), 6)


@query("c9_sizes")
def q_sizes(spark, base):
    return ins.sizes(kmeans_labelled(spark, base)[3])


@query("c10_flags")
def q_flags(spark, base):
    mart, _, params, labels = density_labelled(spark, base)
    return ins.flags(_original(mart, params, labels), FEATURES)


@query("c10_flags_small_units")
def q_flags_small(spark, base):
    """Figures in units 2^40 times larger: what stands out stays the same."""
    mart, _, params, labels = density_labelled(spark, base)
    original = _original(mart, params, labels)
    return ins.flags(original.withColumns({f: col(f).cast("double") * F.lit(2.0**-40) for f in FEATURES}), FEATURES)


@query("c11_insights")
def q_insights(spark, base):
    mart, scaled, params, model = trained(spark, base)
    parts = []
    whole = prep.impute(mart, params).select(KEY, F.struct(*[col(f) for f in FEATURES]).alias("_original"), *[col(f) for f in FEATURES])
    whole = materialize(prep.scale(whole, params, PLACES), "both")  # original and scaled figures side by side
    centre = materialize(km.assign(whole, FEATURES, model.centres), "labelled")
    density = materialize(whole.join(dbscan(scaled, FEATURES, EPS, MIN_SAMPLES), KEY), "labelled")
    for name, labelled in (("KMeans", centre), ("DBSCAN", density)):
        parts.append(ins.insights(labelled.select("_original.*", LABEL), FEATURES, LABEL, name, "original"))
        parts.append(ins.insights(labelled, FEATURES, LABEL, name, "scaled"))
    table = met.metrics_report(*parts)
    return table.withColumns({c: off_tie(F.col(c)) for c in ("mean", "overall")})


@query("c13_evaluation")
def q_evaluation(spark, base):
    mart, scaled, params = scaled_table(spark, base)
    config = TrainConfig(eps=EPS, min_samples=MIN_SAMPLES)
    model = km.fit_kmeans(scaled, FEATURES, config.k, config.seed)
    original = materialize(prep.impute(mart, params), "original")
    judged = evaluate_clusterings(scaled, original, model, config)
    elbow = judged.elbow.select(
        F.lit("elbow").alias("model"), F.col("k").alias("ord"), F.lit("sse").alias("metric"), F.col("sse").alias("value")
    )
    return judged.metrics.unionByName(elbow)


@query("c13_evaluation_facts")
def q_evaluation_facts(spark, base):
    """Density figures as they are; of the seeded fits, what holds for any seed: bounds, and a curve held against plain rounds."""
    table = materialize(q_evaluation(spark, base), "evaluation")
    plain = plain_errors(spark, scaled_table(spark, base)[1])
    curve = curve_holds(table.where("model = 'elbow'").select(F.col("ord").alias("k"), F.col("value").alias("sse")), plain)
    curve = curve.select(F.lit("elbow").alias("model"), F.col("k").alias("ord"), F.lit("sse").alias("metric"), F.col("holds").cast("double").alias("value"))
    plain = plain.select(F.lit("lloyd").alias("model"), F.col("k").alias("ord"), F.lit("sse").alias("metric"), rounded(F.col("lloyd"), 4).alias("value"))
    holds = F.when(F.col("metric") == "silhouette_score", F.abs("value") <= 1).when(F.col("metric") == "davies_bouldin_score", F.col("value") > 0)
    exact = (F.col("model") == "DBSCAN") | (F.col("metric") == "num_clusters_found")
    value = F.when(exact, rounded(F.col("value"))).otherwise(holds.cast("double"))
    scores = table.where("model <> 'elbow'").select("model", "ord", "metric", value.alias("value"))
    return scores.unionByName(curve).unionByName(plain)


@query("m5_labels_of_run")
def q_labels_of_run(spark, base):
    """The labels that a training run stored, of both models."""
    source = csv_io.write_csv(customer_mart(spark, base), new_path(spark, "csv"))
    root = new_path(spark, "runs")
    train(spark, [source], root, "run-1", TrainConfig(eps=EPS, min_samples=MIN_SAMPLES, max_k=3, silhouette="squared"))
    centre = store.labels_of(spark, root, "run-1", "KMeans").select(KEY, F.col(LABEL).between(0, K - 1).alias("has_centre"))
    return store.labels_of(spark, root, "run-1", "DBSCAN").join(centre, KEY)


@query("p12_train")
def q_train(spark, base):
    source = csv_io.write_csv(customer_mart(spark, base), new_path(spark, "csv"))
    root = new_path(spark, "runs")
    config = TrainConfig(eps=EPS, min_samples=MIN_SAMPLES)
    result = train(spark, [f"{source}-absent", source], root, "run-1", config, f"{root}/serving")
    return run_summary(spark, result)


@query("p12_train_facts")
def q_train_facts(spark, base):
    """A run over raw text with words in a number column: what it learned from, set aside and wrote."""
    source = csv_io.write_csv(defective(customer_mart(spark, base)), new_path(spark, "csv"))
    root = new_path(spark, "runs")
    result = train(spark, [source], root, "run-1", TrainConfig(eps=EPS, min_samples=MIN_SAMPLES))
    return run_summary(spark, result).where("item <> 'inertia'").drop("run_id")


@query("p12_resume")
def q_resume(spark, base):
    """A finished run is resumed: its stages, its reports that have rows, and its stored labels that its stored model gives again."""
    source = csv_io.write_csv(defective(customer_mart(spark, base)), new_path(spark, "csv"))
    root = new_path(spark, "runs")
    config = TrainConfig(eps=EPS, min_samples=MIN_SAMPLES, max_k=3, silhouette="squared")
    train(spark, [source], root, "run-1", config)
    result = train(spark, [source], root, "run-1", config, resume=True)
    stages = finished_stages(spark, root, "run-1").where("stage <> 'inputs'").agg(F.lit("stages").alias("item"), F.count(F.lit(1)).cast("double").alias("value"))
    filled = sum(spark.read.text(path).limit(1).count() for path in result.reports.values())
    reports = spark.createDataFrame([("filled_reports", float(filled))], "item string, value double")
    good, _ = val.split_bad_rows(snap.read_snapshot(spark, f"{root}/ingested", "run-1"), EXPECTED_TYPES, KEY)
    params, model = store.load_model(spark, result.model_path)
    again = sc.score(prep.as_numbers(good, FEATURES), params, model).select(KEY, F.col(LABEL).alias("again"))
    stored = store.labels_of(spark, root, "run-1", "KMeans").join(again, KEY)
    same = stored.agg(F.lit("same_labels").alias("item"), F.sum((F.col(LABEL) == F.col("again")).cast("double")).alias("value"))
    return stages.unionByName(reports).unionByName(same)
