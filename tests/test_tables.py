import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohorts.functions.columns import MISSING_TOKENS
from cohorts.functions.skew import likely_hot_keys
from cohorts.mart import customer_mart
from cohorts.operators import insights as ins
from cohorts.operators import prepare as prep
from cohorts.operators import profile as prof
from cohorts.operators import score as sc
from cohorts.operators import validate as val
from cohorts.operators.kmeans import KMeansFit
from cohorts.operators.quantiles import exact_quantiles, values_at
from cohorts.plans import train as training
from cohorts.plans.batch import score_file
from cohorts.plans.train import ValidationFailed, train
from cohorts.schema import EXPECTED_TYPES, FEATURES, TrainConfig
from cohorts.session import materialize, new_path, own_scratch
from cohorts.sources import store
from cohorts.sources.csv import cast_columns, read_csv, write_csv
from cohorts.sources.manifest import finished_stages, input_fingerprint
from cohorts.sources.snapshot import first_existing, path_exists
from cohorts.sources.synthetic import generate_customers


def numbers(spark, *values, name="x"):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], f"CUST_ID string, {name} double")


def test_median_scale_and_nan(spark):
    (p,) = prep.fit_preprocessor(numbers(spark, 1.0, 2.0, 3.0, 10.0, None), ["x"])
    assert (p.median, p.missing) == (2.5, 1)
    (p,) = prep.fit_preprocessor(numbers(spark, 1.0, 2.0, 6.0), ["x"])
    assert p.std == pytest.approx(2.160247, abs=1e-6)
    (p,) = prep.fit_preprocessor(numbers(spark, 1.0, 2.0, math.nan), ["x"])
    assert p.median == 1.5
    constant = prep.fit_preprocessor(numbers(spark, 0.1, 0.1, 0.1, None), ["x"])
    assert constant[0].std == 0.0
    seen = prep.apply_preprocessor(numbers(spark, 7.1, None), constant).orderBy("CUST_ID").collect()
    assert [r["x"] for r in seen] == [pytest.approx(7.0), 0.0]
    with pytest.raises(ValueError, match="without any value"):
        prep.fit_preprocessor(numbers(spark, None, None), ["x"])
    with pytest.raises(ValueError, match="empty"):
        prep.fit_preprocessor(numbers(spark, 1.0).where("false"), ["x"])


def test_one_pass_equals_two_pass_and_round_trip(spark):
    df = generate_customers(spark, 300)
    one, two = prep.fit_preprocessor(df), prep.fit_two_pass(df)
    for a, b in zip(one, two):
        assert (a.mean, a.std) == (pytest.approx(b.mean), pytest.approx(b.std))
    back = prep.inverse_scale(prep.apply_preprocessor(df, one), one).toPandas().sort_values("CUST_ID")
    np.testing.assert_allclose(back[FEATURES], df.toPandas().sort_values("CUST_ID")[FEATURES])


@pytest.mark.parametrize("sketch,gather", [(8, 5), (64, 100)])
def test_exact_quantiles_by_brackets(spark, sketch, gather):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=3000), "b": np.where(rng.random(3000) < 0.4, 5.0, rng.normal(5, 1, 3000)), "c": rng.integers(0, 4, 3000).astype(float)})
    pdf.loc[:200, "a"] = np.nan
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf), list(pdf), probs, direct_rows=0, gather_rows=gather, sketch=sketch)
    for c in pdf:
        np.testing.assert_allclose(got[c], np.nanquantile(pdf[c], probs), rtol=1e-12)


def test_quartiles_of_all_columns_take_few_passes(spark):
    """Three quartiles of 17 columns, with ties, gaps and infinite values, in at most six passes; one pass less where all is gathered."""
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({f: rng.normal(size=60_000) * 10.0**i for i, f in enumerate(FEATURES)})
    pdf[FEATURES[1]] = np.where(rng.random(60_000) < 0.5, 0.0, pdf[FEATURES[1]])
    pdf[FEATURES[2]] = np.round(pdf[FEATURES[2]] / 100)
    pdf.loc[rng.random(60_000) < 0.3, FEATURES[3]] = np.nan
    pdf.loc[:20_000, FEATURES[4]] = np.inf
    df = spark.createDataFrame(pdf).repartition(5)
    counts = {f: int(pdf[f].notna().sum()) for f in FEATURES}
    ranks = {f: [r for p in (0.25, 0.5, 0.75) for r in (math.floor(p * (n - 1)), math.floor(p * (n - 1)) + 1)] for f, n in counts.items()}
    for gather, most in ((500, 6), (60_000, 1)):
        values, passes = values_at(df, ranks, counts, gather_rows=gather)
        assert passes <= most
        for f, wanted in ranks.items():
            held = np.sort(pdf[f].dropna().to_numpy())
            assert [values[f, r] for r in wanted] == [held[r] for r in wanted], f


def test_csv_is_bound_by_name_and_whole_floats_are_whole(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("TENURE,CUST_ID,BALANCE\n12.0,C1,1.5\nNA,C2,\n7,C3,NaN\n9007199254740993,C4,1d\n")
    rows = read_csv(spark, str(path)).orderBy("CUST_ID").collect()
    assert [r["TENURE"] for r in rows] == [12, None, 7, 9007199254740993]
    assert [r["BALANCE"] for r in rows] == [1.5, None, None, None]
    assert "" in MISSING_TOKENS


def test_type_and_null_checks(spark):
    text = spark.createDataFrame(
        [("C1", "1", "12.0", None), ("C2", "TEXT", "11", None), ("C3", "2.5", "1", "4"), ("C4", "3", None, "5")],
        "CUST_ID string, BALANCE string, TENURE string, PAYMENTS string",
    )
    rows = {r["column"]: r for r in val.check_types(text).collect()}
    assert set(rows) == {"CUST_ID", "BALANCE"} and rows["BALANCE"]["status"] == "FAIL"
    nulls = {r["column"]: r for r in val.check_nulls(text).collect()}
    assert (nulls["PAYMENTS"]["status"], nulls["PAYMENTS"]["message"]) == ("SUCCESS", "50.00% nulls.")
    empty = val.check_nulls(text.where("false")).collect()
    assert {(r["status"], r["message"]) for r in empty} == {("FAIL", "no rows")}
    fractions = text.where("CUST_ID = 'C1'").withColumn("TENURE", F.lit("12.5"))
    assert val.split_bad_rows(fractions)[1].count() == 0 and val.split_bad_rows(fractions, whole=True)[1].count() == 1
    good, bad = val.split_bad_rows(text)
    assert good.count() == 3 and bad.first()["reason"] == "BALANCE"
    missing = val.check_columns(spark, text.columns).first()
    assert missing["status"] == "FAIL" and "MINIMUM_PAYMENTS" in missing["message"]
    status = {r["section"]: r["status"] for r in val.status_rollup(val.validation_report(text)).collect()}
    assert status == {"schema_validation": "FAIL", "null_validation": "SUCCESS", "run": "FAIL"}


def test_correlation_edge_cases(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, None, 1.0), (3.0, 5.0, 1.0), (4.0, 4.0, 1.0)], "a double, b double, c double")
    r = {(x["a"], x["b"]): x["r"] for x in prof.correlations(df).collect()}
    assert r["a", "b"] == pytest.approx(0.785714, abs=1e-6) == r["b", "a"]
    assert r["a", "c"] is None and r["c", "c"] is None and r["a", "a"] == 1.0


def test_histogram_and_box_like_numpy(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.gamma(2.0, 3.0, 800), [90.0, 95.0]])
    df = numbers(spark, *map(float, x))
    rows = prof.histogram(df, ["x"]).orderBy("bin").collect()
    counts, edges = np.histogram(x, bins="auto")
    assert [r["count"] for r in rows] == counts.tolist()
    np.testing.assert_allclose([r["left"] for r in rows], edges[:-1])
    box = prof.box_stats(df, ["x"]).first()
    q1, q3 = np.quantile(x, [0.25, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (box["low"], box["high"], box["outliers"]) == (inside.min(), inside.max(), len(x) - len(inside))
    assert prof.outlier_rows(df, ["x"]).count() == box["outliers"]
    curve = prof.density(df, ["x"]).toPandas().sort_values("point")
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-0.5 * ((curve["x"].to_numpy()[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(curve["density"], want, atol=want.max() * 2e-3)
    constant = prof.histogram(numbers(spark, 3.0, 3.0), ["x"]).collect()
    assert [(r["left"], r["right"], r["count"]) for r in constant] == [(2.5, 3.5, 2)]


def test_pair_sample_limits(spark):
    df = generate_customers(spark, 1500)
    assert prof.pair_sample(df, FEATURES[:2]).count() == 1000 * 3
    assert prof.pair_sample(df, FEATURES[:6]).count() == 0


def test_flags_with_negative_overall_mean(spark):
    df = spark.createDataFrame([("a", 0, -11.0), ("b", 1, -13.0), ("c", -1, -6.0)], "CUST_ID string, CLUSTER int, x double")
    rows = {r["cluster"]: r for r in ins.insights(df, ["x"]).collect()}
    assert {c: r["flag"] for c, r in rows.items()} == {0: "High", 1: "Low"}
    assert rows[0]["overall"] == -10.0
    assert ins.insights(df.where("CLUSTER = -1"), ["x"]).count() == 0


def test_preview_and_score_keep_input(spark):
    df = spark.range(1, 51).selectExpr("lpad(cast(id as string), 2, '0') as CUST_ID", "cast(id as double) as x", "'k' as note", "9 as CLUSTER")
    keys = sorted(int(r["CUST_ID"]) for r in sc.preview(df).collect())
    assert keys == [*range(1, 11), *range(41, 51)]
    assert sc.preview(df.where("x <= 15")).count() == 15
    params = prep.fit_preprocessor(df, ["x"])
    out = sc.score(df, params, KMeansFit(["x"], [[-1.0], [1.0]], 0.0, 1))
    assert out.columns == ["CUST_ID", "x", "note", "CLUSTER"] and out.where("CLUSTER = 9").count() == 0
    with pytest.raises(ValueError, match="lacks"):
        sc.score(df.drop("x"), params, KMeansFit(["x"], [[0.0]], 0.0, 1))


def test_train_publish_and_score(spark):
    customers = generate_customers(spark, 400)
    source = write_csv(customers, new_path(spark, "csv"))
    root = new_path(spark, "runs")
    result = train(spark, [source + "-absent", source], root, "r1", serving_root=f"{root}/serving")
    assert result.rejected == 0 and result.params[0].rows == 400
    params, model = store.load_current(spark, f"{root}/serving")
    assert (params, model.centres) == (result.params, result.model.centres)
    done = score_file(spark, source, result.served, new_path(spark, "scored"))
    assert done.records == 400
    before = spark.read.option("header", True).csv(source)
    after = spark.read.option("header", True).csv(done.output)
    assert after.drop("CLUSTER").exceptAll(before).count() == 0 and after.where("CLUSTER is null").count() == 0
    words = write_csv(customers.withColumn("TENURE", F.lit("word")), new_path(spark, "csv"))
    with pytest.raises(Exception, match="not a number in TENURE"):
        score_file(spark, words, result.served, new_path(spark, "scored"))
    with pytest.raises(FileNotFoundError):
        first_existing(spark, [source + "-absent"])
    short = write_csv(customers.select("CUST_ID", "BALANCE", "TENURE"), new_path(spark, "csv"))
    with pytest.raises(ValidationFailed, match="Missing columns"):
        train(spark, [short], root, "r2")
    assert set(cast_columns(customers).columns) <= set(EXPECTED_TYPES)


def test_resumed_run_skips_finished_stages(spark, monkeypatch):
    """A run killed after the fit goes on with the evaluation, by the parameters and centres it had stored."""
    source = write_csv(generate_customers(spark, 300), new_path(spark, "csv"))
    root = new_path(spark, "runs")
    config = TrainConfig(max_k=3, silhouette="squared")

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    def names(run):
        return {r["stage"] for r in finished_stages(spark, root, run).collect()}

    before = {"inputs", "snapshot", "validation", "rejected", "params", "profiles", "model"}
    with monkeypatch.context() as cut:
        cut.setattr(training, "evaluate_clusterings", killed)
        with pytest.raises(KeyboardInterrupt):
            train(spark, [source], root, "r", config, f"{root}/serving")
    assert names("r") == before
    params, model = store.load_model(spark, f"{root}/model/run_id=r")
    with monkeypatch.context() as cut:
        for part in ("snapshot", "profile_report"):
            cut.setattr(training, part, killed)
        cut.setattr(training.km, "fit_kmeans", killed)
        cut.setattr(training.prep, "fit_preprocessor", killed)
        cut.setattr(training, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            train(spark, [source], root, "r", config, f"{root}/serving", resume=True)
    assert names("r") == before | {"evaluation"}
    store.save_model(spark, params, model, f"{root}/serving/versions/r")  # a copy without a pointer
    with monkeypatch.context() as cut:
        cut.setattr(training, "evaluate_clusterings", killed)
        resumed = train(spark, [source], root, "r", config, f"{root}/serving", resume=True)
        again = train(spark, [source], root, "r", config, f"{root}/serving", resume=True)
    assert resumed == again and store.pointers(spark, f"{root}/serving").count() == 1
    assert (resumed.params, resumed.model) == (params, model) and resumed.rejected == 0
    assert all(spark.read.json(path).count() > 0 for path in resumed.reports.values())
    curve = {r["k"]: r["sse"] for r in spark.read.json(resumed.reports["elbow"]).collect()}
    assert curve[3] == pytest.approx(model.inertia)
    with pytest.raises(KeyboardInterrupt), monkeypatch.context() as cut:  # other settings start from the beginning
        cut.setattr(training, "snapshot", killed)
        train(spark, [source], root, "r", TrainConfig(max_k=4, silhouette="squared"), resume=True)
    assert names("r") == {"inputs"}
    one, other = [input_fingerprint(spark, p, {}) for p in (source, write_csv(generate_customers(spark, 300), new_path(spark, "csv")))]
    assert one == input_fingerprint(spark, source, {}) != other


def test_describe_text_reads_once(spark):
    """All text columns in one scan; ties go to the smallest value, a column without values has a row, a hot value is added up before the shuffle."""
    rows = [(f"v{i % 40}", "hot" if i % 3 else f"x{i}", None, i % 2 == 0) for i in range(3000)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, `c d` string, e boolean")
    out = prof.describe_text(df, df.columns)
    assert [tuple(r) for r in out.orderBy("column").collect()] == [
        ("a", 3000, 40, "v0", 75), ("b", 3000, 1001, "hot", 2000), ("c d", 0, 0, None, None), ("e", 3000, 2, "false", 1500)
    ]
    path = new_path(spark, "texts")
    df.write.parquet(path)
    plan = prof.describe_text(spark.read.parquet(path), df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert prof.describe_text(df.limit(0), ["a", "b"]).orderBy("column").collect() == [("a", 0, 0, None, None), ("b", 0, 0, None, None)]


@pytest.mark.parametrize("direct", [10**6, 0])
def test_quantile_branches_agree_on_infinity(spark, direct):
    df = numbers(spark, 0.0, 1.0, 2.0, 3.0, math.inf)
    assert exact_quantiles(df, ["x"], [0.5, 0.75, 1.0], direct_rows=direct)["x"] == [2.0, 3.0, math.inf]


def test_infinite_values_are_named_or_set_aside(spark):
    df = numbers(spark, 1.0, 2.0, -math.inf, name="BALANCE")
    with pytest.raises(ValueError, match="BALANCE"):
        prep.fit_preprocessor(df, ["BALANCE"])
    good, bad = val.split_bad_rows(df, {"BALANCE": "float64"})
    assert good.count() == 2 and [r.reason for r in bad.collect()] == ["BALANCE"]
    text = df.select("CUST_ID", F.col("BALANCE").cast("string").alias("BALANCE"))
    assert val.split_bad_rows(text, {"BALANCE": "float64"})[1].count() == 1


def test_density_of_a_long_tail_equals_the_plain_sum(spark):
    rng = np.random.default_rng(3)
    x = np.exp(rng.normal(0, 2, 800))
    curve = prof.density(numbers(spark, *map(float, x)), ["x"]).orderBy("point").toPandas()
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-0.5 * ((curve["x"].to_numpy()[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert len(curve) == prof.DENSITY_GRID and np.abs(curve["density"] - want).max() < 1e-5 * want.max()


def test_published_versions_are_served_in_order(spark, tmp_path):
    root = str(tmp_path / "serving")
    params = prep.fit_preprocessor(numbers(spark, 1.0, 2.0, 3.0), ["x"])
    for k, version in enumerate(("v9", "v10")):
        path = store.save_model(spark, params, KMeansFit(["x"], [[float(k)]], 0.0, 1), str(tmp_path / version))
        store.publish(spark, path, root, version)
    assert store.current_version(spark, root)[0] == "v10"
    store.point_to(spark, root, "v9")
    assert store.load_current(spark, root)[1].centres == [[0.0]]
    with pytest.raises(FileExistsError):
        store.publish(spark, path, root, "v10")
    with pytest.raises(FileNotFoundError):
        store.point_to(spark, root, "v11")


def test_quoted_cells_survive(spark, tmp_path):
    rows = [('C "x", 1', 1.5), ("two\nlines", 2.5), ('"', None)]
    df = spark.createDataFrame(rows, "CUST_ID string, BALANCE double")
    back = read_csv(spark, write_csv(df, str(tmp_path / "q")), multiLine="true")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_report_from_one_pass_equals_its_parts(spark):
    text = spark.createDataFrame([("a", "1", "x"), (None, "2.5", None), ("c", "", "y")], "CUST_ID string, BALANCE string, TENURE string")
    for df in (text, text.where("false")):
        parts = val.check_columns(spark, df.columns).unionByName(val.check_types(df)).unionByName(val.check_nulls(df))
        assert sorted(map(str, val.validation_report(df).collect())) == sorted(map(str, parts.collect()))
    assert val.validation_report(text.select(F.lit(1).alias("other"))).count() == 1


def test_preview_keeps_rows_that_share_a_key(spark):
    same = spark.createDataFrame([("k", float(i)) for i in range(12)], "CUST_ID string, x double")
    assert sc.preview(same).count() == 12
    assert sc.preview(same.union(same)).count() == 20


def test_passthrough_columns_are_filled_only(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("b", 3.0, None), ("c", 8.0, 30.0), ("d", 8.0, 20.0)], "CUST_ID string, x double, y double")
    params = prep.fit_preprocessor(df, ["x"]) + prep.passthrough_params(df, ["y"], 1)
    assert [p.ord for p in params] == [0, 1] and prep.passthrough_params(df, []) == []
    assert sorted(r["y"] for r in prep.apply_preprocessor(df, params).collect()) == [10.0, 20.0, 20.0, 30.0]


def test_summary_and_describe_of_all_columns(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", 3.0, 0), ("b", 5.0, 1), (None, 7.0, None)], "name string, x double, CLUSTER int")
    got = {r["CLUSTER"]: (r["size"], r["x"], r["total_customers"], r["num_clusters_found"]) for r in sc.summary(df, ["x"]).collect()}
    assert got == {0: (2, 2.0, 3, 2), 1: (1, 5.0, 3, 2)}
    rows = {r["column"]: r for r in prof.describe_all(df, ["x", "name"]).collect()}
    assert (rows["name"]["ord"], rows["name"]["top"], rows["name"]["freq"], rows["name"]["unique"], rows["name"]["mean"]) == (1, "a", 2, 2, None)
    assert (rows["x"]["ord"], rows["x"]["count"], rows["x"]["mean"], rows["x"]["top"]) == (0, 4, 4.0, None)
    assert prof.describe_all(df, ["name"]).count() == prof.describe_all(df, ["x"]).count() == 1


def test_scratch_of_a_block_goes_with_it(spark):
    outside = materialize(numbers(spark, 1.0), "kept")
    with own_scratch(spark):
        first = new_path(spark, "first")
        numbers(spark, 1.0).write.parquet(first)
        with own_scratch(spark):
            second = new_path(spark, "second")
            numbers(spark, 2.0).write.parquet(second)
        assert path_exists(spark, first) and not path_exists(spark, second)
    assert not path_exists(spark, first) and outside.count() == 1


def test_mart_shuffles_an_order_once(spark, tmp_path, capsys):
    """Orders go to their customer and are folded there; those of a customer with a large share are folded first. Both give the same rows."""
    rng = np.random.default_rng(4)
    n = 4000
    keys = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 1500, n))
    orders = pd.DataFrame(
        {
            "o_custkey": pd.array([None if k % 50 == 3 else int(k) for k in keys], dtype="Int64"),
            "o_orderstatus": rng.choice(["F", "O", "P", None], n),
            "o_totalprice": np.round(rng.uniform(1, 9e4, n), 2),
            "o_orderdate": pd.Timestamp("1995-01-01") + pd.to_timedelta(rng.integers(0, 2400, n), "D"),
            "o_orderpriority": rng.choice(["1-URGENT", "2-HIGH", "5-LOW", None], n),
        }
    )
    spark.createDataFrame(orders).write.parquet(f"{tmp_path}/orders.parquet")
    customers = [(k, float(k)) for k in [*range(1400), 7]]
    spark.createDataFrame(customers, "c_custkey bigint, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    plain, folded = customer_mart(spark, str(tmp_path)), customer_mart(spark, str(tmp_path), safe_rows=0)
    capsys.readouterr()
    plain.explain()
    text = capsys.readouterr().out
    assert text.count("Exchange hashpartitioning(o_custkey") == 1 and "Exchange hashpartitioning(o_custkey" in text
    large = orders["o_custkey"].value_counts().loc[lambda c: c * 1000 > n].index.tolist()
    assert sorted(likely_hot_keys(spark.createDataFrame(orders), "o_custkey", 0)) == sorted(large) and 7 in large
    assert likely_hot_keys(spark.createDataFrame(orders), "o_custkey") == []
    rows = [sorted(map(tuple, x.collect())) for x in (plain, folded)]
    assert rows[0] == rows[1] and len(rows[0]) == 1 + sum(1 for k in set(keys.tolist()) if k < 1400 and k % 50 != 3)
    mine = orders[(orders["o_custkey"] == 7).fillna(False)]
    row = plain.where("CUST_ID = 'C7'").first()
    months = mine["o_orderdate"].dt.strftime("%Y%m").nunique()
    assert (row["PURCHASES_TRX"], row["BALANCE_FREQUENCY"], row["TENURE"]) == (len(mine), months / 80, mine["o_orderdate"].dt.year.nunique())
    assert row["PURCHASES"] == pytest.approx(mine["o_totalprice"].sum(), abs=0.006)
