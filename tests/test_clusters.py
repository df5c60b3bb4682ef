from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohorts.functions import kernels, rounds
from cohorts.functions.skew import hot_keys, lookup, numbered
from cohorts.operators import kmeans as km
from cohorts.operators import metrics as met
from cohorts.operators.components import connected_components
from cohorts.operators.dbscan import assign_by_model, assign_to_core, cluster_counts, dbscan, fit_density
from cohorts.operators.prepare import FeatureParam
from cohorts.operators.score import score
from cohorts.session import new_path, own_scratch, scratch_dir
from cohorts.sources import store
from cohorts.streaming import landing
from tests import brute


def frame(spark, x, labels=None):
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(x.shape[1])])
    pdf.insert(0, "CUST_ID", [f"C{i:06d}" for i in range(len(x))])
    if labels is not None:
        pdf["CLUSTER"] = np.asarray(labels, dtype=np.int32)
    return spark.createDataFrame(pdf), [f"f{i}" for i in range(x.shape[1])]


def labels_of(result):
    pdf = result.toPandas().sort_values("CUST_ID")
    return pdf["CLUSTER"].to_numpy()


def blobs(rng, n, dims):
    """Loose noise, a dense spot, a chain, and one point repeated for a third of all rows."""
    third = n // 3
    spot = rng.normal(0.0, 0.05, size=(third // 2, dims))
    noise = rng.uniform(-4, 4, size=(third, dims))
    chain = np.zeros((n - 2 * third - third // 2, dims))
    chain[:, 0] = np.linspace(1.0, 9.0, len(chain))
    copies = np.full((third, dims), 3.25)
    x = np.concatenate([spot, noise, chain, copies])
    return np.round(x[rng.permutation(len(x))], 6)


@pytest.mark.parametrize("n,dims,eps,min_samples", [(1500, 2, 0.3, 5), (900, 3, 0.6, 4)])
def test_dbscan_against_brute_force(spark, n, dims, eps, min_samples):
    x = blobs(np.random.default_rng(3), n, dims)
    df, features = frame(spark, x)
    want = brute.dbscan(x, eps, min_samples)
    got = labels_of(dbscan(df, features, eps, min_samples))
    assert (want >= 0).any() and (want == -1).any()
    np.testing.assert_array_equal(got, want)


def test_dbscan_of_one_dense_ball_and_copies_only(spark):
    rng = np.random.default_rng(5)
    x = np.round(np.concatenate([rng.normal(0, 0.01, size=(600, 2)), np.full((300, 2), 5.0)]), 6)
    df, features = frame(spark, x)
    np.testing.assert_array_equal(labels_of(dbscan(df, features, 0.5, 5)), brute.dbscan(x, 0.5, 5))


def test_dbscan_border_takes_lower_cluster_and_order_does_not_matter(spark):
    x = np.array([[0.0], [0.1], [0.2], [0.7], [1.2], [1.3], [1.4]])
    df, features = frame(spark, x)
    got = labels_of(dbscan(df.repartition(5).orderBy("f0", ascending=False), features, 0.5, 4))
    np.testing.assert_array_equal(got, brute.dbscan(x, 0.5, 4))


def test_dbscan_rejects_gaps_and_accepts_nothing(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "CUST_ID string, f0 double")
    with pytest.raises(ValueError, match="missing"):
        dbscan(df, ["f0"])
    assert dbscan(df.where("false"), ["f0"]).count() == 0


def test_nearest_core(spark):
    x = np.round(np.random.default_rng(11).normal(size=(400, 2)), 6)
    y = np.round(np.random.default_rng(12).normal(size=(300, 2)) * 1.5, 6)
    labels = brute.dbscan(x, 0.3, 5)
    core = (brute.distances(x) <= 0.3).sum(axis=1) >= 5
    want = []
    for row in y:
        d2 = ((x - row) ** 2).sum(axis=1)
        ok = core & (((x - row) ** 2).sum(axis=1) <= 0.09)
        want.append(min(zip(d2[ok], labels[ok]))[1] if ok.any() else -1)
    train, features = frame(spark, x)
    fresh, _ = frame(spark, y)
    got = labels_of(assign_to_core(train, fresh, features, 0.3, 5))
    np.testing.assert_array_equal(got, want)
    assert (got == -1).any() and (got >= 0).any()


def test_components_by_rounds_with_a_star_and_a_chain(spark):
    edges = [(0, i) for i in range(1, 60)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 499), (499, 500), (7, 7)]
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    want = {i: 0 for i in range(1, 60)} | {101 + i: 100 for i in range(40)} | {500: 499}
    for options in ({}, {"finish_edges": 0}, {"finish_edges": 0, "safe_rows": 0}):
        got = {r["vertex"]: r["root"] for r in connected_components(df, **options).collect()}
        assert got == want, options


def test_hot_lookup_and_numbering(spark):
    big = spark.range(3000).selectExpr("case when id % 3 = 0 then 7 else id end as k", "id")
    table = spark.range(3000).selectExpr("id as k", "id * 2 as twice")
    hot = hot_keys(big, "k", 3000, safe_rows=0)
    assert hot == [7]
    assert lookup(big, table, "k", "inner", hot).where("twice <> 2 * k").count() == 0
    assert lookup(big, table, "k", "inner", hot).count() == 3000
    order = numbered(spark.range(0, 1000, 7).selectExpr("-id as v"), "v", "n").orderBy("v").collect()
    assert [r["n"] for r in order] == list(range(len(order)))


@pytest.mark.parametrize("block_rows", [None, 50])
def test_scores_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 1.0, size=(60, 3)) for c in (0, 2, 4)] + [np.full((90, 3), 9.0)])
    labels = np.array([0] * 60 + [1] * 60 + [2] * 60 + [3] * 89 + [4])
    df, features = frame(spark, x, labels)
    assert met.silhouette(df, features, block_rows=block_rows) == pytest.approx(brute.silhouette(x, labels), abs=1e-9)
    keep = labels != 4
    df, features = frame(spark, x[keep], labels[keep])
    assert met.davies_bouldin(df, features) == pytest.approx(brute.davies_bouldin(x[keep], labels[keep]), abs=1e-9)


def test_undefined_scores(spark):
    df, features = frame(spark, np.random.default_rng(1).normal(size=(20, 2)), [0] * 20)
    assert met.silhouette(df, features) == -1.0 and met.davies_bouldin(df, features) == -1.0
    values = {h: [r["value"] for r in met.evaluate_model(df, features, "m", on_undefined=h).orderBy("ord").collect()] for h in met.UNDEFINED}
    assert values == {"minus_one": [-1.0, -1.0, 1.0], "nan": [None, None, 1.0], "omit": [1.0]}
    assert met.clustering_metrics(df, features, "m").count() == 0


def test_cluster_counts(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 3), ("d", -1)], "CUST_ID string, CLUSTER int")
    assert cluster_counts(df).first().asDict() == {"clusters": 2, "noise": 1}


def test_lloyd_keeps_empty_centre_and_ties_go_low(spark):
    df, features = frame(spark, np.array([[0.0], [2.0], [4.0], [6.0]]))
    fit = km.lloyd(df, features, [[1.0], [5.0], [100.0]], 10)
    assert fit.centres == [[1.0], [5.0], [100.0]] and fit.inertia == 4.0
    assert labels_of(km.assign(df, features, [[1.0], [3.0], [5.0]])).tolist() == [0, 0, 1, 2]
    assert [r["size"] for r in km.cluster_summary(df, features, fit.centres).orderBy("cluster").collect()] == [2, 2, 0]


def test_elbow_and_more_clusters_than_rows(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(c, 0.2, size=(80, 2)) for c in (0, 4, 8, 12)])
    df, features = frame(spark, x)
    rows = km.elbow_curve(df, features, 5).orderBy("k").collect()
    assert rows[0]["sse"] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
    assert all(b["sse"] <= a["sse"] * 1.01 for a, b in zip(rows, rows[1:]))
    two, features = frame(spark, np.array([[0.0, 0.0], [1.0, 1.0]]))
    assert km.fit_kmeans(two, features, 5).k == 2


def test_saved_density_model_labels_rows_of_any_key(spark):
    """Repeated and null keys, copies, rows out of reach, and no rows at all."""
    df = spark.createDataFrame([(f"k{i}", i % 10 * 0.1 + i // 10 * 50.0, 1.0) for i in range(20)], "CUST_ID string, x double, y double")
    params = [FeatureParam("x", 0, 0.0, 0.0, 1.0, 20, 0), FeatureParam("y", 1, 1.0, 0.0, 1.0, 20, 0)]
    labels, fitted = fit_density(df, ["x", "y"], 0.15, 3)
    assert labels.select("CLUSTER").distinct().count() == 2
    path = store.save_model(spark, params, fitted, new_path(spark, "model"))
    params, model = store.load_model(spark, path)
    rows = [("a", 0.05, 1.0), ("a", 50.0, 1.0), (None, 50.85, None), (None, 0.05, 1.0), ("b", 25.0, 1.0), ("b", 25.0, 1.0)]
    fresh = spark.createDataFrame(rows, "CUST_ID string, x double, y double")
    got = sorted((r["CUST_ID"] or "", r["x"], r["CLUSTER"]) for r in score(fresh, params, model).collect())
    assert got == [("", 0.05, 0), ("", 50.85, 1), ("a", 0.05, 0), ("a", 50.0, 1), ("b", 25.0, -1), ("b", 25.0, -1)]
    assert score(fresh.where("false"), params, model).count() == 0
    none = fit_density(df.where("false"), ["x", "y"], 0.15, 3)[1]
    assert {r["CLUSTER"] for r in score(fresh, params, none).collect()} == {-1}


def test_silhouette_is_the_callers_choice(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 5.0), (1, 7.0)], "CLUSTER int, x double")
    exact, squared = (met.evaluate_model(df, ["x"], "m", variant=v).where("ord = 0").first()["value"] for v in ("exact", "squared"))
    assert exact == pytest.approx(met.silhouette(df, ["x"])) and squared == pytest.approx(met.silhouette_sq(df, ["x"]))
    assert abs(exact - squared) > 0.01
    with pytest.raises(ValueError):
        met.evaluate_model(df, ["x"], "m", variant="fast")


def test_elbow_rounds_reach_the_best_of_plain_groups(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([c + rng.normal(0, 0.1, (60, 2)) for c in ((0, 0), (9, 0), (0, 9), (9, 9))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double")
    rows = {r["k"]: r for r in km.elbow_curve(df, ["a", "b"], 5, seed_rows=40).collect()}
    within = sum(((g - g.mean(axis=0)) ** 2).sum() for g in np.split(x, 4))
    assert abs(rows[4]["sse"] - within) < 1e-6 and rows[5]["sse"] < within < rows[3]["sse"]
    assert abs(rows[1]["sse"] - ((x - x.mean(axis=0)) ** 2).sum()) < 1e-6
    with pytest.raises(Exception, match="complete rows"):
        km.elbow_curve(df.selectExpr("a", "nullif(b, b) as b"), ["a", "b"], 2)


def test_elbow_starts_reach_a_small_far_group(spark):
    """Eight rows of 40,008 far away from the rest are a cluster of their own from k = 2 on."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, (40_000, 2)), rng.normal(1000, 0.1, (8, 2))])
    df, features = frame(spark, x)
    rows = {r["k"]: r["sse"] for r in km.elbow_curve(df, features, 4).collect()}
    within = sum(((g - g.mean(axis=0)) ** 2).sum() for g in (x[:40_000], x[40_000:]))
    assert rows[2] == pytest.approx(within) and rows[4] < rows[3] < rows[2]
    same, features = frame(spark, np.array([[0.0, 1.0]] * 50 + [[3.0, 1.0]] * 2))
    assert [r["sse"] for r in km.elbow_curve(same, features, 4).orderBy("k").collect()][1:] == pytest.approx([0.0] * 3)


def plain_lloyd(x, centres, rest, most=300):
    for _ in range(most):
        own = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        shift, centres = ((moved - centres) ** 2).sum(), moved
        if shift <= rest:
            break
    return centres


def test_bounded_rounds_find_the_centres_of_plain_ones(spark):
    """Overlapping groups, copies, rows at equal distances and a centre without rows; most rows are never compared again."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(c, 1.0, (9000, 3)) for c in (0.0, 2.5, 6.0)] + [np.zeros((3000, 3)), np.round(rng.normal(3, 2, (3000, 3)))])
    df, features = frame(spark, x)
    blocks = km.pack(df.repartition(6), features)
    starts = {k: x[rng.choice(len(x), k, replace=False)] for k in (2, 6)} | {4: np.vstack([x[:3], [[900.0] * 3]])}
    rest = 1e-5 * x.var(axis=0).mean()
    for warm, chain_rows in ((3, 0), (400, 0), (10, 20000), (0, 1 << 16)):
        got = km.settle(blocks, starts, 3, rest, warm=warm, chain_rows=chain_rows)
        assert got.at_rest and (got.bounded > 0) == (warm < 400 and chain_rows < len(x)) and (got.chains > 0) == (chain_rows > 0)
        for k, c in starts.items():
            assert np.allclose(got.centres[k], plain_lloyd(x, c, rest), atol=1e-9), (k, warm)
        if (warm, chain_rows) == (3, 0):
            assert got.full < got.bounded and sum(got.compared) < 0.25 * got.bounded * len(x) * len(starts)
        if chain_rows:
            assert got.full + got.bounded < 70
    assert got.centres[4][3].tolist() == [900.0] * 3
    with pytest.warns(UserWarning, match="still move"):
        assert not km.settle(blocks, starts, 3, 0.0, max_rounds=2).at_rest
    with pytest.warns(UserWarning, match="still move"):
        assert not km.settle(blocks, starts, 3, 0.0, max_rounds=6, warm=1).at_rest


def test_drift_limits():
    before = np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0]])
    now = before + [[3.0, 4.0], [0.0, 1.0], [0.0, 0.0]]
    assert np.allclose(rounds.drift_limits(before, now), [6.0, 6.0, 5.0]) and rounds.drift_limits(before[:1], now[:1]) == pytest.approx(5.0)


def test_saved_density_model_scores_by_its_index(spark, monkeypatch):
    """Scoring by a saved model packs the new rows alone and gives the labels that packing all gives."""
    from cohorts.operators import dbscan as db

    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.3, (300, 3)) for c in (0, 4, 9)])
    df, features = frame(spark, x)
    labels, model = fit_density(df, features, 0.4, 4)
    params = [FeatureParam(f, i, 0.0, 0.0, 1.0, len(x), 0) for i, f in enumerate(features)]
    path = store.save_model(spark, params, model, new_path(spark, "model"))
    store.publish(spark, path, new_path(spark, "serving"), "v1")
    _, saved = store.load_model(spark, path)
    fresh, _ = frame(spark, np.concatenate([x[::7] + 0.05, [[100.0] * 3]]))
    want = labels_of(db.assign_by_model(model, fresh)).tolist()
    packed, pack = [], db.pack
    monkeypatch.setattr(db, "pack", lambda df, splits, keep, name: packed.append(name) or pack(df, splits, keep, name))
    assert labels_of(db.assign_by_model(saved, fresh)).tolist() == want and packed == ["fresh"]
    assert want[-1] == -1 and len(set(want)) == 4


def test_pointers_of_writers_at_the_same_time(spark, monkeypatch):
    df, features = frame(spark, np.array([[0.0], [2.0]]))
    params = [FeatureParam("x", 0, 0.0, 0.0, 1.0, 2, 0)]
    path = store.save_model(spark, params, km.KMeansFit(["x"], [[0.0]], 0.0, 1), new_path(spark, "model"))
    serving = new_path(spark, "serving")
    store.publish(spark, path, serving, "v1")
    monkeypatch.setattr(store, "_last_pointer", lambda spark, folder: 0)  # the second writer looked before the first wrote
    store.publish(spark, path, serving, "v2")
    monkeypatch.undo()
    assert [tuple(r)[:2] for r in store.pointers(spark, serving).orderBy("sequence").collect()] == [(1, "v1"), (2, "v2")]
    assert store.current_version(spark, serving)[0] == "v2"
    assert not store._put_if_absent(spark, f"{serving}/current/000000000002.json", "{}")
    with pytest.raises(RuntimeError):
        monkeypatch.setattr(store, "_last_pointer", lambda spark, folder: 0)
        store.point_to(spark, serving, "v1", tries=2)


def test_leaves_sent_grow_with_rows_and_not_with_pairs(spark, monkeypatch):
    """Sparse rows, all in question: a leaf goes to at most eight tiles a side, whatever the number of leaves near it."""
    from cohorts.operators import blocks

    sent, leaves, dealt, pack = [], [], blocks.dealt, blocks.pack

    def counted(*args, **options):
        together, parts = dealt(*args, **options)
        sent.append(together.count())
        return together, parts

    def packed(*args):
        out = pack(*args)
        leaves.append(out[0].count())
        return out

    monkeypatch.setattr(blocks, "dealt", counted)
    monkeypatch.setattr("cohorts.operators.dbscan.pack", packed)
    x = np.random.default_rng(8).uniform(size=(6000, 4))
    df, features = frame(spark, x)
    got = labels_of(dbscan(df, features, 0.18, 12, broadcast_cells=0))
    np.testing.assert_array_equal(got, brute.dbscan(x, 0.18, 12))
    assert (got == -1).any() and len(sent) == 3
    assert max(sent) <= 16 * leaves[0]


def test_tiles_share_tasks(spark):
    """Tasks are as many as the cores can take, however many tiles there are."""
    rows = [(i % 3, i % 50 + 0.25 * (i % 7)) for i in range(2000)]
    df = spark.createDataFrame(rows, "label int, x double").withColumn("y", F.hash("x", "label") % 97)
    folded = df.selectExpr("x", "cast(y as double) as y", "label as _label", "1L as w", "xxhash64(x, y) as _spread").distinct()
    cut, count = met._blocks(folded, ["_label", "_spread"], ["x", "y"], {"_label": "int", "w": "bigint"}, 4, "blocks")
    tiles = met._tiles(cut, count, 1000, ["xs as xa"], ["xs as xb"])
    assert tiles.count() == count * (count + 1) // 2 > met.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert tiles.rdd.getNumPartitions() <= met.TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def test_blocks_are_sent_by_groups_and_not_by_pairs(spark, monkeypatch):
    """Beyond a broadcast, a block is sent to as many tasks as there are groups, every pair meets once, and scores stay what they are."""
    blocks = spark.range(300).selectExpr("id as block", "array(double(id)) as xs")
    groups = int(np.ceil(np.sqrt(met.TASKS_PER_CORE * spark.sparkContext.defaultParallelism)))

    def listed(batches):
        for pdf in batches:
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "x": [x[0] for x in pdf["xa"]], "y": [y[0] for y in pdf["xb"]]})

    pairs = met._met(blocks, 300, 300, {"x": "xs"}, listed, "a bigint, b bigint, x double, y double", 0).toPandas()
    assert sorted(zip(pairs["a"], pairs["b"])) == [(a, b) for a in range(300) for b in range(a, 300)]
    assert (pairs["a"] == pairs["x"]).all() and (pairs["b"] == pairs["y"]).all()
    counted = lambda batches: (pdf[["block"]] for pdf in batches)
    monkeypatch.setattr(kernels, "held_blocks", lambda kernel, columns: kernel)
    assert groups < 100 and set(met._met(blocks, 300, 300, {"x": "xs"}, counted, "block bigint", 0).toPandas()["block"].value_counts()) == {groups + 1}
    monkeypatch.undo()
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(700, 3)) + rng.integers(0, 3, (700, 1)), 1)
    df, features = frame(spark, x, rng.integers(0, 4, 700))
    labels = df.toPandas()["CLUSTER"].to_numpy()
    assert met.silhouette(df, features, block_rows=9, tile_cells=0) == pytest.approx(brute.silhouette(x, labels), abs=1e-9)


def test_distance_sums_of_near_and_far_rows():
    """Distances of rows that nearly coincide far from the middle are those summed feature by feature."""
    rng = np.random.default_rng(3)
    x, y = 1e6 + rng.normal(size=(70, 3)), 1e6 + rng.normal(size=(45, 3))
    y[:20] = x[:20] + 1e-3 * rng.normal(size=(20, 3))
    la, lb, wa, wb = rng.integers(0, 3, 70), rng.integers(0, 3, 45), rng.integers(1, 4, 70), rng.integers(1, 4, 45)
    tile = {"a": [0], "b": [1], "xa": [x.ravel()], "xb": [y.ravel()], "la": [la], "lb": [lb], "wa": [wa], "wb": [wb]}
    (found,) = kernels.distance_sums(3, 32)(iter([pd.DataFrame(tile)]))
    gap = np.sqrt(np.square(x[:, None] - y[None]).sum(axis=2))
    for block, other, size, sums in found.itertuples(index=False):
        weight = np.where((la if block else lb) == other, wa if block else wb, 0)
        np.testing.assert_allclose(sums, (gap.T if block else gap) @ weight, rtol=1e-9)
        assert size == weight.sum()


def test_round_distances_are_plain_sums_centre_by_centre():
    """Each centre's distances lie side by side, and are to the last digit those summed feature by feature."""
    rng = np.random.default_rng(5)
    x, centres = rng.normal(size=(300, 7)), rng.normal(size=(4, 7))
    found, plain = rounds.distances(x, centres), np.zeros((300, 4))
    for i in range(7):
        plain += np.square(x[:, i, None] - centres[:, i])
    assert np.array_equal(found, plain)
    assert found.T.flags.c_contiguous


def test_stream_batch_of_one_file_is_spread(spark):
    """One landed file is scored by more than one task, and every row once."""
    params = [FeatureParam(f, i, 0.0, 0.0, 1.0, 200, 0) for i, f in enumerate(["x", "y"])]
    model = km.KMeansFit(["x", "y"], [[0.0, 0.0], [100.0, 0.0]], 0.0, 1)
    serving, folder, output = new_path(spark, "serving"), new_path(spark, "landing"), new_path(spark, "out")
    store.publish(spark, store.save_model(spark, params, model, new_path(spark, "model")), serving, "v1")
    df = spark.range(200).selectExpr("concat('C', id) as CUST_ID", "cast(id as double) as x", "0.0D as y")
    df.coalesce(1).write.csv(folder, header=True)
    columns = ["CUST_ID", "x", "y"]
    landing.score_landing(spark, folder, serving, output, new_path(spark, "state"), columns).awaitTermination()
    scored = landing.read_scored(spark, output, columns)
    assert {r["CUST_ID"]: r["CLUSTER"] for r in scored.collect()} == {f"C{i}": int(i > 50) for i in range(200)}
    assert scored.count() == 200
    assert spark.read.format("binaryFile").load(f"{output}/batch=0/*.parquet").count() > 1


def test_density_tables_go_once_they_are_spent(spark):
    """Leaves, tagged rows and rows that met others are gone when labels are read; results still come."""
    rng = np.random.default_rng(11)
    x = np.round(blobs(rng, 900, 3), 6)
    df, features = frame(spark, x)
    y = x[::3] + rng.normal(0, 0.2, size=x[::3].shape)
    fresh, _ = frame(spark, y)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def tables(path):
        """Names of tables below, without their numbers."""
        names = [f.getPath().getName() for f in files.listStatus(path)]
        runs = [n for n in names if n.startswith("run-")]
        return sum((tables(path.suffix(f"/{r}")) for r in runs), [n.rsplit("-", 1)[0] for n in names if n not in runs])

    with own_scratch(spark):
        labels, model = fit_density(df, features, 0.5, 5)
        (mine,) = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("run-")]
        left = tables(mine)
        assert not {"leaves", "known", "asked", "counts", "sample", "tagged", "given", "boxes"} & set(left), left
        assert np.array_equal(labels_of(labels), brute.dbscan(x, 0.5, 5))
        found = labels_of(assign_by_model(model, fresh))
        assert not {"leaves", "core", "asked", "first", "tagged", "given"} & set(tables(mine))
        gaps = np.square(y[:, None] - x[None]).sum(axis=2)
        core = (np.square(x[:, None] - x[None]).sum(axis=2) <= 0.25).sum(axis=1) >= 5
        gaps[:, ~core] = np.inf
        near = brute.dbscan(x, 0.5, 5)[gaps.argmin(axis=1)]
        assert np.array_equal(found, np.where(gaps.min(axis=1) <= 0.25, near, -1))


def test_nearest_core_opens_leaves_by_row(monkeypatch):
    """Two new rows at the ends of a box that spans all leaves open those around them, and find what brute force finds."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(40, 1, 2)) * 0.1 + np.arange(40)[:, None, None] * 10 + rng.normal(size=(40, 32, 2)), 6)
    y = np.array([[1.0, 1.0], [391.0, 390.0]])
    opened = []

    class Seen(kernels.Held):
        def __init__(self, pdf, p):
            super().__init__(pdf, p)
            held = self.x

            class Rows:
                def __getitem__(self, rows):
                    opened.append(len(rows))
                    return held[rows]

            self.x = Rows()

    monkeypatch.setattr(kernels, "Held", Seen)
    splits = SimpleNamespace(middle=np.zeros(2), axes=np.eye(2))
    leaf = lambda side, n, rows, tag, most: (0, side, n, rows.min(axis=0), rows.max(axis=0), rows.ravel(), np.arange(len(rows)), tag, most)
    rows = [leaf(0, n, part, np.full(32, n), None) for n, part in enumerate(x)] + [leaf(1, 0, y, np.ones(2), np.full(2, 25.0))]
    pdf = pd.DataFrame(rows, columns=["tile", "side", "leaf", "lo", "hi", "xs", "pos", "tag", "most"])
    found = pd.concat(kernels.nearest_core(2, 25.0, 25.0 * (1 + 1e-9), 8, splits)(iter([pdf])))
    gaps = np.square(y[:, None] - x.reshape(-1, 2)[None]).sum(axis=2)
    assert found["pid"].tolist() == [0, 1] and found["label"].tolist() == (gaps.argmin(axis=1) // 32).tolist()
    assert np.allclose(found["d2"], gaps.min(axis=1), rtol=1e-12) and sum(opened) <= x.shape[0] * 32 // 4
