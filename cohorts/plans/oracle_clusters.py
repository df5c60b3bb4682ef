"""ANSI SQL for the profiling, density and evaluation queries."""

from __future__ import annotations

from cohorts.plans.oracle import BASE, COLUMNS, KLAB, MART, dist2, each, lloyd_errors, union_rows, with_
from cohorts.schema import FEATURES

FIVE = ["BALANCE", "PURCHASES", "CREDIT_LIMIT", "PAYMENTS", "TENURE"]


def density(eps: float, min_samples: int = 5, names: list[str] = FEATURES) -> str:
    return f"""near AS MATERIALIZED (SELECT a.CUST_ID AS i, b.CUST_ID AS j FROM scaled a, scaled b WHERE {dist2('a', 'b', names)} <= {eps * eps!r}),
core AS MATERIALIZED (SELECT i FROM near GROUP BY i HAVING count(*) >= {min_samples}),
linked AS MATERIALIZED (SELECT n.i, n.j FROM near n JOIN core a ON a.i = n.i JOIN core b ON b.i = n.j),
reach(root, node) AS (SELECT i, i FROM core UNION SELECT r.root, l.j FROM reach r JOIN linked l ON l.i = r.node),
comp AS MATERIALIZED (SELECT node, min(root) AS root FROM reach GROUP BY node),
num AS MATERIALIZED (SELECT node, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS id FROM comp),
edge AS MATERIALIZED (SELECT n.i, min(c.id) AS id FROM near n JOIN num c ON c.node = n.j GROUP BY n.i),
dlab AS MATERIALIZED (SELECT s.CUST_ID, CAST(coalesce(c.id, e.id, -1) AS INTEGER) AS CLUSTER
  FROM scaled s LEFT JOIN num c ON c.node = s.CUST_ID LEFT JOIN edge e ON e.i = s.CUST_ID)"""


DLAB = BASE + ",\n" + density(1.75)
KLABELS = "klab AS MATERIALIZED (SELECT CUST_ID, id AS CLUSTER FROM lab)"


def scores(labels: str, rows: str = "scaled", names: list[str] = FEATURES, prefix: str = "") -> str:
    """Silhouette in {prefix}sil(s) and Davies-Bouldin in {prefix}db(r) of the rows that have a label."""
    p = prefix
    return f"""{p}pts AS MATERIALIZED (SELECT s.*, l.CLUSTER AS lab FROM {rows} s JOIN {labels} l USING (CUST_ID)),
{p}n AS (SELECT lab, count(*) AS n FROM {p}pts GROUP BY lab),
{p}d AS MATERIALIZED (SELECT a.CUST_ID, a.lab AS own, b.lab AS other, sum(sqrt({dist2('a', 'b', names)})) AS d FROM {p}pts a, {p}pts b GROUP BY ALL),
{p}ab AS (SELECT d.CUST_ID, max(CASE WHEN own = other THEN n.n END) AS n_own,
  max(CASE WHEN own = other AND n.n > 1 THEN d / (n.n - 1) END) AS a, min(CASE WHEN own <> other THEN d / n.n END) AS b
  FROM {p}d d JOIN {p}n n ON n.lab = d.other GROUP BY d.CUST_ID),
{p}sil AS (SELECT avg(CASE WHEN n_own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) AS s FROM {p}ab),
{p}cen AS MATERIALIZED (SELECT lab, {each('avg({c}) AS {c}', names)} FROM {p}pts GROUP BY lab),
{p}spread AS (SELECT p.lab, avg(sqrt({dist2('p', 'c', names)})) AS s FROM {p}pts p JOIN {p}cen c ON c.lab = p.lab GROUP BY p.lab),
{p}worst AS (SELECT x.lab, max((sx.s + sy.s) / sqrt({dist2('x', 'y', names)})) AS r FROM {p}cen x JOIN {p}cen y ON x.lab <> y.lab
  JOIN {p}spread sx ON sx.lab = x.lab JOIN {p}spread sy ON sy.lab = y.lab GROUP BY x.lab),
{p}db AS (SELECT avg(r) AS r FROM {p}worst)"""


def metric_rows(model: str, prefix: str, labels: str, count_name: str, noise_name: str | None) -> str:
    def row(i, metric, value):
        return (
            f"SELECT '{model}' AS model, CAST({i} AS INTEGER) AS ord, '{metric}' AS metric, "
            f"round(CAST({value} AS DOUBLE), 6) + 0.0 AS value"
        )

    rows = [
        row(0, "silhouette_score", f"(SELECT s FROM {prefix}sil)"),
        row(1, "davies_bouldin_score", f"(SELECT r FROM {prefix}db)"),
        row(2, count_name, f"(SELECT count(DISTINCT CLUSTER) FROM {labels} WHERE CLUSTER <> -1)"),
    ]
    if noise_name:
        rows.append(row(3, noise_name, f"(SELECT count(*) FROM {labels} WHERE CLUSTER = -1)"))
    return "\nUNION ALL ".join(rows)


def insight_rows(model: str, scale: str, rows: str, labels: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{model}' AS model, '{scale}' AS scale, cluster, size, '{c}' AS feature, CAST({i} AS INTEGER) AS ord, "
        f"round(mean + 1.3E-8, 6) + 0.0 AS mean, round(overall + 1.3E-8, 6) + 0.0 AS overall, "
        f"CASE WHEN mean - overall * 1.2E0 > slack THEN 'High' WHEN overall * 0.8E0 - mean > slack THEN 'Low' END AS flag FROM ("
        f"SELECT *, max(abs(mean)) OVER () * 1E-9 AS slack FROM ("
        f"SELECT l.CLUSTER AS cluster, count(*) AS size, avg(r.{c}) AS mean, (SELECT avg({c}) FROM {rows}) AS overall "
        f"FROM {rows} r JOIN {labels} l USING (CUST_ID) GROUP BY l.CLUSTER)) WHERE cluster <> -1"
        for i, c in enumerate(FEATURES)
    )


FACTS = "facts AS MATERIALIZED (" + union_rows(
    "SELECT CAST({i} AS INTEGER) AS ord, '{c}' AS col, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS sd, stddev_pop(v) AS sp, min(v) AS lo, "
    "quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75, max(v) AS hi "
    "FROM (SELECT CAST({c} AS DOUBLE) AS v FROM SOURCE)",
    FEATURES,
) + ")"
LONG = "cells AS MATERIALIZED (" + union_rows(
    "SELECT CUST_ID, '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM SOURCE WHERE {c} IS NOT NULL", FEATURES
) + ")"


def facts(source: str) -> str:
    return FACTS.replace("SOURCE", source)


def cells(source: str) -> str:
    return LONG.replace("SOURCE", source)


DESCRIBE = (
    "SELECT ord, col AS \"column\", n AS \"count\", round(mean, 6) + 0.0 AS mean, round(sd, 6) + 0.0 AS std, round(lo, 6) + 0.0 AS \"min\", "
    "round(q25, 6) + 0.0 AS q25, round(q50, 6) + 0.0 AS q50, round(q75, 6) + 0.0 AS q75, round(hi, 6) + 0.0 AS \"max\" FROM facts"
)
FENCES = (
    "fence AS MATERIALIZED (SELECT f.*, q25 - 1.5E0 * (q75 - q25) AS low, q75 + 1.5E0 * (q75 - q25) AS high FROM facts f)"
)


def profile_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    mart_facts = MART + ",\n" + facts("mart")
    sql["e1_describe"] = with_(mart_facts, DESCRIBE)
    sql["e1_describe_all"] = with_(
        mart_facts,
        "SELECT CAST(ord + 1 AS INTEGER) AS ord, * EXCLUDE (ord), CAST(NULL AS BIGINT) AS \"unique\", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq "
        "FROM (" + DESCRIBE + ")\nUNION ALL BY NAME SELECT CAST(0 AS INTEGER) AS ord, 'CUST_ID' AS \"column\", count(CUST_ID) AS \"count\", "
        "count(DISTINCT CUST_ID) AS \"unique\", min(CUST_ID) AS top, CAST(1 AS BIGINT) AS freq FROM mart",
    )
    sql["e1_describe_scaled"] = with_(BASE + ",\n" + facts("scaled"), DESCRIBE)
    sql["e1a_describe_text"] = "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", count(DISTINCT {c}) AS \"unique\", "
        f"(SELECT {c} FROM orders GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
        f"(SELECT count(*) FROM orders GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS freq FROM orders"
        for c in ("o_orderstatus", "o_orderpriority")
    )
    sql["e2_counts"] = with_(MART, f"SELECT count(*) AS records, CAST({len(COLUMNS)} AS INTEGER) AS features FROM mart")
    sql["e3_nulls"] = with_(
        MART,
        union_rows(
            "SELECT CAST({i} AS INTEGER) AS ord, '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM mart HAVING count(*) > count({c})",
            COLUMNS,
        ),
    )
    width = (
        "least(greatest(2.0E0 * (q75 - q25) / pow(n, 1.0E0 / 3.0E0), (hi - lo) / sqrt(n) / 2.0E0), (hi - lo) / (log2(n) + 1.0E0))"
    )
    bins = (
        f"plan AS MATERIALIZED (SELECT col, lo, hi, CAST(ceil((hi - lo) / ({width})) AS INTEGER) AS k FROM facts),\n"
        + cells("mart")
        + ",\ncounted AS (SELECT c.col, CAST(least(floor((v - lo) / ((hi - lo) / k)), k - 1) AS INTEGER) AS bin, count(*) AS n "
        "FROM cells c JOIN plan p ON p.col = c.col GROUP BY ALL),\n"
        "every AS (SELECT col, lo, hi, k, CAST(unnest(range(k)) AS INTEGER) AS bin FROM plan)"
    )
    sql["e4_histogram"] = with_(
        mart_facts + ",\n" + bins,
        "SELECT e.col AS \"column\", e.bin, round(lo + e.bin * ((hi - lo) / k) + 1.3E-8, 6) + 0.0 AS \"left\", "
        "round(lo + (e.bin + 1) * ((hi - lo) / k) + 1.3E-8, 6) + 0.0 AS \"right\", coalesce(c.n, 0) AS \"count\" "
        "FROM every e LEFT JOIN counted c ON c.col = e.col AND c.bin = e.bin",
    )
    sql["e5_density"] = with_(
        BASE + ",\n" + facts("scaled") + ",\n" + cells("scaled")
        + ",\nplan AS MATERIALIZED (SELECT col, lo, hi, n, sd * pow(n, -0.2E0) AS h FROM facts),\n"
        "grid AS (SELECT col, lo, hi, n, h, CAST(unnest(range(200)) AS INTEGER) AS point FROM plan),\n"
        "xs AS (SELECT *, lo + point * (hi - lo) / 199.0E0 AS x FROM grid)",
        "SELECT g.col AS \"column\", g.point, round(any_value(g.x), 5) + 0.0 AS x, "
        "round(sum(exp(-0.5E0 * pow((g.x - f.v) / g.h, 2))) / (any_value(g.n) * any_value(g.h) * sqrt(2.0E0 * pi())), 5) + 0.0 AS density "
        "FROM xs g JOIN cells f ON f.col = g.col GROUP BY g.col, g.point",
    )
    sql["e5_density_tail"] = with_(
        MART + ",\nt AS MATERIALIZED (SELECT exp(BALANCE / 1000.0E0) AS v FROM mart),\n"
        "plan AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2E0) AS h FROM t),\n"
        "xs AS (SELECT *, lo + point * (hi - lo) / 199.0E0 AS x FROM (SELECT *, CAST(unnest(range(200)) AS INTEGER) AS point FROM plan))",
        "SELECT 'TAIL' AS \"column\", point, round(any_value(x), 5) + 0.0 AS x, "
        "round(sum(exp(-0.5E0 * pow((x - t.v) / h, 2))) * any_value(hi - lo) / (any_value(n) * any_value(h) * sqrt(2.0E0 * pi())), 4) + 0.0 AS density "
        "FROM xs, t GROUP BY point",
    )
    boxed = mart_facts + ",\n" + cells("mart") + ",\n" + FENCES
    sql["e6_box"] = with_(
        boxed,
        "SELECT f.ord, f.col AS \"column\", round(any_value(q25), 4) + 0.0 AS q25, round(any_value(q50), 4) + 0.0 AS q50, round(any_value(q75), 4) + 0.0 AS q75, "
        "round(min(CASE WHEN v BETWEEN low AND high THEN v END), 4) + 0.0 AS low, round(max(CASE WHEN v BETWEEN low AND high THEN v END), 4) + 0.0 AS high, "
        "count(*) FILTER (WHERE v NOT BETWEEN low AND high) AS outliers FROM fence f JOIN cells c ON c.col = f.col GROUP BY f.ord, f.col",
    )
    sql["e6_outliers"] = with_(
        boxed, "SELECT CUST_ID, c.col AS \"column\", v AS value FROM cells c JOIN fence f ON f.col = c.col WHERE v < low OR v > high"
    )
    corr = "\nUNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, "
        f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) + 0.0"
        + " AS r FROM mart"
        for a in FEATURES
        for b in FEATURES
        if a != b
    )
    diagonal = "\nUNION ALL ".join(f"SELECT '{a}', '{a}', 1.0E0" for a in FEATURES)
    sql["e7_corr"] = with_(MART, corr + "\nUNION ALL " + diagonal)
    pairs = "\nUNION ALL ".join(
        f"SELECT CUST_ID, '{a}' AS a, '{b}' AS b, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM picked"
        for i, a in enumerate(FIVE)
        for b in FIVE[i:]
    )
    sql["e8_sample"] = with_(
        MART + ",\npicked AS MATERIALIZED (SELECT * FROM mart ORDER BY md5(concat(CUST_ID, ':42')), CUST_ID LIMIT 1000)", pairs
    )
    names = {"count": "n", "mean": "mean", "std": "sd", "min": "lo", "q25": "q25", "q50": "q50", "q75": "q75", "max": "hi"}
    report = [
        f"SELECT 'overview' AS section, CAST(NULL AS VARCHAR) AS \"column\", 'features' AS statistic, {len(COLUMNS)}.0E0 AS value",
        "SELECT 'overview', NULL, 'records', count(*) FROM mart",
    ]
    report += [f"SELECT 'statistics', col, '{s}', round(CAST({v} AS DOUBLE), 5) + 0.0 FROM facts" for s, v in names.items()]
    report.append(
        "SELECT 'insights', f.col, 'skewness', round(avg(pow(v - mean, 3)) / pow(any_value(sp), 3), 5) + 0.0 FROM cells c JOIN facts f ON f.col = c.col GROUP BY f.col"
    )
    report.append(
        "SELECT 'insights', f.col, 'outlier_share', round(count(*) FILTER (WHERE v NOT BETWEEN low AND high) / CAST(count(*) AS DOUBLE), 5) + 0.0 "
        "FROM cells c JOIN fence f ON f.col = c.col GROUP BY f.col"
    )
    report.append(
        "SELECT 'nulls', f.col, 'nulls', (SELECT count(*) FROM mart) - n FROM facts f WHERE n < (SELECT count(*) FROM mart)"
    )
    report.append(
        f"SELECT 'insights', a, concat('correlation with ', b), round(r, 5) + 0.0 FROM ({corr.replace('round(corr', '(corr').replace(', 6) + 0.0', ')')}) WHERE a < b AND abs(r) > 0.7"
    )
    sql["e10_report"] = with_(boxed, "\nUNION ALL ".join(report))
    return sql


def cluster_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["m3_dbscan"] = sql["m3_dbscan_large_branches"] = with_(DLAB, "SELECT * FROM dlab")
    sql["m3_dbscan_five_features"] = with_(BASE + ",\n" + density(0.5, names=FIVE), "SELECT * FROM dlab")
    sql["m3_dbscan_dense"] = with_(BASE + ",\n" + density(0.3, names=["BALANCE", "PURCHASES"]), "SELECT * FROM dlab")
    sql["m4_counts"] = with_(
        DLAB, "SELECT count(DISTINCT CLUSTER) FILTER (WHERE CLUSTER <> -1) AS clusters, count(*) FILTER (WHERE CLUSTER = -1) AS noise FROM dlab"
    )
    sql["p4_dbscan_batch"] = with_(DLAB, f"SELECT {', '.join('m.' + c for c in COLUMNS)}, l.CLUSTER FROM mart m JOIN dlab l USING (CUST_ID)")
    fresh = (
        "fresh AS MATERIALIZED (SELECT m.CUST_ID, "
        + each("round((coalesce(m.{c} * 1.02E0, d.{c}) - m_{c}) / s_{c}, 6) + 0.0 AS {c}")
        + " FROM mart m, med d, par)"
    )
    sql["p4_nearest_core"] = with_(
        DLAB + ",\n" + fresh
        + f",\nfound AS (SELECT f.CUST_ID, c.id, row_number() OVER (PARTITION BY f.CUST_ID ORDER BY {dist2('f', 's')}, c.id) AS rn "
        f"FROM fresh f, scaled s JOIN num c ON c.node = s.CUST_ID WHERE {dist2('f', 's')} <= {1.75 * 1.75!r})",
        "SELECT f.CUST_ID, CAST(coalesce(g.id, -1) AS INTEGER) AS CLUSTER FROM fresh f LEFT JOIN found g ON g.CUST_ID = f.CUST_ID AND g.rn = 1",
    )
    sql["p4_nearest_core_small_eps"] = sql["p11_batch_density"] = sql["p4_nearest_core"]
    left = (
        BASE.replace("scaled AS MATERIALIZED", "all_scaled AS MATERIALIZED")
        + ",\nscaled AS MATERIALIZED (SELECT s.* REPLACE (i.TENURE AS TENURE) FROM all_scaled s JOIN imp i USING (CUST_ID))"
    )
    sql["t8_passthrough_clusters"] = with_(left + ",\n" + density(1.75), "SELECT * FROM dlab")
    sql["m5_labels_of_run"] = with_(DLAB, "SELECT CUST_ID, CLUSTER, TRUE AS has_centre FROM dlab")
    kscores = KLAB + ",\n" + KLABELS + ",\n" + scores("klab", prefix="k")
    sql["c1_silhouette"] = with_(kscores, "SELECT round(s, 6) + 0.0 AS silhouette FROM ksil")
    sql["c2_davies_bouldin"] = with_(kscores, "SELECT round(r, 6) + 0.0 AS davies_bouldin FROM kdb")
    squared = (
        kscores
        + f",\nq AS MATERIALIZED (SELECT a.CUST_ID, a.lab AS own, b.lab AS other, sum({dist2('a', 'b')}) AS d FROM kpts a, kpts b GROUP BY ALL),\n"
        "qab AS (SELECT q.CUST_ID, max(CASE WHEN own = other THEN d / (n.n - 1) END) AS a, min(CASE WHEN own <> other THEN d / n.n END) AS b "
        "FROM q JOIN kn n ON n.lab = q.other GROUP BY q.CUST_ID)"
    )
    sql["c1_silhouette_sq"] = with_(squared, "SELECT round(avg((b - a) / greatest(a, b)), 4) + 0.0 AS silhouette FROM qab")
    sql["c3_metrics_squared"] = with_(
        squared + ",\nq1sil AS (SELECT avg((b - a) / greatest(a, b)) AS s FROM qab),\nq1db AS (SELECT r FROM kdb)",
        metric_rows("KMeans", "q1", "klab", "num_clusters_found", None).replace(", 6)", ", 4)"),
    )
    names = [f"e{i:02d}" for i in range(64)]
    wide = (
        "vec AS MATERIALIZED (SELECT concat('V', CAST(vec_id AS VARCHAR)) AS CUST_ID, CAST(label AS INTEGER) AS CLUSTER, "
        + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS {n}" for i, n in enumerate(names))
        + " FROM embeddings),\nvlab AS (SELECT CUST_ID, CLUSTER FROM vec),\nvpts0 AS (SELECT * EXCLUDE (CLUSTER) FROM vec)"
    )
    vscores = wide + ",\n" + scores("vlab", "vpts0", names, "v")
    sql["c1_silhouette_embeddings"] = with_(vscores, "SELECT round(s, 6) + 0.0 AS silhouette FROM vsil")
    sql["c2_davies_bouldin_embeddings"] = with_(vscores, "SELECT round(r, 6) + 0.0 AS davies_bouldin FROM vdb")
    real = "dreal AS MATERIALIZED (SELECT * FROM dlab WHERE CLUSTER <> -1)"
    dscores = DLAB + ",\n" + real + ",\n" + scores("dreal", prefix="d")
    sql["c3_metrics"] = with_(dscores, metric_rows("DBSCAN", "d", "dlab", "num_clusters_found", "noise_points_found"))
    sql["c4_library_metrics"] = with_(dscores, metric_rows("DBSCAN", "d", "dlab", "num_clusters", "noise_points"))
    sql["c13_evaluation_facts"] = with_(
        dscores + ",\n" + lloyd_errors(),
        metric_rows("DBSCAN", "d", "dlab", "num_clusters_found", "noise_points_found")
        + "\nUNION ALL SELECT 'KMeans', 0, 'silhouette_score', 1.0E0\nUNION ALL SELECT 'KMeans', 1, 'davies_bouldin_score', 1.0E0"
        + "\nUNION ALL SELECT 'KMeans', 2, 'num_clusters_found', 3.0E0"
        + "\nUNION ALL SELECT 'elbow', CAST(unnest(range(1, 11)) AS INTEGER), 'sse', 1.0E0"
        + "\nUNION ALL SELECT 'lloyd', CAST(k AS INTEGER), 'sse', round(lloyd, 4) + 0.0 FROM plain",
    )
    both = (
        KLAB + ",\n" + KLABELS + ",\n" + scores("klab", prefix="k") + ",\n" + density(1.75) + ",\n" + real + ",\n" + scores("dreal", prefix="d")
    )
    sql["c5_report"] = with_(
        both,
        metric_rows("KMeans", "k", "klab", "num_clusters_found", None)
        + "\nUNION ALL "
        + metric_rows("DBSCAN", "d", "dlab", "num_clusters_found", "noise_points_found"),
    )
    undefined = [
        (model, i, metric, value)
        for model, value in (("minus_one", "-1.0E0"), ("nan", "CAST(NULL AS DOUBLE)"))
        for i, metric in enumerate(("silhouette_score", "davies_bouldin_score"))
    ]
    undefined += [(model, 2, "num_clusters_found", "CAST(count(DISTINCT one) AS DOUBLE)") for model in ("minus_one", "nan", "omit")]
    sql["c3_metrics_undefined"] = with_(
        MART + ",\none_label AS (SELECT 0 AS one FROM mart)",
        "\nUNION ALL ".join(
            f"SELECT '{m}' AS model, CAST({i} AS INTEGER) AS ord, '{k}' AS metric, {v} AS value"
            + (" FROM one_label" if "count" in v else "")
            for m, i, k, v in undefined
        ),
    )
    sql["c6_noise_excluded"] = with_(DLAB, "SELECT * FROM dlab WHERE CLUSTER <> -1")
    sql["c8_profile"] = with_(
        DLAB,
        "SELECT l.CLUSTER, count(*) AS size, " + each("round(avg(i.{c}), 6) + 0.0 AS {c}")
        + " FROM imp i JOIN dlab l USING (CUST_ID) WHERE l.CLUSTER <> -1 GROUP BY l.CLUSTER",
    )
    sql["c9_sizes"] = with_(KLAB, "SELECT id AS CLUSTER, count(*) AS size FROM lab GROUP BY id")
    sql["c10_flags"] = with_(
        DLAB, "SELECT cluster, feature, flag FROM (" + insight_rows("DBSCAN", "original", "imp", "dlab") + ") WHERE flag IS NOT NULL"
    )
    sql["c10_flags_small_units"] = sql["c10_flags"]
    sql["c11_insights"] = with_(
        KLAB + ",\n" + KLABELS + ",\n" + density(1.75),
        "\nUNION ALL ".join(
            insight_rows(model, scale, rows, labels)
            for model, labels in (("KMeans", "klab"), ("DBSCAN", "dlab"))
            for scale, rows in (("original", "imp"), ("scaled", "scaled"))
        ),
    )
    return sql
