"""ANSI SQL giving the same rows as the registered queries, for the result check."""

from __future__ import annotations

from cohorts.schema import EXPECTED_TYPES, FEATURES

COLUMNS = list(EXPECTED_TYPES)
INTS = ["CASH_ADVANCE_TRX", "PURCHASES_TRX", "TENURE"]

MART = """mart AS MATERIALIZED (
WITH o AS (
  SELECT o_custkey,
    count(DISTINCT year(o_orderdate)*100 + month(o_orderdate))/80.0E0 AS BALANCE_FREQUENCY,
    round(sum(o_totalprice),2) AS PURCHASES,
    round(sum(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN o_totalprice ELSE 0.0E0 END),2) AS ONEOFF_PURCHASES,
    round(sum(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 0.0E0 ELSE o_totalprice END),2) AS INSTALLMENTS_PURCHASES,
    round(sum(CASE WHEN o_orderstatus='P' THEN o_totalprice ELSE 0.0E0 END),2) AS CASH_ADVANCE,
    count(*)/80.0E0 AS PURCHASES_FREQUENCY,
    sum(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1.0E0 ELSE 0.0E0 END)/80.0E0 AS ONEOFF_PURCHASES_FREQUENCY,
    sum(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 0.0E0 ELSE 1.0E0 END)/80.0E0 AS PURCHASES_INSTALLMENTS_FREQUENCY,
    sum(CASE WHEN o_orderstatus='P' THEN 1.0E0 ELSE 0.0E0 END)/80.0E0 AS CASH_ADVANCE_FREQUENCY,
    CAST(sum(CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END) AS BIGINT) AS CASH_ADVANCE_TRX,
    count(*) AS PURCHASES_TRX,
    max(CASE WHEN o_orderpriority='1-URGENT' THEN o_totalprice END) AS CREDIT_LIMIT,
    round(sum(CASE WHEN o_orderstatus='F' THEN o_totalprice ELSE 0.0E0 END),2) AS PAYMENTS,
    min(CASE WHEN o_orderstatus='P' THEN o_totalprice END) AS MINIMUM_PAYMENTS,
    sum(CASE WHEN o_orderstatus='F' THEN 1.0E0 ELSE 0.0E0 END)/count(*) AS PRC_FULL_PAYMENT,
    count(DISTINCT year(o_orderdate)) AS TENURE
  FROM orders GROUP BY o_custkey)
SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS CUST_ID, c_acctbal AS BALANCE, o.* EXCLUDE (o_custkey)
FROM customer JOIN o ON c_custkey = o_custkey)"""


def each(template: str, names: list[str] = FEATURES, sep: str = ", ") -> str:
    return sep.join(template.format(c=c, i=i) for i, c in enumerate(names))


IMPUTED = (
    "med AS MATERIALIZED (SELECT "
    + each("median(CAST({c} AS DOUBLE)) AS {c}")
    + " FROM mart),\nimp AS MATERIALIZED (SELECT m.CUST_ID, "
    + each("coalesce(CAST(m.{c} AS DOUBLE), d.{c}) AS {c}")
    + " FROM mart m, med d)"
)
PARAMS = (
    "par AS MATERIALIZED (SELECT "
    + each("avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}")
    + " FROM imp)"
)
SCALED = (
    "scaled AS MATERIALIZED (SELECT CUST_ID, "
    + each("round(({c} - m_{c}) / (CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END), 6) + 0.0 AS {c}")
    + " FROM imp, par)"
)
BASE = ",\n".join([MART, IMPUTED, PARAMS, SCALED])


def dist2(a: str, b: str, names: list[str] = FEATURES) -> str:
    return each(f"({a}.{{c}}-{b}.{{c}})*({a}.{{c}}-{b}.{{c}})", names, "+")


def lloyd(rows: str = "scaled", names: list[str] = FEATURES, k: int = 3, rounds: int = 5, prefix: str = "") -> str:
    """Rounds unrolled: centres in {prefix}cen{n}, labels against the last centres in {prefix}lab."""
    p = prefix
    parts = [
        f"{p}cen0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY CUST_ID) - 1 AS INTEGER) AS id, "
        + ", ".join(names)
        + f" FROM {rows} ORDER BY CUST_ID LIMIT {k})"
    ]

    def labels(n: int, name: str) -> str:
        return (
            f"{name} AS MATERIALIZED (SELECT CUST_ID, id, d2 FROM (SELECT s.CUST_ID, c.id, {dist2('s', 'c', names)} AS d2, "
            f"row_number() OVER (PARTITION BY s.CUST_ID ORDER BY {dist2('s', 'c', names)}, c.id) AS rn "
            f"FROM {rows} s, {p}cen{n} c) WHERE rn = 1)"
        )

    for n in range(rounds):
        parts.append(labels(n, f"{p}lab{n}"))
        parts.append(
            f"{p}cen{n + 1} AS MATERIALIZED (SELECT c.id, "
            + each("coalesce(avg(s.{c}), any_value(c.{c})) AS {c}", names)
            + f" FROM {p}cen{n} c LEFT JOIN {p}lab{n} l ON l.id = c.id LEFT JOIN {rows} s ON s.CUST_ID = l.CUST_ID GROUP BY c.id)"
        )
    parts.append(labels(rounds, f"{p}lab"))
    return ",\n".join(parts)


KLAB = BASE + ",\n" + lloyd()


def lloyd_errors(rounds: int = 5, last: int = 10) -> str:
    """Plain rounds for k = 2 to ``last`` at once; their errors in plain(k, lloyd)."""
    parts = [
        "kcen0 AS MATERIALIZED (SELECT k, id, " + each("{c}") + " FROM (SELECT row_number() OVER (ORDER BY CUST_ID) - 1 AS id, * FROM scaled), "
        f"range(2, {last + 1}) t(k) WHERE id < k)"
    ]
    for n in range(rounds + 1):
        parts.append(
            f"knear{n} AS MATERIALIZED (SELECT * FROM (SELECT s.CUST_ID, c.k, c.id, {dist2('s', 'c')} AS d2, "
            f"row_number() OVER (PARTITION BY s.CUST_ID, c.k ORDER BY {dist2('s', 'c')}, c.id) AS rn FROM scaled s, kcen{n} c) WHERE rn = 1)"
        )
        if n < rounds:
            parts.append(
                f"kcen{n + 1} AS MATERIALIZED (SELECT c.k, c.id, " + each("coalesce(avg(s.{c}), any_value(c.{c})) AS {c}")
                + f" FROM kcen{n} c LEFT JOIN knear{n} l ON l.k = c.k AND l.id = c.id LEFT JOIN scaled s ON s.CUST_ID = l.CUST_ID GROUP BY c.k, c.id)"
            )
    parts.append(f"plain AS MATERIALIZED (SELECT k, sum(d2) AS lloyd FROM knear{rounds} GROUP BY k)")
    return ",\n".join(parts)


def with_(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{body}"


SCORED_COLUMNS = "m.CUST_ID, " + each("m.{c}")


def union_rows(template: str, names: list[str]) -> str:
    return each(template, names, "\nUNION ALL ")


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    mart_rows = "SELECT * FROM mart"
    sql["mart"] = with_(MART, mart_rows)
    sql["s1_csv_typed"] = sql["s2_csv_sink"] = sql["s3_snapshot"] = sql["mart"]
    sql["s4_synthetic"] = (
        "SELECT concat('DUMMY_CUST', CAST(c_custkey AS VARCHAR)) AS CUST_ID, "
        + each(
            "CAST(('0x' || substr(md5(concat(CAST(c_custkey AS VARCHAR), ':{c}:a:42')), 1, 8)) AS BIGINT) / 4294967296.0 * 100.0E0"
            " + floor(CAST(('0x' || substr(md5(concat(CAST(c_custkey AS VARCHAR), ':{c}:b:42')), 1, 8)) AS BIGINT) / 4294967296.0 * 50.0E0) AS {c}"
        )
        + " FROM customer"
    )
    sql["s1_csv_quoted"] = with_(MART, "SELECT 'C \"' || CUST_ID || '\"\", 1,' AS CUST_ID, * EXCLUDE (CUST_ID) FROM mart")
    sql["s3_snapshot_runs"] = with_(MART, "SELECT CUST_ID, BALANCE, PURCHASES, CAST(TENURE AS DOUBLE) AS EXTRA FROM mart")
    report = "CAST({ord} AS INTEGER) AS ord, '{section}' AS section, {check} AS \"check\", {column} AS \"column\", {status} AS status, {message} AS message, '{sev}' AS severity"
    sql["v1_columns"] = "SELECT " + report.format(
        ord=0, section="schema_validation", check="'Column Presence'", column="CAST(NULL AS VARCHAR)",
        status="'SUCCESS'", message="'All expected columns present.'", sev="hard",
    )

    # The raw frame of the checks: text everywhere, words in MINIMUM_PAYMENTS, fractions in TENURE.
    raw = (
        MART
        + ",\nraw AS (SELECT * REPLACE (CASE WHEN CREDIT_LIMIT IS NULL THEN 'TEXT' ELSE CAST(MINIMUM_PAYMENTS AS VARCHAR) END AS MINIMUM_PAYMENTS,"
        " TENURE + (CASE WHEN PURCHASES_TRX > 10 THEN 0.5E0 ELSE 0.0E0 END) AS TENURE) FROM mart)"
    )
    type_row = "SELECT " + report.format(
        ord="{ord}", section="schema_validation", check="'Data Type - {c}'", column="'{c}'",
        status="{status}", message="{message}", sev="warn",
    )
    sql["v2_types"] = with_(
        raw,
        type_row.format(ord=1, c="CUST_ID", status="'SUCCESS'", message="CAST(NULL AS VARCHAR)")
        + "\nUNION ALL "
        + type_row.format(
            ord=16, c="MINIMUM_PAYMENTS", status="'FAIL'",
            message="'Data type mismatch for column ''MINIMUM_PAYMENTS''. Expected: float64, Actual: object'",
        )
        + " FROM raw HAVING count(*) FILTER (WHERE MINIMUM_PAYMENTS IS NOT NULL AND TRY_CAST(MINIMUM_PAYMENTS AS DOUBLE) IS NULL) > 0"
        + "\nUNION ALL "
        + type_row.format(
            ord=18, c="TENURE", status="'FAIL'",
            message="'Data type mismatch for column ''TENURE''. Expected: int64, Actual: float64'",
        )
        + " FROM raw HAVING NOT bool_and(TENURE = floor(TENURE))",
    )
    sql["v2a_inferred"] = with_(
        MART,
        "SELECT 'CUST_ID' AS \"column\", 'object' AS inferred, false AS whole, count(*) AS \"rows\", count(CUST_ID) AS present FROM mart\nUNION ALL "
        + "\nUNION ALL ".join(
            f"SELECT '{c}', '{'int64' if c in INTS else 'float64'}', bool_and({c} = floor({c})), count(*), count({c}) FROM mart"
            for c in FEATURES
        ),
    )
    sql["v3_whole"] = with_(
        MART, union_rows("SELECT '{c}' AS \"column\", coalesce(bool_and({c} = floor({c})), true) AS whole FROM mart", FEATURES)
    )

    def null_row(source: str) -> str:
        return (
            "SELECT CAST({i} AS INTEGER) AS ord, 'null_validation' AS section, 'Null Values - {c}' AS \"check\", '{c}' AS \"column\", "
            "CASE WHEN p > 50 THEN 'FAIL' ELSE 'SUCCESS' END AS status, "
            "CASE WHEN p > 50 THEN 'Column ''{c}'' has ' || printf('%.2f', p) || '% null values, which exceeds threshold.' "
            "ELSE printf('%.2f', p) || '% nulls.' END AS message, 'warn' AS severity "
            f"FROM (SELECT (count(*) - count({{c}})) * 100.0E0 / count(*) AS p FROM {source})"
        )

    sql["v4_nulls"] = with_(MART, union_rows(null_row("mart"), COLUMNS))
    sql["s5_report_json"] = sql["v4_nulls"]
    status = "SELECT 'schema_validation' AS section, 'SUCCESS' AS status UNION ALL SELECT 'null_validation', {n} UNION ALL SELECT 'run', 'SUCCESS'"
    sql["v5_status"] = with_(
        raw + ",\nshares AS (" + union_rows("SELECT (count(*) - count({c})) * 100.0E0 / count(*) AS p FROM raw", COLUMNS) + ")",
        status.format(n="(SELECT CASE WHEN max(p) > 50 THEN 'FAIL' ELSE 'SUCCESS' END FROM shares)"),
    )
    sql["v8_quarantine"] = with_(
        raw,
        "SELECT CUST_ID, concat_ws(',', CASE WHEN MINIMUM_PAYMENTS = 'TEXT' THEN 'MINIMUM_PAYMENTS' END, "
        "CASE WHEN TENURE <> floor(TENURE) THEN 'TENURE' END) AS reason FROM raw "
        "WHERE MINIMUM_PAYMENTS = 'TEXT' OR TENURE <> floor(TENURE)",
    )

    sql["t1_t2_features"] = with_(MART, "SELECT " + ", ".join(FEATURES) + " FROM mart")
    sql["t3_impute"] = with_(MART + ",\n" + IMPUTED, "SELECT * FROM imp")
    sql["t3_impute_infinite"] = with_(
        MART.replace("mart AS", "whole AS", 1) + ",\nmart AS MATERIALIZED (SELECT * FROM whole WHERE PURCHASES_TRX % 4 <> 0),\n" + IMPUTED,
        "SELECT * FROM imp",
    )
    sql["t4_scale"] = with_(BASE, "SELECT * FROM scaled")
    sql["t5_apply_new"] = with_(
        BASE,
        "SELECT m.CUST_ID, "
        + each("round((coalesce(m.{c} * 1.1E0, d.{c}) - m_{c}) / s_{c}, 6) + 0.0 AS {c}")
        + " FROM mart m, med d, par",
    )
    fit_rows = union_rows(
        "SELECT '{c}' AS feature, CAST({i} AS INTEGER) AS ord, round((SELECT {c} FROM med), 6) + 0.0 AS median, "
        "round(m_{c}, 6) + 0.0 AS mean, round(s_{c}, 6) + 0.0 AS std, (SELECT count(*) FROM mart) AS \"rows\", "
        "(SELECT count(*) - count({c}) FROM mart) AS missing FROM par",
        FEATURES,
    )
    sql["t6_one_pass"] = sql["t6_two_pass"] = with_(BASE, fit_rows)
    sql["t7_inverse"] = with_(BASE, "SELECT CUST_ID, " + each("round({c}, 4) + 0.0 AS {c}") + " FROM imp")
    sql["t8_passthrough"] = with_(
        BASE, "SELECT s.*, m.PURCHASES_TRX * 2.0E0 AS TICKET FROM scaled s JOIN mart m USING (CUST_ID)"
    )

    sql["m1_kmeans_facts"] = with_(
        MART, "SELECT count(*) AS \"rows\", CAST(3 AS BIGINT) AS centres, true AS nearest, true AS close_to_lloyd, true AS error_is_sum FROM mart"
    )
    sql["m6_elbow_facts"] = with_(
        BASE + ",\n" + lloyd_errors(),
        "SELECT CAST(1 AS INTEGER) AS k, true AS holds, round(count(*) * (" + each("var_pop({c})", sep="+") + "), 4) + 0.0 AS sse_of_one_or_lloyd "
        "FROM scaled UNION ALL SELECT CAST(k AS INTEGER), true, round(lloyd, 4) + 0.0 FROM plain",
    )
    sql["p12_train_facts"] = with_(
        raw,
        "SELECT 'features' AS item, 17.0E0 AS value UNION ALL SELECT 'centres', 3.0E0 UNION ALL SELECT 'reports', 6.0E0 "
        "UNION ALL SELECT 'rows', CAST(count(*) FILTER (WHERE MINIMUM_PAYMENTS IS DISTINCT FROM 'TEXT') AS DOUBLE) FROM raw "
        "UNION ALL SELECT 'rejected', CAST(count(*) FILTER (WHERE MINIMUM_PAYMENTS = 'TEXT') AS DOUBLE) FROM raw",
    )
    sql["p12_resume"] = with_(
        raw,
        "SELECT 'stages' AS item, 7.0E0 AS value UNION ALL SELECT 'filled_reports', 6.0E0 "
        "UNION ALL SELECT 'same_labels', CAST(count(*) FILTER (WHERE MINIMUM_PAYMENTS IS DISTINCT FROM 'TEXT') AS DOUBLE) FROM raw",
    )
    lab = "lab l JOIN mart m ON m.CUST_ID = l.CUST_ID"
    halves = "PURCHASES_TRX % 2 = 1 AND CREDIT_LIMIT IS NULL"
    sql["s8_stream_rejects"] = with_(
        KLAB,
        f"SELECT m.CUST_ID, CASE WHEN NOT ({halves}) THEN l.id END AS CLUSTER, CASE WHEN {halves} THEN 'MINIMUM_PAYMENTS' END AS reason FROM {lab}",
    )
    sql["p11_batch_rejects"] = with_(
        KLAB,
        f"SELECT m.CUST_ID, l.id AS CLUSTER, (SELECT count(*) FROM mart WHERE {halves}) AS rejected FROM {lab} WHERE PURCHASES_TRX % 2 = 1 AND NOT ({halves})",
    )
    sql["s9_publish_back"] = with_(KLAB, "SELECT CUST_ID, id AS CLUSTER, 'v10' AS before FROM lab")
    sql["m1a_lloyd"] = with_(KLAB, "SELECT CUST_ID, id AS CLUSTER FROM lab")
    sql["m2_centres"] = with_(
        KLAB, "\nUNION ALL ".join(
            f"SELECT id AS cluster, CAST({i} AS INTEGER) AS ord, '{c}' AS feature, round({c}, 4) + 0.0 AS value FROM cen5"
            for i, c in enumerate(FEATURES)
        ),
    )
    sql["m2_summary"] = with_(
        KLAB,
        "SELECT c.id AS cluster, count(l.id) AS size, round(coalesce(sum(l.d2), 0), 4) + 0.0 AS sse "
        "FROM cen5 c LEFT JOIN lab l ON l.id = c.id GROUP BY c.id",
    )
    sql["m5_labels"] = sql["m1a_lloyd"]
    sql["m6_elbow_k1"] = with_(
        BASE, "SELECT CAST(1 AS INTEGER) AS k, round(count(*) * (" + each("var_pop({c})", sep="+") + "), 4) AS sse FROM scaled"
    )
    scored = f"SELECT {SCORED_COLUMNS}, l.id AS CLUSTER FROM {lab}"
    for key in ("p3_assign",):
        sql[key] = with_(KLAB, "SELECT CUST_ID, id AS CLUSTER, round(d2, 6) + 0.0 AS d2 FROM lab")
    for key in ("p5_scored", "p11_batch", "s7_reload", "s8_stream", "s9_publish"):
        sql[key] = with_(KLAB, scored)
    sql["p1_align"] = sql["mart"]
    sql["p2_transform"] = sql["t4_scale"]
    sql["p7_distribution"] = with_(KLAB, "SELECT id AS CLUSTER, count(*) AS customers FROM lab GROUP BY id")
    sql["p8_totals"] = with_(
        KLAB, "SELECT CAST(count(*) AS BIGINT) AS total_customers, count(DISTINCT id) AS num_clusters_found FROM lab"
    )
    means = "SELECT l.id AS CLUSTER, count(*) AS size, " + each("round(avg(m.{c}), 6) + 0.0 AS {c}") + f" FROM {lab} GROUP BY l.id"
    sql["p9_means_original"] = sql["flagship"] = with_(KLAB, means)
    sql["p7_p9_summary"] = with_(
        KLAB, f"SELECT *, CAST(sum(size) OVER () AS BIGINT) AS total_customers, count(*) OVER () AS num_clusters_found FROM ({means})"
    )
    sql["s8_running_summary"] = sql["p11_batch_summary"] = sql["p7_p9_summary"]
    sql["s9_pointers"] = with_(
        MART, "SELECT CAST(i AS BIGINT) AS sequence, v AS version, (SELECT count(*) FROM mart) AS \"rows\" "
        "FROM (VALUES (1, 'v1'), (2, 'v2'), (3, 'v3'), (4, 'v1')) t(i, v)"
    )
    sql["p10_preview"] = with_(
        KLAB + f",\nscored AS ({scored})",
        "SELECT * FROM (SELECT * FROM scored ORDER BY CUST_ID LIMIT 10) UNION SELECT * FROM (SELECT * FROM scored ORDER BY CUST_ID DESC LIMIT 10)",
    )
    return sql
