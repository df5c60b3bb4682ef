"""Median filling and population-variance scaling."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from cohorts.functions.columns import double_sql, ident, number
from cohorts.operators.quantiles import DIRECT_ROWS, exact_quantiles
from cohorts.schema import DROP_COLUMNS, FEATURES, KEY, features_of

PARAM_SCHEMA = "feature string, ord int, median double, mean double, std double, rows bigint, missing bigint, method string"


@dataclass(frozen=True)
class FeatureParam:
    feature: str
    ord: int
    median: float
    mean: float
    std: float
    rows: int
    missing: int
    method: str = "exact"


def params_frame(spark: SparkSession, params: list[FeatureParam]) -> DataFrame:
    rows = [(p.feature, p.ord, p.median, p.mean, p.std, p.rows, p.missing, p.method) for p in params]
    return spark.createDataFrame(rows, PARAM_SCHEMA)


def params_from_frame(df: DataFrame) -> list[FeatureParam]:
    """One row per feature, so the collect is bounded by the table's width."""
    return [FeatureParam(**r.asDict()) for r in df.orderBy("ord").collect()]


def as_numbers(df: DataFrame, features: list[str], key: str | None = KEY) -> DataFrame:
    """Key and features as doubles, fractions in whole-number columns kept."""
    keep = [ident(key)] if key else []
    return df.selectExpr(*keep, *[f"{double_sql(df, c)} as {ident(c)}" for c in features_of(df.columns, features)])


def drop_identifiers(df: DataFrame, names: list[str] = DROP_COLUMNS) -> DataFrame:
    return df.drop(*[c for c in names if c in df.columns])


def select_features(df: DataFrame, features: list[str] = FEATURES, key: str | None = None) -> DataFrame:
    """Known features in canonical order, with the key kept in front if asked for."""
    keep = [key] if key else []
    return df.select(*keep, *features_of(df.columns, features))


def fit_preprocessor(
    df: DataFrame, features: list[str] = FEATURES, approx: bool = False, direct_rows: int = DIRECT_ROWS
) -> list[FeatureParam]:
    """Medians, then mean and population deviation of the filled columns.

    The moments of a filled column follow from those of its present values, its
    missing count and its median, so filling needs no pass of its own.
    """
    names = features_of(df.columns, features)
    wanted = ["count(1) as rows"]
    for i, c in enumerate(names):
        value = double_sql(df, c)
        wanted += [f"count({value}) as n{i}", f"avg({value}) as m{i}", f"var_pop({value}) as v{i}", f"count_if(abs({value}) = double('inf')) as w{i}"]
        if approx:
            wanted.append(f"percentile_approx({value}, 0.5D, 100000) as q{i}")
    row = df.selectExpr(*wanted).first()
    rows = row["rows"]
    if rows == 0:
        raise ValueError("cannot fit on an empty frame")
    empty = [c for i, c in enumerate(names) if row[f"n{i}"] == 0]
    if empty:
        raise ValueError(f"columns without any value: {', '.join(empty)}")
    endless = [c for i, c in enumerate(names) if row[f"w{i}"]]
    if endless:
        raise ValueError(f"columns with infinite values: {', '.join(endless)}; split_bad_rows sets such rows aside")
    if approx:
        medians = {c: row[f"q{i}"] for i, c in enumerate(names)}
    else:
        counts = {c: row[f"n{i}"] for i, c in enumerate(names)}
        medians = {c: q[0] for c, q in exact_quantiles(df, names, [0.5], counts, direct_rows).items()}
    params = []
    for i, c in enumerate(names):
        n, mean, var, median = row[f"n{i}"], row[f"m{i}"], row[f"v{i}"], medians[c]
        missing = rows - n
        if var == 0.0:  # one value only, so the median is that value and filling adds no spread
            mean = median
        filled_mean = (n * mean + missing * median) / rows if missing else mean
        spread = (
            (n * (var + (mean - filled_mean) ** 2) + missing * (median - filled_mean) ** 2) / rows if missing else var
        )
        params.append(
            FeatureParam(c, i, median, filled_mean, spread**0.5, rows, missing, "approx" if approx else "exact")
        )
    return params


def passthrough_params(df: DataFrame, columns: list[str], start: int = 0) -> list[FeatureParam]:
    """Parameters of columns that are filled with their median and otherwise left as they are."""
    if not columns:
        return []
    return [
        replace(p, ord=start + i, mean=0.0, std=1.0, method="passthrough") for i, p in enumerate(fit_preprocessor(df, columns))
    ]


def fit_two_pass(df: DataFrame, features: list[str] = FEATURES) -> list[FeatureParam]:
    """Same result by filling first and measuring after; a cross-check of the one-pass fit."""
    names = features_of(df.columns, features)
    first = fit_preprocessor(df, names)
    filled = impute(df, first)
    row = filled.selectExpr(
        *[f"{f}({ident(c)}) as {t}{i}" for i, c in enumerate(names) for t, f in (("m", "avg"), ("s", "stddev_pop"))]
    ).first()
    return [
        FeatureParam(p.feature, p.ord, p.median, row[f"m{i}"], row[f"s{i}"], p.rows, p.missing)
        for i, p in enumerate(first)
    ]


def _replace(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expressions[c]} as {ident(c)}" if c in expressions else ident(c) for c in df.columns])


def impute(df: DataFrame, params: list[FeatureParam]) -> DataFrame:
    return _replace(df, {p.feature: f"coalesce({double_sql(df, p.feature)}, {number(p.median)})" for p in params})


def scale(df: DataFrame, params: list[FeatureParam], places: int | None = None) -> DataFrame:
    """(x - mean) / std; a column without spread is only centred."""

    def one(p: FeatureParam) -> str:
        value = f"({ident(p.feature)} - {number(p.mean)}) / {number(p.std or 1.0)}"
        return f"round({value}, {places}) + 0.0D" if places is not None else value

    return _replace(df, {p.feature: one(p) for p in params})


def apply_preprocessor(
    df: DataFrame,
    params: list[FeatureParam],
    key: str | None = KEY,
    places: int | None = None,
    extra: str = "exclude",
) -> DataFrame:
    """Key and scaled features. ``extra='passthrough'`` keeps other numeric columns as they are."""
    names = [p.feature for p in params]
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks the columns {', '.join(missing)}")
    keep = [key] if key and key in df.columns else []
    others = [c for c in df.columns if c not in names and c not in keep + DROP_COLUMNS] if extra == "passthrough" else []
    return scale(impute(df, params), params, places).select(*keep, *names, *others)


def inverse_scale(df: DataFrame, params: list[FeatureParam]) -> DataFrame:
    """Back to original units; filled cells come back as the median."""
    return _replace(
        df, {p.feature: f"{ident(p.feature)} * {number(p.std or 1.0)} + {number(p.mean)}" for p in params}
    )
