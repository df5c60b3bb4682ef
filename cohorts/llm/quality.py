"""Quality rules: fixed limits on text statistics, then robust multivariate outliers per language and source."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorts.functions.columns import col, number
from cohorts.llm.tables import table
from cohorts.session import materialize, materialize_with

BLANKS, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
STATS_TYPE = T.StructType([T.StructField(s, T.LongType()) for s in STATS])

# Transformed statistics. SPREAD is the least spread (standard deviation) while a pool's core is looked for, wide enough
# that shares which are zero in most texts don't make all others outliers; FLOOR is that of the estimate itself.
VECTOR = ["log_words", "log_word_length", "symbols", "dup_lines", "repeats"]
SPREAD = [1.0, 0.15, 0.05, 0.15, 0.15]
FLOOR = [0.2, 0.02, 0.02, 0.02, 0.02]
P = len(VECTOR)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]

# A group needs so many documents for estimates of its own.
MIN_GROUP = 100
# Share of a group that the determinant is minimised over.
COVERAGE = 0.75
# Quantiles of the chi-square distribution with five degrees of freedom: 0.75, 0.975 and 1 - 1e-6.
CHI_COVERAGE, CHI_REWEIGHT, CHI_CUTOFF = 6.6257, 12.8325, 35.8882
# COVERAGE / P(chi-square with seven degrees of freedom <= CHI_COVERAGE), and 0.975 / P(... <= CHI_REWEIGHT).
CONSISTENCY, CONSISTENCY_REWEIGHT = 0.75 / 0.531137, 0.975 / 0.923704
MAX_STEPS, SETTLED = 12, 1e-3
# Steps of squared distance in which a subset's border is found: 1/16 of a doubling.
BIN = 16
# On distances with a chi-square distribution of five degrees of freedom, upper quartile * (ratio of quartiles) ** FENCE is
# CHI_CUTOFF. A ratio above that of one degree of freedom comes from copies, not from texts.
FENCE, MOST_RATIO, FENCE_BIN = 1.8625, 13.04, 64
# Estimates of up to so many groups (under 400 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_GROUPS = 20_000


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur more than once in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.uint64, count=len(words))
    if len(known) == len(words):
        return 0
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    digest = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        digest = digest * np.uint64(0x100000001B3) + mixed[k : k + n]
    if np.unique(digest).size == n:
        return 0  # different digests mean different windows
    name = ids.astype(np.int64)
    size = 1
    while size < window:  # exact names of windows of twice the length, from pairs of names
        m = len(name) - size
        _, name = np.unique(name[:m] * np.int64(len(words) + 1) + name[size:], return_inverse=True)
        size *= 2
    found = np.bincount(name)[name] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(found)
    edge[starts] += 1
    np.subtract.at(edge, starts + window, 1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def text_stats(raw: bytes) -> tuple[int, ...]:
    words = raw.split()
    points = len(raw.decode("utf-8", "replace"))
    blanks = len(raw) - len(raw.translate(None, BLANKS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return len(words), points - blanks, symbols, len(lines), len(lines) - len(set(lines)), repeat_words(words)


@F.arrow_udf(STATS_TYPE)
def stats_of(texts: pa.Array) -> pa.Array:
    rows = np.zeros((len(texts), len(STATS)), dtype=np.int64)
    for i, text in enumerate(texts):
        raw = text.as_buffer()
        if raw is not None:
            rows[i] = text_stats(raw.to_pybytes())
    return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(STATS))], STATS)


def vector_columns() -> dict[str, Column]:
    share = F.try_divide  # a text without words has no vector
    return {
        "log_words": F.log1p("n_words"),
        "log_word_length": F.log(share("word_chars", "n_words")),
        "symbols": F.sqrt(share("n_symbols", "word_chars")),
        "dup_lines": F.sqrt(share("n_dup_lines", "n_lines")),
        "repeats": F.sqrt(share("n_repeat_words", "n_words")),
    }


def pools(rows: DataFrame, keys: list[str], min_group: int) -> tuple[DataFrame, int]:
    """One row per group of ``keys`` with the pool it belongs to; how many groups there are.

    A group with too few rows joins the small groups of its first key; small pools of that
    kind come together in one.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_level", (F.col("_n") < min_group).cast("int"))
    sizes = materialize(sizes, "sizes")
    first = sizes.where("_level = 1").groupBy(keys[0]).agg(F.sum("_n").alias("_rest"))
    first = first.select(F.col(keys[0]).alias("_kind"), "_rest")
    joined = sizes.join(first, F.col(keys[0]).eqNullSafe(F.col("_kind")), "left")
    level = F.when(F.col("_level") == 0, 0).when(F.col("_rest") >= min_group, 1).otherwise(2)
    named = F.struct(
        level.alias("level"), F.when(level < 2, col(keys[0])).alias("a"), F.when(level < 1, col(keys[1])).alias("b")
    )
    out, facts = materialize_with(joined.select(*keys, F.to_json(named).alias("pool")), "pools", n="count(1)")
    return out, facts["n"]


def with_small(df: DataFrame, small: DataFrame, rows: int, on, how: str, limit: int) -> DataFrame:
    return df.join(F.broadcast(small) if rows <= limit else small, on, how)


def squared_distance() -> Column:
    """Mahalanobis distance of the vector columns from ``centre`` by ``inverse`` (upper triangle), as one expression."""
    terms = []
    for k, (i, j) in enumerate(PAIRS):
        factor = "1" if i == j else "2"
        terms.append(f"{factor} * inverse[{k}] * (`{VECTOR[i]}` - centre[{i}]) * (`{VECTOR[j]}` - centre[{j}])")
    return F.expr(" + ".join(terms))


def _estimate(
    n: float, total: np.ndarray, cross: np.ndarray, factor: float, floor: list[float]
) -> tuple[np.ndarray, np.ndarray, float]:
    """Centre, inverse covariance and log determinant from sums; only spreads below ``floor`` (in any direction) are raised."""
    centre = total / n
    cov = np.zeros((P, P))
    for (i, j), s in zip(PAIRS, cross, strict=True):
        cov[i, j] = cov[j, i] = s / n - centre[i] * centre[j]
    unit = np.outer(floor, floor)
    values, axes = np.linalg.eigh(factor * cov / unit)
    cov = (axes * np.maximum(values, 1.0)) @ axes.T * unit
    return centre, np.linalg.inv(cov), float(np.linalg.slogdet(cov)[1])


MODEL = "pool string, centre array<double>, inverse array<double>, log_det double, n bigint"
SUMS = ["n", *[f"s{i}" for i in range(P)], *[f"x{k}" for k in range(len(PAIRS))]]


def _sums() -> list[Column]:
    out = [F.count(F.lit(1)).alias("n")]
    out += [F.sum(v).alias(f"s{i}") for i, v in enumerate(VECTOR)]
    return out + [F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"x{k}") for k, (i, j) in enumerate(PAIRS)]


def _row(pool: str, n: int, sums: np.ndarray, factor: float, floor: list[float]) -> pd.DataFrame:
    centre, inverse, log_det = _estimate(float(sums[0]), sums[1 : 1 + P], sums[1 + P :], factor, floor)
    upper = [float(inverse[i, j]) for i, j in PAIRS]
    return pd.DataFrame({"pool": [pool], "centre": [centre.tolist()], "inverse": [upper], "log_det": [log_det], "n": [n]})


def concentrate(bins: pd.DataFrame) -> pd.DataFrame:
    """Next estimate of one pool, from its sums per step of distance: the nearest COVERAGE of its rows."""
    bins = bins.sort_values("bin")
    total = int(bins["n"].sum())
    inside = bins["n"].cumsum().shift(fill_value=0) < COVERAGE * total
    return _row(bins["pool"].iloc[0], total, bins.loc[inside, SUMS].sum().to_numpy(dtype=float), CONSISTENCY, SPREAD)


def reweight(bins: pd.DataFrame) -> pd.DataFrame:
    """Final estimate of one pool: all its rows within the 0.975 quantile."""
    total = int(bins["n"].sum())
    inside = bins[bins["bin"] == 0] if (bins["bin"] == 0).any() else bins
    return _row(bins["pool"].iloc[0], total, inside[SUMS].sum().to_numpy(dtype=float), CONSISTENCY_REWEIGHT, FLOOR)


def start(cells: pd.DataFrame) -> pd.DataFrame:
    """First estimate of one pool: medians and quartile ranges, read from counts per cell of each statistic."""
    centre, spread, n = [], [], 0
    for k in range(P):
        own = cells[cells["k"] == k].sort_values("cell")
        upto, n = own["n"].cumsum().to_numpy(), int(own["n"].sum())
        low, mid, high = (own["cell"].to_numpy()[np.searchsorted(upto, q * n)] for q in (0.25, 0.5, 0.75))
        centre.append((mid + 0.5) * SPREAD[k] / 8)
        spread.append(max((high - low) * SPREAD[k] / 8 / 1.349, SPREAD[k]))
    upper = [1 / spread[i] ** 2 if i == j else 0.0 for i, j in PAIRS]
    log_det = float(2 * np.sum(np.log(spread)) + 1e6)  # above any estimate of the iteration
    pool = cells["pool"].iloc[0]
    return pd.DataFrame({"pool": [pool], "centre": [centre], "inverse": [upper], "log_det": [log_det], "n": [n]})


def fit(rows: DataFrame, groups: int, broadcast_groups: int = BROADCAST_GROUPS) -> tuple[DataFrame, int]:
    """Minimum-covariance-determinant estimates per ``pool`` of the vector columns; how many pools there are.

    Every concentration step is one pass: rows are placed in steps of distance, sums per pool
    and step are combined on the map side, and each pool's few hundred sums give its next
    centre and covariance. The border of the subset takes whole steps of 1/16 doubling.
    Spreads below SPREAD are raised to it while the subset is looked for, and those below FLOOR in the final
    estimate, so constant statistics stay usable; all others are the pool's own.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.floor(F.col(v) * (8 / SPREAD[k])).alias("cell")) for k, v in enumerate(VECTOR)
    ])).alias("c")
    counts = rows.select("pool", cells).groupBy("pool", "c.k", "c.cell").agg(F.count(F.lit(1)).alias("n"))
    model, facts = materialize_with(counts.groupBy("pool").applyInPandas(start, MODEL), "model", n="count(1)", d="sum(log_det)")
    n_pools = facts["n"]

    def step(model: DataFrame, bin_of: Column, solve) -> tuple[DataFrame, float]:
        at = with_small(rows, model.select("pool", "centre", "inverse"), n_pools, "pool", "inner", broadcast_groups)
        sums = at.withColumn("d2", squared_distance()).withColumn("bin", bin_of).groupBy("pool", "bin").agg(*_sums())
        out, facts = materialize_with(sums.groupBy("pool").applyInPandas(solve, MODEL), "model", d="sum(log_det)")
        return out, facts["d"] or 0.0

    last = facts["d"] or 0.0
    by_distance = F.floor(F.log2(F.greatest("d2", F.lit(1e-6))) * BIN).cast("int")
    for _ in range(MAX_STEPS):
        model, now = step(model, by_distance, concentrate)
        if last - now <= SETTLED * max(n_pools, 1):
            break
        last = now
    model, _ = step(model, (F.col("d2") > CHI_REWEIGHT).cast("int"), reweight)
    return model, n_pools


def limits(
    rows: DataFrame, model: DataFrame, n_pools: int, min_group: int, broadcast_groups: int = BROADCAST_GROUPS
) -> tuple[DataFrame, int]:
    """``(pool, centre, inverse)``: pools of fewer than ``min_group`` rows have the estimate over all rows."""
    small = model.where(F.col("n") < min_group)
    if not n_pools or small.limit(1).count() == 0:
        return model.select("pool", "centre", "inverse"), n_pools
    whole, _ = fit(rows.withColumn("pool", F.lit("all")), 1, broadcast_groups)
    whole = F.broadcast(whole.where(F.col("n") >= min_group).select("centre", "inverse"))  # one row, or none in a small table
    own = model.where(F.col("n") >= min_group).select("pool", "centre", "inverse")
    out, facts = materialize_with(own.unionByName(small.select("pool").crossJoin(whole)), "model", n="count(1)")
    return out, facts["n"]


def fence(rows: DataFrame, model: DataFrame, n_pools: int, broadcast_groups: int = BROADCAST_GROUPS) -> float:
    """Cutoff from the quartiles of all squared distances, on a log scale; CHI_CUTOFF at least.

    Distances of text statistics are not chi-square: shares are zero in most texts and large in some good ones. The
    quartiles hold as long as outliers are under a quarter of the rows.
    """
    at = with_small(rows, model, n_pools, "pool", "inner", broadcast_groups)
    cell = F.floor(F.log2(F.greatest(squared_distance(), F.lit(1e-6))) * FENCE_BIN).cast("int")
    cells = at.select(cell.alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").collect()
    if not cells:
        return CHI_CUTOFF
    upto = np.cumsum([r["n"] for r in cells])
    low, high = (2 ** ((cells[int(np.searchsorted(upto, q * upto[-1]))]["cell"] + 0.5) / FENCE_BIN) for q in (0.25, 0.75))
    return max(CHI_CUTOFF, high * min(high / low, MOST_RATIO) ** FENCE)


def judge(
    docs: DataFrame,
    text_col: str = "text",
    keys: tuple[str, str] = ("lang", "source"),
    carry: list[str] | None = None,
    min_group: int = MIN_GROUP,
    cutoff: float | None = None,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """Rows of ``docs`` (columns ``carry``, by default all) with text statistics, ``base_failed``, ``distance`` and ``kept``.

    Statistics cover the whole text. A document fails the base rules with fewer than
    MIN_WORDS words, or more than MAX_REPEAT_PERCENT percent of words in repeated windows.
    The others become vectors of five transformed statistics; centre and covariance are
    estimated per language and source from all of them, and a vector beyond ``cutoff`` in squared
    Mahalanobis distance is rejected; without a ``cutoff``, it is taken from the distances of all of them (``fence``).
    Groups under ``min_group`` documents share an estimate with other small
    groups of the language, and where that is too small, with all small groups. A pool of
    fewer than ``min_group`` rows is judged by the estimate over all rows; only a table with fewer judges nobody.

    Null and empty texts have no words and fail. Null languages and sources are groups of
    their own. Ties and equal rows get equal verdicts. Result columns replace input columns of the same name.
    """
    first, second = keys
    stats = docs.withColumn("_s", stats_of(F.coalesce(col(text_col), F.lit(""))))
    names = [c for c in (docs.columns if carry is None else carry) if c not in {*STATS, "base_failed", "distance", "kept"}]
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    stats = stats.select(
        *[col(c) for c in names], col(first).alias("_first"), col(second).alias("_second"), "_s.*"
    ).withColumn("base_failed", failed)
    stats = materialize(stats, "stats")

    fair = stats.where(~F.col("base_failed"))
    groups, n_groups = pools(fair.select("_first", "_second"), ["_first", "_second"], min_group)
    pool = groups.select(F.col("_first").alias("_g1"), F.col("_second").alias("_g2"), "pool")
    on = F.col("_first").eqNullSafe(F.col("_g1")) & F.col("_second").eqNullSafe(F.col("_g2"))
    vectors = with_small(fair.select("_first", "_second", *STATS), pool, n_groups, on, "inner", broadcast_groups)
    vectors = materialize(vectors.select("pool", *[c.alias(v) for v, c in vector_columns().items()]), "vectors")
    model, n_pools = fit(vectors, n_groups, broadcast_groups)
    model, n_pools = limits(vectors, model, n_pools, min_group, broadcast_groups)
    if cutoff is None:
        cutoff = fence(vectors, model, n_pools, broadcast_groups)

    model = model.withColumnRenamed("pool", "_pool")
    by_group, facts = materialize_with(pool.join(model, pool["pool"] == F.col("_pool"), "left").drop("_pool"), "limits", n="count(1)")
    judged = with_small(stats, by_group, facts["n"], on, "left", broadcast_groups)
    judged = judged.withColumns(vector_columns()).withColumn(
        "distance", F.when(~F.col("base_failed"), squared_distance())
    )
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("distance") > F.expr(number(cutoff)), F.lit(False))
    return judged.withColumn("kept", kept).select(*[col(c) for c in names], *STATS, "base_failed", "distance", "kept")


def op1_quality(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "lang", "source", "text")
    out = judge(docs, carry=["doc_id"])
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


QUERIES = {"op1_quality": op1_quality}
SQL: dict[str, str] = {}
