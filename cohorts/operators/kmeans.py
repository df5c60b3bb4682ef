"""KMeans: seeded fit, fit from given centres, assignment, inertia and the elbow curve."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions import kernels, rounds
from cohorts.functions.columns import double_sql, ident, number, rounded, squared_distance
from cohorts.schema import KEY, LABEL
from cohorts.session import materialize, materialize_with

# Candidates for the start centres of the elbow curve, and the passes over all rows in which they are drawn.
SEED_ROWS, SEED_PASSES = 2000, 5
# Rounds that compare all rows before bounds are written, and the share of rows from which bounds are written anew.
WARM_ROUNDS, REFRESH = 2, 0.4
# Rows that one task may take through several rounds, and how many times the last shift their margins must reach for that.
CHAIN_ROWS, REACH = 1 << 16, 8.0
CENTRE_SCHEMA = "cluster int, ord int, feature string, value double"


@dataclass(frozen=True)
class KMeansFit:
    features: list[str]
    centres: list[list[float]]
    inertia: float
    rounds: int

    @property
    def k(self) -> int:
        return len(self.centres)


def centres_frame(spark: SparkSession, features: list[str], centres: list[list[float]]) -> DataFrame:
    rows = [(c, i, f, float(v)) for c, centre in enumerate(centres) for i, (f, v) in enumerate(zip(features, centre))]
    return spark.createDataFrame(rows, CENTRE_SCHEMA)


def centres_from_frame(df: DataFrame) -> tuple[list[str], list[list[float]]]:
    """k x p numbers, the size of the model itself."""
    rows = df.orderBy("cluster", "ord").collect()
    features = [r["feature"] for r in rows if r["cluster"] == rows[0]["cluster"]]
    centres: dict[int, list[float]] = {}
    for r in rows:
        centres.setdefault(r["cluster"], []).append(r["value"])
    return features, [centres[c] for c in sorted(centres)]


def centre_distances(features: list[str], centres: list[list[float]]) -> str:
    """SQL text of the array of squared distances to every centre, in centre order."""
    point = [ident(f) for f in features]
    return f"array({', '.join(squared_distance(point, [number(v) for v in c]) for c in centres)})"


def assign(
    df: DataFrame, features: list[str], centres: list[list[float]], label: str = LABEL, keep_distance: str | None = None
) -> DataFrame:
    """Adds the nearest centre's number; equal distances go to the lowest. No shuffle, no join."""
    out = df.selectExpr("*", f"{centre_distances(features, centres)} as _d")
    out = out.withColumn(label, F.expr("cast(array_position(_d, array_min(_d)) - 1 as int)"))
    if keep_distance:
        out = out.withColumn(keep_distance, F.array_min("_d"))
    return out.drop("_d")


def first_rows_as_centres(df: DataFrame, features: list[str], k: int, key: str = KEY) -> list[list[float]]:
    rows = df.select(key, *features).orderBy(key).limit(k).collect()
    return [[float(r[f]) for f in features] for r in rows]


def lloyd(df: DataFrame, features: list[str], centres: list[list[float]], max_rounds: int, tol: float = 0.0) -> KMeansFit:
    """Lloyd rounds from given centres; a cluster that loses all rows keeps its centre.

    Each round is one job: nearest centre in a projection, then sums combined on
    the map side, so what is shuffled and collected is k rows whatever the data.
    Stops early once the squared shifts add up to at most ``tol`` times the mean variance of the features.
    """
    done, rest = 0, 0.0
    if tol:
        spread = df.selectExpr(*[f"var_pop({ident(f)}) as v{i}" for i, f in enumerate(features)]).first()
        rest = tol * sum(v or 0.0 for v in spread) / len(features)
    for _ in range(max_rounds):
        sums = (
            assign(df.select(*features), features, centres, "_c")
            .groupBy("_c")
            .agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"sum({ident(f)}) as s{i}") for i, f in enumerate(features)])
            .collect()
        )
        moved = [list(c) for c in centres]
        for r in sums:
            moved[r["_c"]] = [r[f"s{i}"] / r["n"] for i in range(len(features))]
        shift = sum((a - b) ** 2 for old, new in zip(centres, moved) for a, b in zip(old, new))
        centres, done = moved, done + 1
        if shift <= rest:
            break
    return KMeansFit(list(features), centres, inertia(df, features, centres), done)


def inertia(df: DataFrame, features: list[str], centres: list[list[float]]) -> float:
    return df.selectExpr(f"sum(array_min({centre_distances(features, centres)})) as sse").first()["sse"] or 0.0


def cluster_summary(df: DataFrame, features: list[str], centres: list[list[float]]) -> DataFrame:
    """Size and within-cluster squared error per centre, also for centres without rows."""
    placed = assign(df.select(*features), features, centres, "_c", "_d2")
    found = placed.groupBy("_c").agg(F.count(F.lit(1)).alias("size"), F.sum("_d2").alias("sse"))
    numbers = df.sparkSession.range(len(centres)).select(F.col("id").cast("int").alias("cluster"))
    return numbers.join(F.broadcast(found), F.col("cluster") == F.col("_c"), "left").select(
        "cluster", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("sse", F.lit(0.0)).alias("sse")
    )


def vectors(df: DataFrame, features: list[str], *keep: str) -> DataFrame:
    cells = F.expr(f"array({', '.join(double_sql(df, f) for f in features)})")
    return df.select(*keep, array_to_vector(cells).alias("features"))


def fit_kmeans(
    df: DataFrame,
    features: list[str],
    k: int = 3,
    seed: int = 42,
    max_iter: int = 300,
    tol: float = 1e-4,
) -> KMeansFit:
    """Seeded fit with the parallel k-means++ start, until the centres settle.

    Coinciding points can leave fewer than ``k`` centres; ``KMeansFit.k`` tells.
    """
    model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, initMode="k-means||").fit(vectors(df, features))
    centres = [[float(v) for v in c] for c in model.clusterCenters()]
    return KMeansFit(list(features), centres, float(model.summary.trainingCost), int(model.summary.numIter))


def pack(df: DataFrame, features: list[str]) -> DataFrame:
    """The rows written once as blocks of some thousand, one binary cell each; rounds read these."""
    points = df.selectExpr(*[f"{double_sql(df, f)} as x{i}" for i, f in enumerate(features)])
    return materialize(points.mapInArrow(rounds.packer(), rounds.BLOCK_DDL), "blocks")


def _sum_columns(p: int) -> str:
    return "k int, cluster int, n bigint, sse double, " + ", ".join(f"s{i} double" for i in range(p))


def _totals(found: DataFrame, centres: dict[int, np.ndarray], p: int) -> tuple[dict[int, np.ndarray], int]:
    """Per k a row (n, sse, sums) for every centre, and the count of rows compared that bounded rounds give."""
    columns = ["n", "sse", *[f"s{i}" for i in range(p)]]
    totals, compared = {k: np.zeros((len(c), 2 + p)) for k, c in centres.items()}, 0
    for r in found.groupBy("k", "cluster").agg(*[F.sum(c).alias(c) for c in columns]).collect():
        if r["k"] < 0:
            compared = r["n"]
        else:
            totals[r["k"]][r["cluster"]] = [r[c] for c in columns]
    return totals, compared


def block_sums(blocks: DataFrame, centres: dict[int, np.ndarray], p: int) -> dict[int, np.ndarray]:
    """Per k, for every centre: its rows, their squared error and sums; one pass for every k."""
    return _totals(blocks.mapInArrow(rounds.summer(centres, p), _sum_columns(p)), centres, p)[0]


def seed_candidates(blocks: DataFrame, p: int, least: int, seed: int, seed_rows: int = SEED_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """About ``seed_rows`` candidates for start centres and the number of rows nearest to each (k-means||).

    A pass draws its share from all rows, with the chance of the squared distance from those drawn before, so a small far
    group has candidates too. Passes go on until there are ``least`` different ones or no row is left that
    differs from all. Candidates then move to the mean of their rows.
    """
    share = max(1, -(-seed_rows // SEED_PASSES))
    columns = "key double, " + ", ".join(f"x{i} double" for i in range(p))
    found, done = np.zeros((0, p)), 0
    while done < SEED_PASSES or len(found) < least:
        drawn = blocks.mapInArrow(rounds.far_drawer(found, share, seed + done, p), columns)
        rows = drawn.orderBy("key", *[f"x{i}" for i in range(p)]).limit(share).collect()
        if not rows:
            break
        found = np.unique(np.vstack([found, np.array([r[1:] for r in rows], dtype=float)]), axis=0)
        done += 1
    if not len(found):
        raise ValueError("no rows to cluster")
    near = block_sums(blocks, {0: found}, p)[0]
    near = near[near[:, 0] > 0]
    return near[:, 2:] / near[:, :1], near[:, 0]


@dataclass
class Settled:
    """Centres by k, whether all came to rest, the passes over all rows, the bounded ones with what they compared, and chains."""

    centres: dict[int, np.ndarray]
    at_rest: bool = True
    full: int = 0
    bounded: int = 0
    compared: list[int] = field(default_factory=list)
    chains: int = 0


@dataclass
class _Bounds:
    """Labels and margins as of some centres: their table, those centres, and the sums of their clusters."""

    table: DataFrame
    ks: list[int]
    centres: dict[int, np.ndarray]
    totals: dict[int, np.ndarray]

    def changed(self, moving: dict[int, np.ndarray], p: int) -> DataFrame:
        limits = {k: rounds.drift_limits(self.centres[k], c) for k, c in moving.items()}
        near = " or ".join(f"low{k} < {number(limit.max())}" for k, limit in limits.items())
        return self.table.where(near).mapInArrow(rounds.mover(self.ks, moving, limits, p), _sum_columns(p))

    def reach(self, chain_rows: int) -> float:
        """A margin under which about half of ``chain_rows`` rows lie; infinite if there are no more."""
        most = max(1, chain_rows // (2 * rounds.STRIDE))
        steps = self.table.select(F.explode("steps").alias("s")).orderBy("s").limit(most + 1).collect()
        return steps[most]["s"] if len(steps) > most else float("inf")

    def open_rows(self, moving: dict[int, np.ndarray], limit: float, p: int) -> tuple[DataFrame, int]:
        near = " or ".join(f"low{k} < {number(limit)}" for k in moving)
        rows = self.table.where(near).mapInArrow(rounds.opener(self.ks, list(moving), limit, p), "n int, x binary, own binary")
        rows, facts = materialize_with(rows, "open", n="coalesce(sum(n), 0)")
        return rows, facts["n"]


def _chained(rows: DataFrame, run, p: int) -> tuple[dict[int, np.ndarray], set[int], int]:
    """Centres after a chain, the k that came to rest, and the longest chain's rounds."""
    columns = "k int, cluster int, at_rest boolean, rounds int, " + ", ".join(f"x{i} double" for i in range(p))
    centres, rested, longest = {}, set(), 0
    for r in rows.coalesce(1).mapInArrow(run, columns).orderBy("k", "cluster").collect():
        centres.setdefault(r["k"], []).append([r[f"x{i}"] for i in range(p)])
        longest = max(longest, r["rounds"])
        if r["at_rest"]:
            rested.add(r["k"])
    return {k: np.array(c) for k, c in centres.items()}, rested, longest


def settle(
    blocks: DataFrame, starts: dict[int, np.ndarray], p: int, rest: float, max_rounds: int = 300, warm: int = WARM_ROUNDS,
    chain_rows: int = CHAIN_ROWS,
) -> Settled:
    """Lloyd rounds for several k at once, until the squared shifts of a k's centres add up to at most ``rest``.

    The first ``warm`` rounds, in which centres move far, compare all rows. Then a table is written that knows every row's
    centre and its margin, the distance by which the next centre is farther. While centres have moved by less than
    that, the row stays and its part of the sums is known. So where at most ``chain_rows`` rows have a margin within reach of
    the next rounds, these rows go to one task, which goes on by itself until all is at rest or the reach is
    used up; a table that is no larger goes there whole. Otherwise a round reads the blocks that hold margins below what the
    centres have moved since, compares those rows alone, and corrects the known sums by rows that changed sides. The table
    is written anew once more than REFRESH of the rows must be compared. All three ways find the same centres. A centre
    that loses all rows stays.
    """
    moving, out, bounds, done = {k: c.copy() for k, c in starts.items()}, Settled({}), None, 0

    def rest_of(moved: dict[int, np.ndarray], rested: set[int]) -> dict[int, np.ndarray]:
        out.centres.update({k: moved[k] for k in rested})
        return {k: c for k, c in moved.items() if k not in rested}

    while moving and done < max_rounds:
        fresh = False
        if bounds is None:
            totals = block_sums(blocks, moving, p)
            out.full += 1
            if out.full > warm:
                if sum(next(iter(totals.values()))[:, 0]) <= chain_rows:
                    moved, rested, n = _chained(blocks, rounds.chainer(moving, p, rest, max_rounds - done), p)
                    moving, done, out.chains = rest_of(moved, rested), done + n, out.chains + 1
                    continue
                ks = list(moving)
                table = materialize(blocks.mapInArrow(rounds.bounder(moving, p), rounds.bound_ddl(ks)), "bounds")
                bounds, fresh = _Bounds(table, ks, moving, totals), True
        else:
            delta, compared = _totals(bounds.changed(moving, p), moving, p)
            totals = {k: bounds.totals[k] + delta[k] for k in moving}
            out.bounded += 1
            out.compared.append(compared)
            if compared > REFRESH * sum(t[:, 0].sum() for t in totals.values()):
                bounds = None
        moved = {k: rounds.means_of(totals[k], c) for k, c in moving.items()}
        shifts = {k: np.square(c - moving[k]).sum(axis=1) for k, c in moved.items()}
        moving, done = rest_of(moved, {k for k, s in shifts.items() if s.sum() <= rest}), done + 1
        if fresh and moving and chain_rows:
            shift = max(float(np.sqrt(shifts[k].max())) for k in moving)
            reach = bounds.reach(chain_rows)
            rows, n = bounds.open_rows(moving, reach, p) if reach > REACH * shift else (None, 0)
            if rows is not None and n <= chain_rows:
                base = ({k: bounds.centres[k] for k in moving}, {k: bounds.totals[k] for k in moving}, reach)
                moved, rested, n = _chained(rows, rounds.chainer(moving, p, rest, max_rounds - done, base), p)
                moving, done, out.chains = rest_of(moved, rested), done + n, out.chains + 1
                bounds = None
    if moving:
        warnings.warn(f"centres of k = {', '.join(map(str, moving))} still move after {max_rounds} rounds", stacklevel=2)
    out.at_rest = not moving
    out.centres.update(moving)
    return out


def elbow_curve(
    df: DataFrame,
    features: list[str],
    max_k: int = 10,
    seed: int = 42,
    known: dict[int, float] | None = None,
    max_rounds: int = 300,
    tol: float = 1e-4,
    seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """Rows ``(k, sse, centres, knee)``. ``known`` holds errors already measured, by k.

    Start centres come from about ``seed_rows`` candidates that k-means|| draws from all rows, once for every k, and weights
    by their rows; only the candidates are clustered on the driver. Rounds (see :func:`settle`) move the centres of every k
    in the same pass, until the squared shifts of a k add up to at most ``tol`` times the mean variance of the features;
    a k that still moves after ``max_rounds`` gives a warning. At most k * k / 2 rows are shuffled and collected
    in a round. Errors are those of all rows. The knee is the point farthest from the straight line between both ends.
    """
    spark, p = df.sparkSession, len(features)
    known = {k: float(v) for k, v in (known or {}).items() if 1 < k <= max_k}
    row = df.selectExpr("count(1) as n", *[f"var_pop({double_sql(df, f)}) as v{i}" for i, f in enumerate(features)]).first()
    variance = sum(row[f"v{i}"] or 0.0 for i in range(p))
    errors = {1: row["n"] * variance, **known}
    counts = {k: k for k in errors}
    wanted = [k for k in range(2, max_k + 1) if k not in errors]
    if wanted:
        blocks = pack(df, features)
        candidates, weight = seed_candidates(blocks, p, max(wanted), seed, seed_rows)
        starts = {k: kernels.seed_centres(candidates, weight, k, seed) for k in wanted}
        centres = settle(blocks, starts, p, tol * variance / p, max_rounds).centres
        for k, total in block_sums(blocks, centres, p).items():
            errors[k], counts[k] = float(total[:, 1].sum()), len(total)
    rows = [(k, errors[k], counts[k]) for k in range(1, max_k + 1)]
    (k0, s0, _), (k1, s1, _) = rows[0], rows[-1]
    off = [abs((s1 - s0) * (k - k0) - (s - s0) * (k1 - k0)) for k, s, _ in rows]
    knee = rows[off.index(max(off))][0]
    return spark.createDataFrame(
        [(k, float(s), c, k == knee) for k, s, c in rows], "k int, sse double, centres int, knee boolean"
    )


def centres_report(spark: SparkSession, fit: KMeansFit, places: int = 4) -> DataFrame:
    return centres_frame(spark, fit.features, fit.centres).withColumn("value", rounded(F.col("value"), places))
