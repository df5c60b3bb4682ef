"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorts.functions import kernels
from cohorts.functions.skew import SAFE_ROWS, hot_keys, lookup
from cohorts.session import materialize, materialize_with


# Edges that one task resolves in memory; larger graphs go through rounds until they are this small.
FINISH_EDGES = 200_000


def _write(edges: DataFrame) -> tuple[DataFrame, tuple]:
    written, facts = materialize_with(edges, "edges", n="count(1)", x="bit_xor(xxhash64(a, b))")
    return written, (facts["n"], facts["x"])


def connected_components(
    edges: DataFrame, max_rounds: int = 100, safe_rows: int = SAFE_ROWS, finish_edges: int = FINISH_EDGES
) -> DataFrame:
    """Rows ``(vertex, root)`` for every vertex that is not its component's lowest one.

    ``edges`` has bigint columns ``u`` and ``v``. Each round links larger
    neighbours to the lowest neighbour, then smaller ones, until only stars are
    left; the number of rounds grows with the logarithm of the graph. Every round
    is written to shared storage, and the centre of a large star is joined by
    broadcast instead of sending its edges to one task. A graph of no more than
    ``finish_edges`` edges is resolved by one task.
    """
    state = edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
    state, mark = _write(state)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        if mark[0] <= finish_edges:
            stars = state.coalesce(1).mapInPandas(kernels.star_forest(), "a bigint, b bigint")
            state = materialize(stars, "edges")
            break
        lowest = state.groupBy("a").agg(F.min("b").alias("m"))
        lifted = lookup(
            state, lowest.select(F.col("a").alias("b"), "m"), "b", hot=hot_keys(state, "b", mark[0], safe_rows)
        ).select("a", F.coalesce("m", "b").alias("b")).distinct()
        if mark[0] > safe_rows:
            lifted = materialize(lifted, "edges")
        lowest = lifted.groupBy("a").agg(F.min("b").alias("m"))
        joined = lookup(lifted, lowest, "a", "inner", hot_keys(lifted, "a", mark[0], safe_rows))
        is_lowest = F.col("b") == F.col("m")
        following = joined.select(
            F.when(is_lowest, F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        ).distinct()
        before = mark
        state, mark = _write(following)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return state.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
