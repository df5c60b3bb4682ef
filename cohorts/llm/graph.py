"""Connected components with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorts.session import materialize_with

MAX_ROUNDS = 100


def components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Rows ``(vertex, root)`` for every vertex with an edge; ``root`` is the lowest vertex of its component.

    ``edges`` has bigint columns ``u`` and ``v``. In each round every vertex learns the
    lowest vertex among its neighbours, neighbours above it move to that vertex, and paths
    are halved; the number of rounds grows with the logarithm of the longest path. A round
    is two aggregates, combined on the map side, and two joins whose large side Spark can split
    when a star's centre is hot. Rounds are written to the shared folder, so no
    lineage grows. Self-loops and repeated edges are allowed; null ends are ignored.
    """
    state = edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
    state, mark = _written(state)
    for _ in range(max_rounds):
        if mark["n"] == 0:
            break
        # every vertex hangs on its lowest neighbour, and so do its other lower neighbours
        low = state.groupBy("a").agg(F.min("b").alias("m"))
        met = state.join(low, "a")
        hung = met.select("a", F.col("m").alias("b")).union(met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        hung, _ = _written(hung.distinct())
        # one step up: a vertex whose parent hangs elsewhere moves there
        parent = hung.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), "m")
        moved = hung.join(parent, "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        before = mark
        state, mark = _written(moved)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = state.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    centres = state.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return stars.union(centres)


def _written(state: DataFrame) -> tuple[DataFrame, dict]:
    return materialize_with(state, "edges", n="count(1)", x="bit_xor(xxhash64(a, b))")
