"""Approximate nearest neighbours by a permutation index over pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohorts.functions.columns import col
from cohorts.llm.tables import table
from cohorts.session import materialize

# Pivots, picked far apart from a sample of so many vectors (those with the lowest hash of their id).
PIVOTS, PIVOT_SAMPLE = 128, 2048
# Nearest pivots that a vector is posted under.
POSTED = 64
# Vectors in a block of the index, and queries that go over the index at a time.
BLOCK, QUERY_BATCH, QUERY_SLICE = 4096, 16_384, 256
# Share of a block that is reranked at least, in steps; a step that finds nothing ends it.
LEAST_SHARE, STEP_SHARE, LEAST_ROWS = 0.08, 0.04, 256

INDEX = "ids array<bigint>, vectors binary, first array<int>, places binary, ranks binary"
FOUND = "query_id bigint, vec_id bigint, score double"


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows ``(id, v)`` with a non-null id and a vector of finite, non-null numbers that aren't all zero."""
    v = F.transform(col(vector_col), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    out = df.select(col(id_col).cast("long").alias("id"), v.alias("v"))
    return out.where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, all of one length, as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def choose_pivots(vectors: DataFrame, n_pivots: int, sample: int) -> np.ndarray:
    """Unit vectors of a bounded sample, each chosen as far as possible from those before it."""
    rows = vectors.select("id", "v").orderBy(F.xxhash64("id"), "id", "v").limit(sample).collect()
    if not rows:
        return np.zeros((0, 0))
    x = np.array([r["v"] for r in rows])
    x /= norms(x)[:, None]
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(n_pivots, len(x)):
        following = int(np.argmin(nearest))
        chosen.append(following)
        nearest = np.maximum(nearest, x @ x[following])
    return x[chosen]


def weights(x: np.ndarray, pivots: np.ndarray, posted: int) -> np.ndarray:
    """For every vector and pivot: ``posted`` less the pivot's place in the vector's order of nearest pivots, at least zero."""
    near = np.argsort(-(x / norms(x)[:, None]) @ pivots.T, axis=1, kind="stable")[:, :posted]
    out = np.zeros((len(x), len(pivots)), dtype=np.int16)
    np.put_along_axis(out, near, np.arange(posted, posted - near.shape[1], -1, dtype=np.int16)[None, :], axis=1)
    return out


def _indexer(pivots: Broadcast, posted: int, block: int):
    def pack(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        weight = weights(x, pivots.value, posted)
        pivot, place = np.nonzero(weight.T)  # postings, pivot by pivot
        first = np.searchsorted(pivot, np.arange(len(pivots.value) + 1)).astype(np.int32)
        return pa.RecordBatch.from_pydict(
            {
                "ids": [ids], "vectors": [x.tobytes()], "first": [first],
                "places": [place.astype(np.int32).tobytes()], "ranks": [weight[place, pivot].tobytes()],
            },
            schema=pa.schema([
                ("ids", pa.list_(pa.int64())), ("vectors", pa.binary()), ("first", pa.list_(pa.int32())),
                ("places", pa.binary()), ("ranks", pa.binary()),
            ]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, count = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                ids.append(part.column(0).to_numpy())
                rows.append(matrix(part.column(1)))
                count += part.num_rows
                if count >= block:
                    yield pack(np.concatenate(ids), np.concatenate(rows))
                    ids, rows, count = [], [], 0
        if count:
            yield pack(np.concatenate(ids), np.concatenate(rows))

    return run


class Best:
    """The best ``k`` ids and scores of each query so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.scores = np.full((n, k), -np.inf)

    def offer(self, q: int, ids: np.ndarray, scores: np.ndarray) -> bool:
        better = scores >= self.scores[q, -1]
        if not better.any():
            return False
        ids, scores = np.concatenate((self.ids[q], ids[better])), np.concatenate((self.scores[q], scores[better]))
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        _, first = np.unique(ids, return_index=True)
        fresh = np.zeros(len(ids), dtype=bool)
        fresh[first] = True
        fresh |= ids == np.iinfo(np.int64).max
        k = self.ids.shape[1]
        ids, scores = ids[fresh][:k], scores[fresh][:k]
        changed = not np.array_equal(ids, self.ids[q])
        self.ids[q], self.scores[q] = ids, scores
        return changed


def _searcher(pivots: Broadcast, queries: Broadcast, posted: int, k: int, least: float, step: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q_rows = queries.value
        q_norms, q_weights = norms(q_rows), weights(q_rows, pivots.value, posted)
        best = Best(len(q_ids), k)
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column(0)[r].values.to_numpy()
                x = np.frombuffer(batch.column(1)[r].as_buffer(), dtype=np.float64).reshape(len(ids), -1)
                first = batch.column(2)[r].values.to_numpy()
                places = np.frombuffer(batch.column(3)[r].as_buffer(), dtype=np.int32)
                ranks = np.frombuffer(batch.column(4)[r].as_buffer(), dtype=np.int16)
                x_norms = norms(x)
                for low in range(0, len(q_ids), QUERY_SLICE):
                    part = q_weights[low : low + QUERY_SLICE]
                    # footrule distance falls by twice this sum over the pivots that both are posted under
                    agree = np.zeros((len(part), len(ids)), dtype=np.int16)
                    for p in range(len(first) - 1):
                        asked = np.flatnonzero(part[:, p])
                        listed = slice(first[p], first[p + 1])
                        if len(asked) and first[p] < first[p + 1]:
                            agree[np.ix_(asked, places[listed])] += np.minimum(part[asked, p][:, None], ranks[listed][None, :])
                    for i in range(len(part)):
                        rerank(best, low + i, agree[i], ids, x, x_norms, q_ids, q_rows, q_norms, least, step)
        held = best.scores > -np.inf
        q, _ = np.nonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_ids[q]), pa.array(best.ids[held]), pa.array(best.scores[held])], names=["query_id", "vec_id", "score"]
        )

    return run


def nearest_first(agree: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    """Places of the ``size`` rows that agree most; smaller ids among those that agree alike."""
    n = len(ids)
    if size >= n:
        return np.arange(n)
    border = np.partition(agree, n - size)[n - size]
    sure, ties = np.flatnonzero(agree > border), np.flatnonzero(agree == border)
    rest = size - len(sure)
    if rest < len(ties):
        ties = ties[np.argpartition(ids[ties], rest - 1)[:rest]]
    return np.concatenate((sure, ties))


def rerank(best: Best, q: int, agree, ids, x, x_norms, q_ids, q_rows, q_norms, least: float, step: float) -> None:
    """Exact cosines in the order of footrule distance, then id, until the least share is done and a step finds nothing better."""
    n = len(ids)
    start, size = 0, min(n, max(LEAST_ROWS, int(np.ceil(least * n))))
    step_size = max(LEAST_ROWS // 2, int(np.ceil(step * n)))
    order = nearest_first(agree, ids, size)
    while True:
        mine = order[ids[order] != q_ids[q]]
        scores = (x[mine] * q_rows[q]).sum(axis=1) / (x_norms[mine] * q_norms[q])
        found = best.offer(q, ids[mine], scores)
        if size >= n or (start and not found):
            return
        if not start:
            whole = np.lexsort((ids, -agree))
            seen = np.zeros(n, dtype=bool)
            seen[order] = True
            whole = np.concatenate((order, whole[~seen[whole]]))
        start, size = size, min(n, size + step_size)
        order = whole[start:size]


def build_index(vectors: DataFrame, pivots: np.ndarray, posted: int = POSTED, block: int = BLOCK) -> DataFrame:
    """The written index: blocks of vectors, each with an inverted file of its pivots.

    A posting list holds places in the block and ranks (``posted`` less the place in the vector's order). Every vector is indexed.
    """
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)
    return materialize(vectors.select("id", "v").mapInArrow(_indexer(sent, posted, block), INDEX), "index")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, n_pivots: int = PIVOTS, posted: int = POSTED, sample: int = PIVOT_SAMPLE,
    least: float = LEAST_SHARE, step: float = STEP_SHARE, block: int = BLOCK, query_batch: int = QUERY_BATCH,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every query by cosine, other ids than its own.

    A vector is the order of its ``posted`` nearest pivots; orders are compared by footrule distance through
    the inverted files, and the nearest are reranked by their exact cosine in double precision. A block reranks
    at least a share ``least``, then goes on in steps of ``step`` as long as a step finds a better
    neighbour, to the last row if need be: a large group of near copies is thereby gone through, not cut off.

    Queries meet all rows in blocks: a batch of at most ``query_batch`` queries (their size is the bound of the
    broadcast) goes over the index, tasks keep ``k`` results a query, and those are merged by query. Vectors that are null, zero, or
    hold null or non-finite numbers take no part, nor do those of another length than most. Rows that share an id count as one,
    with their best score. Ties go to the smaller id.
    """
    spark = vectors.sparkSession
    good = materialize(valid_vectors(vectors, id_col, vector_col), "vectors")
    asked = materialize(valid_vectors(queries, id_col, vector_col).dropDuplicates(["id"]), "queries")
    lengths = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not lengths:
        return empty
    good, asked = good.where(F.size("v") == lengths[0]["n"]), asked.where(F.size("v") == lengths[0]["n"])
    pivots = choose_pivots(good, n_pivots, sample)
    posted = min(posted, max(1, len(pivots) // 2))
    index = build_index(good, pivots, posted, block)
    sent = spark.sparkContext.broadcast(pivots)

    n_batches = max(1, -(-asked.count() // query_batch))
    batch_of = F.pmod(F.xxhash64("id"), F.lit(n_batches))
    found = None
    for b in range(n_batches):
        rows = asked.where(batch_of == b).collect()
        if not rows:
            continue
        packed = spark.sparkContext.broadcast(
            (np.array([r["id"] for r in rows], dtype=np.int64), np.array([r["v"] for r in rows], dtype=np.float64))
        )
        part = index.mapInArrow(_searcher(sent, packed, posted, k, least, step), FOUND)
        part = materialize(part, "found")
        found = part if found is None else found.union(part)
    if found is None:
        return empty
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_permutation(spark: SparkSession, base: str) -> DataFrame:
    vectors = table(spark, base, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


QUERIES = {"op6_permutation": op6_permutation}
SQL: dict[str, str] = {}
