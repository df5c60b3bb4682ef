"""Judging a clustering: silhouette, Davies-Bouldin and the report around them."""

from __future__ import annotations

import math

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorts.functions import kernels
from cohorts.functions.columns import col, ident, squared_distance
from cohorts.functions.skew import hot_keys, lookup
from cohorts.operators.blocks import BROADCAST_CELLS as TILE_CELLS
from cohorts.operators.blocks import HELD_CELLS, arrow_rows, with_blocks
from cohorts.operators.kmeans import vectors
from cohorts.schema import LABEL, NOISE
from cohorts.session import materialize, materialize_with

BLOCK_ROWS = 4096
MIN_BLOCK_ROWS = 64
# Bytes of one Arrow batch of tiles. A tile's blocks hold at most BLOCK_ROWS rows a side, so wide rows come one tile a batch.
BATCH_BYTES = 8 << 20
# Tasks a core takes one after the other; with a task for each tile, starting them takes longer than the work.
TASKS_PER_CORE = 16
BROADCAST_CELLS = 1_000_000
UNDEFINED = ("minus_one", "nan", "omit")


def label_counts(labelled: DataFrame, label: str = LABEL) -> dict[str, int]:
    """Rows, distinct labels, distinct labels without noise, and noise rows, from one aggregate."""
    per_label = labelled.groupBy(col(label).alias("_l")).agg(F.count(F.lit(1)).alias("n"))
    row = per_label.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("_l").alias("labels"),
        F.count_if(F.col("_l") != NOISE).alias("clusters"),
        F.coalesce(F.sum(F.when(F.col("_l") == NOISE, F.col("n"))), F.lit(0)).alias("noise"),
    ).first()
    return row.asDict()


def _blocks(df: DataFrame, order: list[str], features: list[str], keep: dict[str, str], block_rows: int, name: str):
    """Rows of ``df`` cut into blocks numbered 0, 1, 2, ..., and how many there are.

    ``order`` must spread rows finely, so that no value of it fills a partition.
    Driver work is one number per partition.
    """
    mid = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumns({"_part": F.shiftright(mid, 33), "_row": mid.bitwiseAND((1 << 33) - 1)})
    cells = F.expr(f"array({', '.join(ident(f) for f in features)}) as x")
    packed = (
        placed.withColumn("_cut", F.floor(F.col("_row") / F.lit(block_rows)))
        .groupBy("_part", "_cut")
        .agg(F.collect_list(F.struct(cells, *keep)).alias("r"))
        .select("_part", "_cut", F.flatten("r.x").alias("xs"), *[F.col(f"r.{c}").cast(f"array<{t}>").alias(c) for c, t in keep.items()])
    )
    packed = materialize(packed, name)
    sizes = packed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["_part"], total))
        total += r["n"]
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint"))
    numbered = packed.join(starts, "_part").withColumn("block", F.col("_start") + F.col("_cut")).drop("_part", "_cut", "_start")
    return numbered, total


def _tiles(blocks: DataFrame, count: int, cells: int, left: list[str], right: list[str]) -> DataFrame:
    """Every unordered pair of blocks once, with the named columns of both sides: joins on block numbers."""
    last = F.lit(count - 1).cast("bigint")
    pairs = blocks.select(F.col("block").alias("a"), F.explode(F.sequence(F.col("block"), last)).alias("b"))
    parts = min(count * (count + 1) // 2, TASKS_PER_CORE * blocks.sparkSession.sparkContext.defaultParallelism)
    pairs = pairs.repartition(max(1, parts), "a", "b")
    return with_blocks(pairs, blocks.selectExpr("block as a", *left), blocks.selectExpr("block as b", *right), cells)


def _met(
    blocks: DataFrame, count: int, cells: int, columns: dict[str, str], kernel, schema: str, tile_cells: int = TILE_CELLS
) -> DataFrame:
    """What ``kernel`` finds in every unordered pair of blocks; it gets each of ``columns`` of both sides, named by prefix and side.

    ``cells`` is the number of values in all blocks. Within ``tile_cells`` they go to every task. Beyond, neighbouring blocks
    form groups, and a task takes two groups: it holds the blocks of one while those of the other pass by. A block is sent once
    for each group and once more, so what is shuffled grows with the rows as long as tasks can hold their group.
    """
    if cells <= tile_cells:
        left, right = ([f"{c} as {name}{side}" for name, c in columns.items()] for side in "ab")
        return _tiles(blocks, count, cells, left, right).mapInPandas(kernel, schema)
    wanted = math.ceil(math.sqrt(TASKS_PER_CORE * blocks.sparkSession.sparkContext.defaultParallelism))
    groups = min(count, max(wanted, math.ceil(cells / HELD_CELLS)))
    held = f"transform(sequence(g, {groups - 1}L), h -> struct(g * {groups} + h as tile, 0 as side))"
    passing = f"transform(sequence(0L, g), h -> struct(h * {groups} + g as tile, 1 as side))"
    sent = blocks.withColumn("g", F.expr(f"block * {groups} div {count}"))
    sent = sent.selectExpr(f"inline(concat({held}, {passing}))", "block", *[f"{c} as {name}" for name, c in columns.items()])
    # More partitions than tiles, so that few share one.
    sent = sent.repartition(2 * groups * (groups + 1), "tile").sortWithinPartitions("tile", "side", "block")
    return sent.mapInPandas(kernels.held_blocks(kernel, list(columns)), schema)


def silhouette_samples(
    labelled: DataFrame, features: list[str], label: str = LABEL, block_rows: int | None = None, tile_cells: int = TILE_CELLS
) -> DataFrame | None:
    """Rows ``(label, w, s)``: exact Euclidean silhouette of every distinct row, with its number of copies.

    The value needs the distance of every row to every other. Rows are packed in
    blocks; a task takes one pair of blocks at a time and gives back only sums
    per row and label, so neither pairs of rows nor whole clusters are ever
    gathered. Equal rows are folded first and counted by weight. None with fewer
    than two labels. Beyond ``tile_cells`` values blocks are sent by groups, with the same result.
    """
    spark, p = labelled.sparkSession, len(features)
    folded = labelled.groupBy(*map(ident, features), col(label).cast("int").alias("_label")).agg(
        F.count(F.lit(1)).alias("w")
    )
    spread = F.expr(f"xxhash64({', '.join(ident(f) for f in features)}) as _spread")
    folded, facts = materialize_with(
        folded.select("*", spread), "folded", n="count(1)", low="min(_label)", high="max(_label)"
    )
    if facts["low"] == facts["high"]:
        return None
    if block_rows is None:
        per_side = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))
        block_rows = min(BLOCK_ROWS, max(MIN_BLOCK_ROWS, math.ceil(facts["n"] / per_side)))
    # Label first, so that a block holds few labels; the hash spreads a label that owns most rows.
    blocks, count = _blocks(
        folded, ["_label", "_spread"], features, {"_label": "int", "w": "bigint"}, block_rows, "blocks"
    )
    sums = _met(
        blocks, count, facts["n"] * p, {"x": "xs", "l": "_label", "w": "w"},
        kernels.distance_sums(p), "block bigint, other int, size bigint, sums array<double>", tile_cells,
    )
    per_row = (
        sums.select("block", "other", "size", F.posexplode("sums").alias("pos", "d"))
        .groupBy("block", "pos", "other")
        .agg(F.sum("d").alias("d"), F.sum("size").alias("size"))
    )
    rows = blocks.select("block", F.posexplode(F.arrays_zip("_label", "w")).alias("pos", "r")).select(
        "block", "pos", F.col("r._label").alias("label"), F.col("r.w").alias("w")
    )
    own = F.col("other") == F.col("label")
    near = (
        per_row.join(rows, ["block", "pos"])
        .groupBy("block", "pos", "label", "w")
        .agg(
            F.max(F.when(own, F.col("d"))).alias("own_d"),
            F.max(F.when(own, F.col("size"))).alias("own_n"),
            F.min(F.when(~own, F.col("d") / F.col("size"))).alias("b"),
        )
    )
    a = F.col("own_d") / F.nullif(F.col("own_n") - 1, F.lit(0).cast("bigint"))
    score = F.when(
        (F.col("own_n") > 1) & (F.greatest(a, F.col("b")) > 0), (F.col("b") - a) / F.greatest(a, F.col("b"))
    ).otherwise(F.lit(0.0))
    with arrow_rows(spark, max(1, BATCH_BYTES // (16 * (p + 2) * block_rows))):
        return materialize(near.select("label", "w", score.alias("s")), "silhouette")


def silhouette(
    labelled: DataFrame, features: list[str], label: str = LABEL, block_rows: int | None = None, tile_cells: int = TILE_CELLS
) -> float:
    """Mean Euclidean silhouette over all rows; -1.0 with fewer than two labels."""
    samples = silhouette_samples(labelled, features, label, block_rows, tile_cells)
    if samples is None:
        return -1.0
    return samples.agg((F.sum(F.col("s") * F.col("w")) / F.sum("w")).alias("s")).first()["s"]


def silhouette_sq(labelled: DataFrame, features: list[str], label: str = LABEL) -> float:
    """The squared-distance variant: another number, but linear in the rows."""
    frame = vectors(labelled, features, label).withColumn(label, F.col(label).cast("double"))
    return ClusteringEvaluator(predictionCol=label, featuresCol="features").evaluate(frame)


def davies_bouldin(labelled: DataFrame, features: list[str], label: str = LABEL) -> float:
    """Mean over clusters of the worst ratio of spread to centre distance; -1.0 with fewer than two labels.

    Clusters are compared block by block like rows in the silhouette, so many
    thousands of clusters need no join of all with all.
    """
    spark, p = labelled.sparkSession, len(features)
    names = [f"m{i}" for i in range(p)]
    rows = labelled.selectExpr(f"{ident(label)} as _l", *[f"{ident(f)} as f{i}" for i, f in enumerate(features)])
    means = [F.expr(f"avg(f{i}) as m{i}") for i in range(p)]
    centroids, facts = materialize_with(rows.groupBy("_l").agg(*means), "centroids", k="count(1)")
    if facts["k"] < 2:
        return -1.0
    own = F.expr(f"avg(sqrt({squared_distance([f'f{i}' for i in range(p)], names)})) as s")
    if facts["k"] * p <= BROADCAST_CELLS:
        placed = rows.join(F.broadcast(centroids), "_l")
    else:
        placed = lookup(rows, centroids, "_l", "inner", hot_keys(rows, "_l", rows.count()))
    spread = placed.groupBy("_l").agg(own).join(centroids, "_l")
    blocks, count = _blocks(spread, ["_l"], names, {"s": "double"}, BLOCK_ROWS, "spreads")
    worst = _met(blocks, count, facts["k"] * p, {"x": "xs", "s": "s"}, kernels.spread_ratios(p), "block bigint, worst array<double>")
    per_cluster = (
        worst.select("block", F.posexplode("worst").alias("pos", "r")).groupBy("block", "pos").agg(F.max("r").alias("r"))
    )
    with arrow_rows(spark, max(1, (64 << 20) // (16 * (p + 1) * BLOCK_ROWS))):
        return per_cluster.agg(F.avg("r").alias("r")).first()["r"]


SILHOUETTES = {"exact": silhouette, "squared": silhouette_sq}
METRICS_SCHEMA = "model string, ord int, metric string, value double"


def evaluate_model(
    labelled: DataFrame,
    features: list[str],
    name: str,
    density: bool = False,
    label: str = LABEL,
    on_undefined: str = "nan",
    variant: str = "exact",
) -> DataFrame:
    """Rows ``(model, ord, metric, value)``.

    ``variant`` names the silhouette: ``exact`` is the Euclidean one, quadratic in distinct rows; ``squared``
    takes squared distances, another number, and is linear. It is the caller's choice, whatever the size.

    With ``density`` noise rows are left out of both scores and counted. With
    fewer than two clusters the scores are -1.0, NULL or left out, as
    ``on_undefined`` says (``minus_one``, ``nan``, ``omit``).
    """
    if on_undefined not in UNDEFINED:
        raise ValueError(f"on_undefined must be one of {', '.join(UNDEFINED)}")
    if variant not in SILHOUETTES:
        raise ValueError(f"variant must be one of {', '.join(SILHOUETTES)}")
    counts = label_counts(labelled, label)
    rows = []
    if counts["clusters"] >= 2:
        judged = labelled.where(col(label) != NOISE) if density else labelled
        rows.append((name, 0, "silhouette_score", SILHOUETTES[variant](judged, features, label)))
        rows.append((name, 1, "davies_bouldin_score", davies_bouldin(judged, features, label)))
    elif on_undefined != "omit":
        value = -1.0 if on_undefined == "minus_one" else None
        rows += [(name, 0, "silhouette_score", value), (name, 1, "davies_bouldin_score", value)]
    rows.append((name, 2, "num_clusters_found", float(counts["clusters"])))
    if density:
        rows.append((name, 3, "noise_points_found", float(counts["noise"])))
    return labelled.sparkSession.createDataFrame(rows, METRICS_SCHEMA)


def clustering_metrics(labelled: DataFrame, features: list[str], name: str, label: str = LABEL) -> DataFrame:
    """Library variant: noise is left out wherever it occurs, and nothing is reported below two clusters."""
    counts = label_counts(labelled, label)
    if counts["clusters"] < 2:
        return labelled.sparkSession.createDataFrame([], METRICS_SCHEMA)
    judged = labelled.where(col(label) != NOISE)
    rows = [
        (name, 0, "silhouette_score", silhouette(judged, features, label)),
        (name, 1, "davies_bouldin_score", davies_bouldin(judged, features, label)),
        (name, 2, "num_clusters", float(counts["clusters"])),
        (name, 3, "noise_points", float(counts["noise"])),
    ]
    return labelled.sparkSession.createDataFrame(rows, METRICS_SCHEMA)


def metrics_report(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
