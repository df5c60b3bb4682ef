"""Exact density clustering (DBSCAN) over small blocks of rows.

Boxes of some thirty leaves settle most rows by themselves: which are core, and which of these belong together. Only rows
that are left in question meet all others, and a sample of core rows joins most boxes to one cluster beforehand.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorts.functions import kernels
from cohorts.functions.columns import col, ident, number
from cohorts.functions.skew import HOT_SHARE, SAFE_ROWS, hot_keys, lookup, numbered
from cohorts.operators.blocks import (
    BROADCAST_CELLS,
    LEAF_BITS,
    LEAF_ROWS,
    SLACK,
    Splits,
    Tree,
    arrow_rows,
    batch_rows,
    chosen,
    close_pairs,
    meet,
    number_leaves,
    pack,
    plan_splits,
    whole,
)
from cohorts.operators.components import FINISH_EDGES, connected_components
from cohorts.schema import KEY, LABEL, NOISE
from cohorts.session import materialize, materialize_with, own_scratch

LEVEL_BITS = 48
# Core rows, one in some, that look for links between boxes first; a sample of a bounded table is the table.
SAMPLE_ROWS, SAMPLE_SHARE = 20_000, 64


def _distinct_points(df: DataFrame, features: list[str], key: str) -> DataFrame:
    """Equal rows folded to one weighted point named by its lowest key; copies never meet in a task."""
    return df.groupBy(*map(ident, features)).agg(
        F.count(F.lit(1)).alias("w"), F.min(col(key)).alias("vkey")
    )


def _write_points(df: DataFrame, features: list[str], key: str) -> tuple[DataFrame, dict]:
    gaps = " or ".join(f"{ident(f)} is null" for f in features)
    points, facts = materialize_with(
        _distinct_points(df.select(key, *features), features, key),
        "points",
        points="count(1)",
        rows="coalesce(sum(w), 0)",
        heaviest="coalesce(max(w), 0)",
        gaps=f"count_if({gaps})",
    )
    if facts["gaps"]:
        raise ValueError("density clustering needs complete rows: fill missing values first")
    return points, facts


def _unify(tree: Tree, settled: list[tuple[int, DataFrame]]) -> tuple[DataFrame | None, list[DataFrame]]:
    """Leaves whose rows are known to be core rows of one cluster, and the edges saying so.

    Settled boxes hand their state down level by level, thirty-two children at most
    each, so a box that covers most leaves burdens no task.
    """
    if not settled:
        return None, []
    by_level = dict(settled)

    def vertex(level: int, node):
        return node + F.lit(level << LEVEL_BITS) if level else F.shiftleft(node, LEAF_BITS)

    edges, above, above_level = [], None, None
    for level in range(max(by_level), -1, -1):
        parts = []
        if level in by_level:
            pairs = by_level[level]
            parts += [pairs.select(F.col("a").alias("node")), pairs.select(F.col("b").alias("node"))]
            edges.append(pairs.where("a <> b").select(vertex(level, F.col("a")).alias("u"), vertex(level, F.col("b")).alias("v")))
        if above is not None:
            up = tree.shifts[above_level] - tree.shifts[level]
            children = tree.leaves.select(F.shiftright("leaf", tree.shifts[level]).alias("node")).distinct()
            children = children.withColumn("parent", F.shiftright("node", up))
            inherited = children.join(above.select(F.col("node").alias("parent")), "parent")
            edges.append(
                inherited.select(vertex(level, F.col("node")).alias("u"), vertex(above_level, F.col("parent")).alias("v"))
            )
            parts.append(inherited.select("node"))
        if parts:
            above = materialize(reduce(DataFrame.union, parts).distinct(), "settled")
            above_level = level
    return above.select(F.col("node").alias("leaf")), edges


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.union(pairs.where("a <> b").selectExpr("b as a", "a as b"))


def _by_box(leaves: DataFrame) -> DataFrame:
    return leaves.repartition("node").sortWithinPartitions("node", "leaf")


def _core_leaves(
    tree: Tree, splits: Splits, pairs: DataFrame, unified: DataFrame | None, eps: float, min_samples: int, points: int, broadcast_cells: int
) -> DataFrame:
    """Leaves with core flags and the components that their core rows form within their box."""
    spark, p, limit = tree.leaves.sparkSession, len(tree.features), eps * eps
    with own_scratch(spark) as outside:
        leaves = tree.leaves.select("leaf", F.shiftright("leaf", tree.home).alias("node"), "n", "vkey", "xs", "ws")
        if unified is None:
            leaves = leaves.withColumn("unified", F.lit(False))
        else:
            marks = unified.withColumn("done", F.lit(True))
            leaves = leaves.join(marks, "leaf", "left").withColumn("unified", F.coalesce("done", F.lit(False))).drop("done")
        with arrow_rows(spark, batch_rows(p, LEAF_ROWS)):
            known = _by_box(leaves.drop("vkey")).mapInPandas(kernels.home_cores(p, limit, min_samples), "leaf bigint, known array<boolean>")
            known = materialize(known, "known")
        leaves = leaves.join(known, "leaf")
        asked = chosen(leaves.selectExpr("leaf", "xs", "transform(known, k -> not k) as pick", "ws as tag"), splits, tree.home, "asked")
        counts = meet(
            asked, (whole(tree, "ws"), points), _both_ways(pairs),
            kernels.neighbour_counter(p, limit, limit * (1 + SLACK), min_samples, LEAF_BITS), "pid bigint, n bigint", "counts", p, broadcast_cells,
        )
        late = counts.groupBy("pid").agg(F.sum("n").alias("n")).where(F.col("n") >= min_samples)
        late = late.groupBy(F.shiftright("pid", LEAF_BITS).alias("leaf")).agg(
            F.collect_list(F.col("pid").bitwiseAND((1 << LEAF_BITS) - 1)).alias("late")
        )
        core = F.expr("if(late is null, known, transform(known, (k, i) -> k or array_contains(late, cast(i as bigint)))) as core")
        leaves = leaves.join(late, "leaf", "left").select("leaf", "node", "n", "vkey", "xs", "unified", core)
        with arrow_rows(spark, batch_rows(p, LEAF_ROWS)), outside():
            parts = _by_box(leaves).mapInPandas(
                kernels.home_parts(p, limit, LEAF_BITS), T.StructType([*leaves.schema.fields, T.StructField("part", T.ArrayType(T.LongType()))])
            )
            return materialize(parts, "cores")


def _vertices(tree: Tree, splits: Splits, pairs: DataFrame, leaves: DataFrame, rows: DataFrame, edges: list[DataFrame], eps: float, points: int, safe_rows: int, finish_edges: int, broadcast_cells: int) -> DataFrame:
    """Components within boxes (vertex), their lowest key, rows, and the root they have by settled boxes and by a sample of core rows."""
    p, limit = len(tree.features), eps * eps
    every = max(1, min(SAMPLE_SHARE, points // SAMPLE_ROWS))
    pid = f"(shiftleft(leaf, {LEAF_BITS}) + i)"
    pick = f"transform(part, (v, i) -> v >= 0 and (v = {pid} or pmod({pid}, {every}) = 0)) as pick"
    with own_scratch(leaves.sparkSession) as outside:
        sample = chosen(leaves.selectExpr("leaf", "xs", pick, "part as tag"), splits, tree.home, "sample")
        links = meet(
            sample, sample, pairs, kernels.linker(p, limit, limit * (1 + SLACK), LEAF_BITS), "edge bigint, x bigint, y bigint", "near", p, broadcast_cells
        )
        start = F.shiftleft("leaf", LEAF_BITS)
        solid = leaves.where("unified").select(start.alias("u"), F.col("part")[0].alias("v"))
        edges = reduce(DataFrame.union, [links.selectExpr("x as u", "y as v"), solid, *edges])
        roots = connected_components(edges, safe_rows=safe_rows, finish_edges=finish_edges)
        vertices = rows.where("vertex is not null").groupBy("vertex").agg(F.min("vkey").alias("first"), F.count(F.lit(1)).alias("n"))
        vertices = vertices.join(roots, "vertex", "left").select("vertex", "first", "n", F.coalesce("root", "vertex").alias("root"))
        with outside():
            return materialize(vertices, "vertices")


def _links(tree: Tree, splits: Splits, pairs: DataFrame, leaves: DataFrame, vertices: DataFrame, eps: float, broadcast_cells: int) -> DataFrame:
    """Edges between roots, and border rows with the roots that reach them.

    An edge has an end outside the largest root, so core rows of that one need not look for any.
    """
    p, limit = len(tree.features), eps * eps
    largest = vertices.groupBy("root").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "root").first()
    largest = largest["root"] if largest else -1
    names = leaves.select("leaf", F.explode(F.array_distinct("part")).alias("vertex")).where("vertex >= 0")
    names = names.join(vertices.select("vertex", "root"), "vertex").groupBy("leaf").agg(
        F.map_from_entries(F.collect_list(F.struct("vertex", "root"))).alias("names")
    )
    tagged = leaves.join(names, "leaf", "left").selectExpr("leaf", "xs", "core", "transform(part, v -> coalesce(try_element_at(names, v), -1L)) as tag")
    with own_scratch(leaves.sparkSession) as outside:
        with own_scratch(leaves.sparkSession) as after:
            tagged = materialize(tagged, "tagged")
            with after():
                asked = chosen(tagged.selectExpr("leaf", "xs", f"transform(tag, t -> t <> {largest}L) as pick", "tag"), splits, tree.home, "asked")
                given = chosen(tagged.selectExpr("leaf", "xs", "core as pick", "tag"), splits, tree.home, "given")
        with outside():
            return meet(
                asked, given, _both_ways(pairs), kernels.linker(p, limit, limit * (1 + SLACK), LEAF_BITS), "edge bigint, x bigint, y bigint", "links", p, broadcast_cells
            )


def dbscan(
    df: DataFrame,
    features: list[str],
    eps: float = 0.5,
    min_samples: int = 5,
    key: str = KEY,
    label: str = LABEL,
    safe_rows: int = SAFE_ROWS,
    finish_edges: int = FINISH_EDGES,
    broadcast_cells: int = BROADCAST_CELLS,
) -> DataFrame:
    """Rows ``(key, label)``; noise is -1. Clusters are numbered by their lowest core key.

    A row is core when at least ``min_samples`` rows, itself included, lie within
    ``eps``. A border row takes the lowest-numbered cluster that reaches it. The last three
    parameters are sizes beyond which other joins are used; they don't change results.
    """
    return _cluster(df, features, eps, min_samples, key, label, safe_rows, finish_edges, broadcast_cells)[0]


def _cluster(df, features, eps, min_samples, key, label, safe_rows, finish_edges=FINISH_EDGES, broadcast_cells=BROADCAST_CELLS):
    points, facts = _write_points(df, features, key)
    key_type = df.schema[key].dataType.simpleString()
    if facts["points"] == 0:
        return df.select(key, F.lit(NOISE).alias(label)), None, None
    splits = plan_splits(points, features, facts["points"])
    with own_scratch(df.sparkSession) as outside:
        (tree,) = number_leaves([pack(points, splits, {"vkey": key_type}, "leaves")], splits)
        pairs, settled = close_pairs(tree, tree, eps, min_samples)
        unified, edges = _unify(tree, settled)
        with outside():
            leaves = _core_leaves(tree, splits, pairs, unified, eps, min_samples, facts["points"], broadcast_cells)
        at = leaves.select("leaf", F.posexplode(F.arrays_zip("vkey", "part")).alias("pos", "r"))
        rows = at.select(
            (F.shiftleft("leaf", LEAF_BITS) + F.col("pos")).alias("pid"),
            F.col("r.vkey").alias("vkey"),
            F.when(F.col("r.part") >= 0, F.col("r.part")).alias("vertex"),
        )
        with outside():
            vertices = _vertices(tree, splits, pairs, leaves, rows, edges, eps, facts["points"], safe_rows, finish_edges, broadcast_cells)
            pairs = materialize(pairs, "open")
    links = _links(tree, splits, pairs, leaves, vertices, eps, broadcast_cells)
    roots = connected_components(links.where("edge = 1").selectExpr("x as u", "y as v"), safe_rows=safe_rows, finish_edges=finish_edges)
    groups = vertices.groupBy("root").agg(F.min("first").alias("first"))
    groups = groups.join(roots.selectExpr("vertex as root", "root as whole"), "root", "left")
    groups = materialize(groups.select("root", "first", F.coalesce("whole", "root").alias("whole")), "groups")
    clusters = numbered(groups.groupBy("whole").agg(F.min("first").alias("first")), "first", "cluster")
    hot = hot_keys(groups, "whole", facts["points"], safe_rows)
    groups = lookup(groups.select("root", "whole"), clusters.select("whole", "cluster"), "whole", "inner", hot)
    groups = materialize(groups.select("root", F.col("cluster").cast("int").alias("cluster")), "groups")
    hot = hot_keys(vertices, "root", facts["points"], safe_rows)
    placed = lookup(vertices.select("vertex", "root"), groups, "root", "inner", hot).select("vertex", "cluster")

    core = rows.where("vertex is not null").select("pid", "vertex").join(placed, "vertex").select("pid", "cluster")
    border = links.where("edge = 0").select(F.col("x").alias("pid"), F.col("y").alias("root"))
    hot = hot_keys(border, "root", border.count(), safe_rows)
    reached = core.unionByName(lookup(border, groups, "root", "inner", hot).select("pid", "cluster"))
    best = reached.groupBy("pid").agg(F.min("cluster").alias(label))
    named = rows.join(best, "pid", "left").select("vkey", F.coalesce(label, F.lit(NOISE)).alias(label))
    if facts["points"] == facts["rows"]:
        return named.withColumnRenamed("vkey", key), (splits, leaves), best
    return _to_copies(df.select(key, *features), points, named, features, key, label, facts), (splits, leaves), best


def _to_copies(df, points, named, features, key, label, facts) -> DataFrame:
    """Labels of points back to all their copies; points with very many copies go by broadcast."""
    labelled = points.join(named, "vkey").select(*features, "w", label)
    if facts["heaviest"] * HOT_SHARE <= facts["rows"]:
        return df.join(labelled, features).select(key, label)
    heavy = F.col("w") * HOT_SHARE > facts["rows"]  # fewer than HOT_SHARE points can pass
    hot = F.broadcast(materialize(labelled.where(heavy).drop("w"), "heavy"))
    cold = df.join(hot.select(*features), features, "left_anti").join(labelled.where(~heavy), features)
    return cold.select(key, label).unionByName(df.join(hot, features).select(key, label))


@dataclass(frozen=True)
class CoreIndex:
    """Core rows packed into leaves, with the splits that placed them, their number and the highest leaf number of a region."""

    splits: Splits
    leaves: DataFrame
    top: int
    points: int


@dataclass(frozen=True)
class DensityFit:
    """What scoring needs of a density clustering: its core rows (cluster number and features) and their reach.

    A saved model also has their index, so that scoring packs only the new rows.
    """

    features: list[str]
    eps: float
    min_samples: int
    cores: DataFrame
    index: CoreIndex | None = None


def core_index(model: DensityFit) -> CoreIndex | None:
    """The index of a model's core rows, packed now if it has none; None without core rows."""
    if model.index:
        return model.index
    points = model.cores.count()
    if not points:
        return None
    splits = plan_splits(model.cores, model.features, points)
    core = model.cores.select(F.lit(1).cast("bigint").alias("w"), F.col(LABEL).alias("labels"), *model.features)
    leaves, top = pack(core, splits, {"labels": "int"}, "core")
    return CoreIndex(splits, leaves, top, points)


def fit_density(
    df: DataFrame,
    features: list[str],
    eps: float = 0.5,
    min_samples: int = 5,
    key: str = KEY,
    label: str = LABEL,
    safe_rows: int = SAFE_ROWS,
) -> tuple[DataFrame, DensityFit]:
    """Labels as :func:`dbscan` gives them, and the model; equal core rows are in it once."""
    labels, blocks, best = _cluster(df, features, eps, min_samples, key, label, safe_rows)
    if blocks is None:
        none = df.select(F.lit(NOISE).alias(LABEL), *features).limit(0)
        return labels, DensityFit(list(features), eps, min_samples, none)
    p, leaves = len(features), blocks[1]
    flat = leaves.select("leaf", "xs", F.posexplode("core").alias("pos", "is_core")).where("is_core")
    cores = flat.select(
        (F.shiftleft("leaf", LEAF_BITS) + F.col("pos")).alias("pid"),
        *[F.get("xs", F.col("pos") * p + i).alias(f) for i, f in enumerate(features)],
    ).join(best, "pid").select(F.col(label).alias(LABEL), *features)
    return labels, DensityFit(list(features), eps, min_samples, materialize(cores, "cores"))


def assign_to_core(
    train: DataFrame,
    fresh: DataFrame,
    features: list[str],
    eps: float = 0.5,
    min_samples: int = 5,
    key: str = KEY,
    label: str = LABEL,
    safe_rows: int = SAFE_ROWS,
) -> DataFrame:
    """Label each new row with the cluster of its nearest core row within ``eps``, else -1."""
    return assign_by_model(fit_density(train, features, eps, min_samples, key, label, safe_rows)[1], fresh, key, label)


def assign_by_model(model: DensityFit, fresh: DataFrame, key: str = KEY, label: str = LABEL) -> DataFrame:
    """Rows ``(key, label)`` of ``fresh`` by a fitted density model; equal distances go to the lowest cluster."""
    features, eps, p = model.features, model.eps, len(model.features)
    points, facts = _write_points(fresh, features, key)
    if not facts["points"]:
        return fresh.select(key, F.lit(NOISE).alias(label))
    key_type = fresh.schema[key].dataType.simpleString()
    with own_scratch(fresh.sparkSession) as outside:
        index = core_index(model)
        if index is None:
            return fresh.select(key, F.lit(NOISE).alias(label))
        splits = index.splits
        with outside():
            packed = pack(points, splits, {"vkey": key_type}, "fresh")
        left, right = number_leaves([packed, (index.leaves, index.top)], splits)
        pairs, _ = close_pairs(left, right, eps)
        given = whole(right, "labels"), index.points
        kernel, schema = kernels.nearest_core(p, eps * eps, eps * eps * (1 + SLACK), LEAF_BITS, splits), "pid bigint, d2 double, label bigint"
        far = f"array_repeat({number(eps * eps)}, n)"
        first = meet((whole(left, "ws", far), facts["points"]), given, pairs.where("a = b"), kernel, schema, "first", p, home=True)
        at = F.col("pid").bitwiseAND((1 << LEAF_BITS) - 1).cast("int")
        first = first.groupBy(F.shiftright("pid", LEAF_BITS).alias("leaf")).agg(
            F.map_from_entries(F.collect_list(F.struct(at.alias("pos"), "d2"))).alias("known")
        )
        closer = Tree(left.leaves.join(first, "leaf", "left"), features, left.shifts)
        most = f"transform(sequence(0, n - 1), i -> coalesce(try_element_at(known, i), {number(eps * eps)}))"
        asked = materialize(whole(closer, "ws", most), "asked"), facts["points"]
        with outside():
            reached = meet(asked, given, pairs, kernel, schema, "reached", p)
    closest = reached.groupBy("pid").agg(F.min(F.struct("d2", "label"))["label"].cast("int").alias(label))
    named = (
        left.leaves.select("leaf", F.posexplode("vkey").alias("pos", "vkey"))
        .select((F.shiftleft("leaf", LEAF_BITS) + F.col("pos")).alias("pid"), "vkey")
        .join(closest, "pid", "left")
        .select("vkey", F.coalesce(label, F.lit(NOISE)).alias(label))
    )
    if facts["points"] == facts["rows"]:
        return named.withColumnRenamed("vkey", key)
    return _to_copies(fresh.select(key, *features), points, named, features, key, label, facts)


def cluster_counts(labels: DataFrame, label: str = LABEL) -> DataFrame:
    """Number of clusters without noise, and number of noise rows."""
    per_label = labels.groupBy(col(label).alias("_l")).agg(F.count(F.lit(1)).alias("n"))
    real = (F.col("_l") != NOISE) & F.col("_l").isNotNull()
    return per_label.agg(
        F.count_if(real).alias("clusters"),
        F.coalesce(F.sum(F.when(F.col("_l") == NOISE, F.col("n"))), F.lit(0)).alias("noise"),
    )
