"""Rows packed into small boxes, and the pairs of boxes that come close to each other.

Rows are turned to the principal axes of a sample, where few axes hold most of the spread, and placed in regions by
median splits. A region's rows come sorted to a task, which halves HELD_ROWS of them at a time, down to leaves
of at most LEAF_ROWS rows, so leaves stay compact however many rows a region has. Leaves are
numbered so that up to thirty-two form a box one level up. Close pairs are found from the top down with equi-joins on
the parent box, down to boxes of some thirty leaves. Rows in question then meet all rows in tiles: a task holds one
group of leaves while others pass by, and opens a leaf only where its box is near. A row is sent to a number of tiles
that doesn't grow with the table, so what is shuffled grows with the rows and not with the pairs of leaves.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions import kernels
from cohorts.functions.columns import number, squared_distance, squares
from cohorts.session import materialize, materialize_with

LEAF_ROWS = 128
HELD_ROWS = 1 << 17
LEAF_BITS = 8
FANOUT_BITS = 5
MAX_DEPTH = 12
SAMPLE_PER_REGION = 16
SLACK = 1e-9
MAX_PARTS = 20_000
BROADCAST_CELLS = 4_000_000
TILES = 64
# Cells a task holds of a tile; more rows than TILES tasks can hold get more tiles.
HELD_CELLS = 1 << 25


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Smaller Arrow batches while rows carry whole blocks."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(1, rows)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def batch_rows(p: int, rows_per_block: int, budget: int = 64 << 20) -> int:
    return max(4, min(10_000, budget // (2 * 8 * (p + 2) * rows_per_block)))


@dataclass(frozen=True)
class Splits:
    features: list[str]
    depth: int
    dims: object
    cuts: object
    ends: object
    middle: object
    axes: object


@dataclass(frozen=True)
class Tree:
    """Leaves (number ``leaf``) and how many bits each level drops from the leaf number."""

    leaves: DataFrame
    features: list[str]
    shifts: list[int]

    @property
    def home(self) -> int:
        """Bits that lead from a leaf to its box, the lowest level of boxes that are compared by joins."""
        return self.shifts[1]

    def nodes(self, level: int) -> DataFrame:
        """Boxes of a level with a known row, the squared span, the weight and the parent's number."""
        shift = self.shifts[level]
        up = self.shifts[level + 1] - shift
        if shift == 0:
            return self.leaves.withColumn("parent", F.shiftright("leaf", up)).withColumnRenamed("leaf", "node")
        p = len(self.features)
        rep = f"min_by(array({', '.join(f'rep{i}' for i in range(p))}), leaf) as rep"
        merged = self.leaves.groupBy(F.shiftright("leaf", shift).alias("node")).agg(
            *[F.expr(f"min(lo{i}) as lo{i}") for i in range(p)],
            *[F.expr(f"max(hi{i}) as hi{i}") for i in range(p)],
            F.expr(rep),
            F.expr("sum(w) as w"),
        )
        span = squared_distance([f"hi{i}" for i in range(p)], [f"lo{i}" for i in range(p)])
        boxes = merged.selectExpr(
            "*", f"shiftright(node, {up}) as parent", f"{span} as span", *[f"rep[{i}] as rep{i}" for i in range(p)]
        ).drop("rep")
        return materialize(boxes, "boxes")


def plan_splits(df: DataFrame, features: list[str], rows: int, seed: int = 7) -> Splits:
    """Median splits from a sample of bounded size, as a range partitioner takes one."""
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, rows / LEAF_ROWS)))))
    wanted = SAMPLE_PER_REGION << depth
    share = min(1.0, 1.5 * wanted / max(1, rows))
    picked = df.select(*features)
    picked = picked.sample(share, seed) if share < 1.0 else picked
    sample = picked.limit(2 * wanted).toPandas().to_numpy(dtype=float)
    middle, axes = kernels.principal_axes(sample)
    dims, cuts, ends = kernels.split_plan(kernels.turn(sample, middle, axes), depth)
    return Splits(features, depth, dims, cuts, ends, middle, axes)


def _box_columns(p: int) -> str:
    return ", ".join(f"lo{i} double, hi{i} double, rep{i} double" for i in range(p))


def pack(df: DataFrame, splits: Splits, keep: dict[str, str], name: str) -> tuple[DataFrame, int]:
    """Leaves of ``df`` and the highest leaf number within a region.

    ``keep`` names columns carried along as arrays, with their types.
    """
    features, p = splits.features, len(splits.features)
    place = kernels.region_assigner(features, splits, splits.depth)
    columns = df.select(*keep, "w", *features)
    located = columns.mapInPandas(
        place,
        ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields) + ", region bigint, inner double",
    )
    ordered = located.repartition("region").sortWithinPartitions("region", "inner")
    schema = (
        f"region bigint, number bigint, n int, w bigint, span double, {_box_columns(p)}, xs array<double>, ws array<bigint>"
        + "".join(f", {c} array<{t}>" for c, t in keep.items())
    )
    leaves = ordered.mapInPandas(kernels.leaf_packer(features, LEAF_ROWS, list(keep), splits, HELD_ROWS), schema)
    written, facts = materialize_with(leaves, name, top="max(number)")
    return written, facts["top"] or 0


def number_leaves(packed: list[tuple[DataFrame, int]], splits: Splits) -> list[Tree]:
    """Trees over several packings with one numbering, so that their boxes can be compared level by level."""
    bits = max(int(top).bit_length() for _, top in packed)
    height = splits.depth + bits
    levels = max(1, math.ceil(height / FANOUT_BITS))
    shifts = [round(i * height / levels) for i in range(levels)] + [max(height, 1)]
    return [
        Tree(
            leaves.withColumn("leaf", F.shiftleft("region", bits).bitwiseOR(F.col("number"))).drop("region", "number"),
            splits.features,
            shifts,
        )
        for leaves, _ in packed
    ]


def with_blocks(pairs: DataFrame, left: DataFrame, right: DataFrame, cells: int, broadcast_cells: int | None = None) -> DataFrame:
    """Pairs ``(a, b)`` with the contents of both blocks.

    ``cells`` is the number of values in all blocks. A table within ``broadcast_cells``
    (by default BROADCAST_CELLS) goes to every task and the pairs keep their spread; a larger one is shuffled to
    the pairs, whose rows then weigh enough to be spread by size. The pairs
    themselves are never broadcast: that would leave the work to a few tasks.
    """
    if cells <= (BROADCAST_CELLS if broadcast_cells is None else broadcast_cells):
        return pairs.join(F.broadcast(left), "a").join(F.broadcast(right), "b")
    return pairs.hint("merge").join(left, "a").hint("merge").join(right, "b")


def close_pairs(
    left: Tree, right: Tree, eps: float, min_samples: int | None = None
) -> tuple[DataFrame, list[tuple[int, DataFrame]]]:
    """Pairs of boxes (level 1) that may hold rows within ``eps``, and pairs settled at some level as a whole.

    With ``min_samples`` both trees are the same one and pairs come once, ``a <= b``.
    Two boxes are settled when every row of one reaches every row of the other and
    both hold enough rows, or when both are that dense by themselves and one known
    row of each is within reach: all their rows are core rows of one cluster then.
    Settled pairs are not opened further.
    """
    spark = left.leaves.sparkSession
    p, limit = len(left.features), eps * eps
    same = min_samples is not None
    surely = number(limit * (1 - SLACK))
    frontier = spark.range(1).selectExpr("id as fa", "id as fb")
    settled: list[tuple[int, DataFrame]] = []
    for level in range(len(left.shifts) - 2, 0, -1):
        one = left.nodes(level)
        two = one if same else right.nodes(level)
        near = frontier.join(one.alias("a"), F.expr("fa = a.parent")).join(two.alias("b"), F.expr("fb = b.parent"))
        gaps = [f"greatest(a.lo{i} - b.hi{i}, b.lo{i} - a.hi{i}, 0.0D)" for i in range(p)]
        near = near.where(f"{squares(gaps)} <= {number(limit * (1 + SLACK))}")
        done = "false"
        if same:
            near = near.where("a.node <= b.node")

            spans = [f"greatest(b.hi{i} - a.lo{i}, a.hi{i} - b.lo{i})" for i in range(p)]
            steps = [f"(a.rep{i} - b.rep{i})" for i in range(p)]
            done = (
                f"a.w >= {min_samples} and b.w >= {min_samples} and (({squares(spans)}) <= {surely} or "
                f"(a.span <= {surely} and b.span <= {surely} and ({squares(steps)}) <= {surely}))"
            )
        pairs = near.selectExpr("a.node as a", "b.node as b", f"{done} as settled")
        pairs, facts = materialize_with(pairs, "pairs", settled="count_if(settled)")
        if facts["settled"]:
            settled.append((level, pairs.where("settled").select("a", "b")))
        frontier = pairs.where("not settled").selectExpr("a as fa", "b as fb")
    return frontier.selectExpr("fa as a", "fb as b"), settled


def whole(tree: Tree, tag: str, most: str = "cast(null as array<double>)") -> DataFrame:
    """All rows of a tree, ready to meet others; ``tag`` and ``most`` are SQL text of one array a leaf."""
    low, high = (", ".join(f"{side}{i}" for i in range(len(tree.features))) for side in ("lo", "hi"))
    return tree.leaves.selectExpr(
        f"shiftright(leaf, {tree.home}) as node", "leaf", f"array({low}) as lo", f"array({high}) as hi", "xs",
        "sequence(0, n - 1) as pos", f"cast({tag} as array<bigint>) as tag", f"{most} as most",
    )


def chosen(leaves: DataFrame, splits: Splits, home: int, name: str) -> tuple[DataFrame, int]:
    """Rows with ``pick`` of leaves ``(leaf, xs, pick, tag)``, ready to meet others, and how many."""
    p = len(splits.features)
    schema = "node bigint, leaf bigint, lo array<double>, hi array<double>, xs array<double>, pos array<int>, tag array<bigint>"
    boxed = leaves.select(F.shiftright("leaf", home).alias("node"), "leaf", "xs", "pick", "tag")
    with arrow_rows(leaves.sparkSession, batch_rows(p, LEAF_ROWS)):
        rows, facts = materialize_with(boxed.mapInPandas(kernels.chooser(p, splits), schema), name, n="coalesce(sum(size(pos)), 0)")
    return rows.selectExpr("*", "cast(null as array<double>) as most"), facts["n"]


def _groups(rows: DataFrame, count: int, name: str) -> DataFrame:
    """Boxes dealt to ``count`` groups of neighbours with like numbers of rows; the driver sees one number a box."""
    sizes = rows.groupBy("node").agg(F.sum(F.size("pos")).alias("n")).orderBy("node").collect()
    total, before, dealt = sum(r["n"] for r in sizes), 0, []
    for r in sizes:
        dealt.append((r["node"], before * count // total))
        before += r["n"]
    return rows.sparkSession.createDataFrame(dealt, f"node bigint, {name} bigint")


def dealt(
    queries: tuple[DataFrame, int], targets: tuple[DataFrame, int], pairs: DataFrame, p: int,
    broadcast_cells: int = BROADCAST_CELLS, home: bool = False,
) -> tuple[DataFrame, int]:
    """Leaves of queries and targets for every tile in which a box of theirs is in a pair ``(a, b)``, and the number of parts to spread tiles over.

    Queries come in as many groups, and targets in as many others, that the fewest rows are sent; a tile is one of each.
    With ``home`` a tile is one box.
    """
    (asked, n), (given, m) = queries, targets
    parts = 2 * asked.sparkSession.sparkContext.defaultParallelism
    if home:
        near = pairs.select("a", "b", F.col("a").alias("tile"))
    else:
        rows = min(TILES, max(1, round(math.sqrt(TILES * n / m))))
        columns = max(math.ceil(TILES / rows), math.ceil(m * p / HELD_CELLS))
        parts = rows * columns
        near = (
            pairs.join(F.broadcast(_groups(asked, rows, "ga").withColumnRenamed("node", "a")), "a")
            .join(F.broadcast(_groups(given, columns, "gb").withColumnRenamed("node", "b")), "b")
            .select("a", "b", (F.col("ga") * columns + F.col("gb")).alias("tile"))
        )
        near = materialize(near, "near")

    def sent(side: int, data: DataFrame, box: str) -> DataFrame:
        tiles = near.select(F.col(box).alias("node"), "tile").distinct().groupBy("node").agg(F.collect_list("tile").alias("tiles"))
        tiles = F.broadcast(tiles) if max(n, m) * p <= broadcast_cells else tiles
        return data.join(tiles, "node").select(F.explode("tiles").alias("tile"), F.lit(side).alias("side"), "leaf", "lo", "hi", "xs", "pos", "tag", "most")

    return sent(0, given, "b").unionByName(sent(1, asked, "a")), parts


def meet(
    queries: tuple[DataFrame, int], targets: tuple[DataFrame, int], pairs: DataFrame, kernel, schema: str, name: str,
    p: int, broadcast_cells: int = BROADCAST_CELLS, home: bool = False,
) -> DataFrame:
    """What ``kernel`` finds where query rows meet target rows in boxes ``(a, b)`` of ``pairs``; both as :func:`chosen` or :func:`whole` give them."""
    spark = pairs.sparkSession
    if not queries[1] or not targets[1]:
        return spark.createDataFrame([], schema)
    together, parts = dealt(queries, targets, pairs, p, broadcast_cells, home)
    together = together.repartition(parts, "tile").sortWithinPartitions("tile", "side", "leaf")
    with arrow_rows(spark, batch_rows(p, LEAF_ROWS)):
        return materialize(together.mapInPandas(kernel, schema), name)
