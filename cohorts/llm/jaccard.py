"""N-gram Jaccard join: exact links between documents whose shingle sets overlap enough, and their components.

Jaccard distance is a metric, but between unrelated texts it is 1, to every pivot: Voronoi
regions around pivots separate nothing there, and windows of twice the radius would copy each document to
every region. So the first regions are drawn by slices: a hash cuts the shingle universe into slices, and
documents that agree in a whole slice share a region. With more slices than two linked sets can differ in
shingles, linked sets agree in one, so no link leaves its region. Shingles of many documents are left out of the
slices of sets that have enough others, so a popular passage joins no regions. Inside large regions, where
distances do vary, pivots create Voronoi regions, triangle-inequality windows copy boundary documents, and what
is still large is joined block by block; every path computes exact intersections.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions.columns import col
from cohorts.functions.skew import numbered
from cohorts.llm.graph import components
from cohorts.llm.tables import LOWER, UPPER, table
from cohorts.session import materialize, materialize_with, own_scratch

WORDS, PERCENT = 3, 90
# Sets up to this size are signed by triples of their first shingles, larger ones by slices of their size class.
SMALL = 48
# Sizes of a class differ by less than this factor; slices for each shingle that may differ.
CLASS, SLICES = 1.25, 1.15
# Shingles in so many documents of a stretch of so many shingles count as popular; the most frequent are listed (8 bytes each).
OFTEN, STRETCH, POPULAR = 5, 1_000_000, 1_000_000
# A region of up to so many sets and shingles is joined in one task; larger ones are split by pivots, then in blocks.
REGION_SETS, REGION_SHINGLES = 200, 500_000
PIVOTS, ROUNDS, BLOCK = 16, 2, 128
# Id lists of up to so many rows are broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000

FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(raw: bytes, known: dict[bytes, int]) -> np.ndarray:
    out = []
    for word in raw.translate(FOLD).split():
        value = known.get(word)
        if value is None:
            if len(known) > 500_000:
                known.clear()
            value = known[word] = xxhash.xxh3_64_intdigest(word)
        out.append(value)
    return np.array(out, dtype=np.uint64)


def shingle_set(raw: bytes, words: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; of its whole sequence if it has fewer words."""
    h = word_hashes(raw, known)
    if len(h) == 0:
        return h
    size = min(words, len(h))
    value = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        value = mixed(value) + h[k : k + len(value)] * ODD[k % len(ODD)] + np.uint64(k)
    return np.unique(mixed(value))


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_digest(shingles.tobytes())
    first, second = np.frombuffer(whole, dtype=np.int64)
    return int(first), int(second)


class Rule:
    """When two sets link, and what signatures let no link escape.

    ``popular`` (sorted hashes) are shingles of many documents. They are left out of the first signatures of a
    set, so a passage that many documents share connects none of them; which shingles these are changes only the work, never a link.
    """

    def __init__(self, words: int, percent: int, popular: np.ndarray | None = None):
        self.words, self.percent = words, percent
        self.least = percent / 100
        self.popular = np.zeros(0, dtype=np.uint64) if popular is None else popular
        starts = [SMALL + 1]
        while starts[-1] < 1 << 40:
            starts.append(max(starts[-1] + 1, int(starts[-1] * CLASS)))
        self.starts = np.array(starts)

    def linked(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * common >= self.percent * (a + b - common)

    def differ(self, smaller: int) -> int:
        """Most shingles in which a set of this size and a linked one no smaller can differ."""
        return int(smaller * (100 - self.percent) // self.percent)

    def classes(self, size: int) -> range:
        """Size classes that a set is signed in: its own, and those of smaller sets it can link to (-1: small sets)."""
        low = ceil(size * self.percent / 100)
        first, last = np.searchsorted(self.starts, [low, size], side="right") - 1
        return range(int(first), int(last) + 1)

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        """Signatures of a set, such that sets that link have one in common.

        In a size class, linked sets differ in at most ``differ`` shingles, so in at most as many slices. A set with more
        filled slices agrees with each of its partners in one of the first ``differ`` + 1, before which neither has more that differ. A set with fewer adds signatures of more and finer slices, first without popular
        shingles and then with them, until it has enough; two partners both have those up to which one of them has.
        """
        rare = shingles
        if len(self.popular):
            place = np.searchsorted(self.popular, shingles)
            place[place == len(self.popular)] = 0
            rare = shingles[self.popular[place] != shingles]
        out = []
        for c in self.classes(len(shingles)):
            if c < 0:
                out.append(self.triples(shingles, rare))
                continue
            differ = self.differ(int(self.starts[c + 1]) - 1)
            for mode, (own, slices) in enumerate([(rare, 1), (rare, 2), (shingles, 1), (shingles, 2), (shingles, 4), (shingles, 0)]):
                signed, filled = self.slices(own, c, mode, differ, slices)
                out.append(signed[: differ + 1])
                if filled > differ:
                    break
        return np.unique(np.concatenate(out))

    @staticmethod
    def slices(shingles: np.ndarray, c: int, mode: int, differ: int, times: int) -> tuple[np.ndarray, int]:
        """Hashes of the slices of a set (of its single shingles with ``times`` 0), and how many there are."""
        if not len(shingles):
            return np.zeros(0, dtype=np.uint64), 0
        salt = np.uint64(8 * c + mode)
        if not times:
            return mixed(shingles + salt), len(shingles)
        count = int((differ + 1) * SLICES * times) + 1
        slot = (shingles % np.uint64(count)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slot, value = slot[order], mixed(shingles[order] + salt)
        first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        return mixed(np.add.reduceat(value, first) ^ mixed(slot[first].astype(np.uint64) * np.uint64(4096) + salt)), len(first)

    def triples(self, shingles: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """Hashes of all triples among the first shingles that must hold three common ones; popular shingles come last.

        A set that can link by one or two common shingles has its single shingles or pairs as well; its partners by
        so few have them too.
        """
        need = ceil(len(shingles) * self.percent / 100)
        ordered = np.concatenate((rare, np.setdiff1d(shingles, rare, assume_unique=True))) if len(rare) < len(shingles) else shingles
        out = []
        for common in range(min(need, 3), 4):
            lead = ordered[: len(shingles) - max(need, common) + common]
            place = np.array(list(combinations(range(len(lead)), common)), dtype=np.int64).reshape(-1, common)
            value = mixed(lead[place[:, 0]])
            for k in range(1, common):
                value = mixed(value + lead[place[:, k]] * ODD[k])
            out.append(value)
        return np.concatenate(out)


DIGESTS = "_id bigint, n bigint, h1 bigint, h2 bigint, popular boolean"


def _digests(words: int):
    """A row per document (``popular`` false), and rows (hash in ``h1``, documents in ``h2``) of shingles that recur within a stretch of them."""

    def batch_of(ids, size, first, second, popular: bool) -> pa.RecordBatch:
        arrays = [ids, *[pa.array(c, pa.int64()) for c in (size, first, second)], pa.array([popular] * len(ids), pa.bool_())]
        return pa.RecordBatch.from_arrays(arrays, names=["_id", "n", "h1", "h2", "popular"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            size, first, second, held, count = [], [], [], [], 0
            for at, text in enumerate(batch.column(1)):
                raw = text.as_buffer()
                shingles = shingle_set(raw.to_pybytes() if raw is not None else b"", words, known)
                a, b = set_digest(shingles)
                size.append(len(shingles))
                first.append(a)
                second.append(b)
                held.append(shingles)
                count += len(shingles)
                if count > STRETCH or at == batch.num_rows - 1:
                    values, n = np.unique(np.concatenate(held), return_counts=True)
                    often = n >= OFTEN
                    values, n = values[often].view(np.int64), n[often]
                    yield batch_of(pa.nulls(len(n), pa.int64()), [0] * len(n), values, n, True)
                    held, count = [], 0
            yield batch_of(batch.column(0), size, first, second, False)

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                sets = [shingle_set(t.as_buffer().to_pybytes(), words, known) for t in batch.column(1).slice(start, 500)]
                digest = np.array([set_digest(s) for s in sets], dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, 500), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["_id", "h1", "h2", "shingles"],
                )

    return run


SIGNED = "part int, entries binary, edges binary"
SIGNED_ARROW = pa.schema([("part", pa.int32()), ("entries", pa.binary()), ("edges", pa.binary())])
ENTRY = np.dtype([("sig", "<u8"), ("doc", "<i8")])
# An entry as it is sent: 40 bits of the signature besides its part, 48 of the set. Where two agree by chance, sets share a region without need.
SENT = np.dtype([("sig", "<u4"), ("sig_", "u1"), ("doc", "<u4"), ("doc_", "<u2")])
CODE = (1 << 48) - 1


def stars(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every set to the lowest of each signature it shares; one entry per signature, the lowest set's."""
    entries = entries[np.lexsort((entries["doc"], entries["sig"]))]
    first = np.concatenate(([True], entries["sig"][1:] != entries["sig"][:-1])) if len(entries) else np.zeros(0, dtype=bool)
    low = entries["doc"][np.flatnonzero(first)[np.cumsum(first) - 1]] if len(entries) else entries["doc"]
    apart = entries["doc"] != low
    edges = np.column_stack((entries["doc"][apart], low[apart]))
    return np.unique(edges, axis=0), entries[first]


def sent_entries(entries: np.ndarray) -> np.ndarray:
    """Entries cut to what is sent; a signature gives its upper bits, as the part it goes to is of the lower ones."""
    out = np.empty(len(entries), dtype=SENT)
    sig = entries["sig"] >> np.uint64(24)
    out["sig"], out["sig_"] = sig & np.uint64(0xFFFFFFFF), sig >> np.uint64(32)
    out["doc"], out["doc_"] = entries["doc"] & 0xFFFFFFFF, (entries["doc"] >> 32) & 0xFFFF
    return out


def received_entries(sent: np.ndarray) -> np.ndarray:
    out = np.empty(len(sent), dtype=ENTRY)
    out["sig"] = sent["sig"].astype(np.uint64) | (sent["sig_"].astype(np.uint64) << np.uint64(32))
    out["doc"] = sent["doc"].astype(np.int64) | (sent["doc_"].astype(np.int64) << 32)
    return out


def _sign(sent: Broadcast, parts: int):
    def pack(sigs: list[np.ndarray], docs: list[int]) -> pa.RecordBatch:
        entries = np.empty(sum(map(len, sigs)), dtype=ENTRY)
        entries["sig"] = np.concatenate(sigs)
        entries["doc"] = np.repeat(np.array(docs, dtype=np.int64) & CODE, [len(s) for s in sigs])
        edges, rest = stars(entries)
        part = (rest["sig"] % np.uint64(parts)).astype(np.int64)
        rest = rest[np.argsort(part, kind="stable")]
        upto = np.concatenate(([0], np.cumsum(np.bincount(part, minlength=parts))))
        filled = np.flatnonzero(np.diff(upto)).tolist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*filled, -1], pa.int32()),
                pa.array([*[sent_entries(rest[upto[p] : upto[p + 1]]).tobytes() for p in filled], None], pa.binary()),
                pa.array([*[None] * len(filled), edges.astype(np.int64).tobytes()], pa.binary()),
            ],
            schema=SIGNED_ARROW,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule: Rule = sent.value
        known: dict[bytes, int] = {}
        sigs, docs, count = [], [], 0
        for batch in batches:
            for text in batch.column(0):
                raw = text.as_buffer()
                shingles = shingle_set(raw.to_pybytes() if raw is not None else b"", rule.words, known)
                if not len(shingles):
                    continue
                sigs.append(rule.signatures(shingles))
                docs.append(set_digest(shingles)[0])
                count += len(sigs[-1])
                if count > 500_000:
                    yield pack(sigs, docs)
                    sigs, docs, count = [], [], 0
        if sigs:
            yield pack(sigs, docs)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges within one partition of signatures, and those that were found while signing."""
    held: list[np.ndarray] = []

    def edges_of(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k]), pa.int64()) for k in (0, 1)], names=["u", "v"])

    for batch in batches:
        for entries, edges in zip(batch.column(1), batch.column(2), strict=True):
            if entries.is_valid:
                held.append(received_entries(np.frombuffer(entries.as_buffer(), dtype=SENT)))
            if edges.is_valid:
                yield edges_of(np.frombuffer(edges.as_buffer(), dtype=np.int64).reshape(-1, 2))
    if held:
        yield edges_of(stars(np.concatenate(held))[0])


def slice_regions(texts: DataFrame, rule: Rule) -> DataFrame:
    """``(vertex, root)``: sets (CODE of their digest) that are connected by shared signatures.

    Signatures leave a task as packed entries, dealt by signature to as many parts as the input needs; equal
    signatures of a batch are met on the spot, so a signature of a third of all documents sends one entry per batch.
    """
    spark = texts.sparkSession
    parts = 16 * max(4, texts.rdd.getNumPartitions())
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts // 4)
    sent = spark.sparkContext.broadcast(rule)
    signed = texts.mapInArrow(_sign(sent, parts), SIGNED).repartition(n, "part")
    return components(materialize(signed.mapInArrow(_meet, "u bigint, v bigint"), "edges"))


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists, by products of incidence matrices over shared shingles."""
    def flat(sets):
        sizes = [len(s) for s in sets]
        return (np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)), np.repeat(np.arange(len(sets)), sizes)

    a, a_of = flat(left)
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    if left is right:
        values, counts = np.unique(a, return_counts=True)
        shared = values[counts > 1]
        b, b_of = a, a_of
        np.fill_diagonal(out, [len(s) for s in left])
    else:
        b, b_of = flat(right)
        shared = np.intersect1d(a, b)
    ia, ib = np.searchsorted(shared, a), np.searchsorted(shared, b)
    ia[ia == len(shared)] = 0
    ib[ib == len(shared)] = 0
    in_a, in_b = (shared[ia] == a, shared[ib] == b) if len(shared) else (np.zeros(len(a), bool), np.zeros(len(b), bool))
    ia, a_of, ib, b_of = ia[in_a], a_of[in_a], ib[in_b], b_of[in_b]
    step = 8192
    total = np.zeros(out.shape)
    for low in range(0, len(shared), step):
        here_a, here_b = (ia >= low) & (ia < low + step), (ib >= low) & (ib < low + step)
        x = np.zeros((len(left), step), dtype=np.float32)
        y = np.zeros((len(right), step), dtype=np.float32)
        x[a_of[here_a], ia[here_a] - low] = 1
        y[b_of[here_b], ib[here_b] - low] = 1
        total += x @ y.T
    total = np.rint(total).astype(np.int64)
    if left is right:
        np.fill_diagonal(total, np.diagonal(out))
    return total


def _join_regions(rule: Rule):
    """Links inside each region; rows arrive sorted by region. Links to sets of the same component already are left out."""

    def solve(vertex: list[int], sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
        size = np.array([len(s) for s in sets])
        found = rule.linked(common_counts(sets, sets), size[:, None], size[None, :])
        u, v = np.nonzero(np.triu(found, 1))
        names = np.array(vertex)
        return names[u].tolist(), names[v].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, vertex, sets = None, [], []
        for batch in batches:
            links: tuple[list[int], list[int]] = ([], [])
            for r, v, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if r != region:
                    if len(sets) > 1:
                        for side, more in zip(links, solve(vertex, sets), strict=True):
                            side.extend(more)
                    region, vertex, sets = r, [], []
                vertex.append(v)
                sets.append(np.frombuffer(s.as_buffer().to_pybytes(), dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in links], names=["u", "v"])
        if len(sets) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in solve(vertex, sets)], names=["u", "v"])

    return run


MEMBER = "region bigint, vertex bigint, shingles binary"


def _voronoi(rule: Rule):
    """Places every member with its region's pivots: its nearest one's region, all within the window, and links to pivots."""
    radius = 1 - rule.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for region, vertex, own, pivots in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                mine = np.frombuffer(own.as_buffer().to_pybytes(), dtype=np.uint64)
                others = [np.frombuffer(p["shingles"], dtype=np.uint64) for p in pivots]
                size = np.array([len(o) for o in others])
                common = common_counts([mine], others)[0]
                distance = 1 - common / (len(mine) + size - common)
                near = np.flatnonzero(distance <= distance.min() + 2 * radius + 1e-9)
                linked = [pivots[i]["vertex"] for i in np.flatnonzero(rule.linked(common, len(mine), size)) if pivots[i]["vertex"] != vertex]
                cells = [xxhash.xxh3_64_intdigest(f"{region}:{pivots[i]['vertex']}".encode()) - (1 << 63) for i in near]
                rows.append((vertex, cells, linked))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
                names=["vertex", "cells", "linked"],
            )

    return run


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("region").agg(F.count(F.lit(1)).alias("sets"), F.sum(F.length("shingles") / 8).alias("weight"))


def _beside(members: DataFrame, facts: DataFrame, rows: int) -> DataFrame:
    """Facts of regions joined to members; broadcast while few, so a large region isn't sent to one task."""
    return members.join(F.broadcast(facts) if rows <= BROADCAST_IDS else facts, "region")


def split_by_pivots(members: DataFrame, sizes: DataFrame, n_sizes: int, rule: Rule, seed: int, pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame]:
    """``(region, vertex)`` of members in the Voronoi regions of pivots of their region, boundary members in all they may have links in; links to pivots.

    A set belongs to a pivot's region if the pivot is no further than its nearest one by more than twice the link
    radius: by the triangle inequality, both ends of every link then meet in the nearest region of either.
    """
    chance = F.pmod(F.xxhash64(F.lit(seed), "vertex"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = _beside(members, sizes.select("region", "sets"), n_sizes).where(chance < 3 * pivots / F.col("sets"))
    some = some.groupBy("region").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64(F.lit(seed), "vertex").alias("h"), "vertex", "shingles"))), 1, pivots).alias("pivots"))
    some = materialize(some, "pivots")
    placed = members.join(some, "region").select("region", "vertex", "shingles", "pivots").mapInArrow(_voronoi(rule), "vertex bigint, cells array<bigint>, linked array<bigint>")
    placed = materialize(placed, "placed")
    links = placed.select(F.col("vertex").alias("u"), F.explode("linked").alias("v"))
    return placed.select("vertex", F.explode("cells").alias("region")), links


def _join_blocks(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sides = []
                for c in (0, 1):
                    block = batch.column(c)[row].as_py()
                    sides.append((
                        np.array([m["vertex"] for m in block]), np.array([m["comp"] for m in block]),
                        [np.frombuffer(m["shingles"], dtype=np.uint64) for m in block],
                    ))
                (u, cu, su), (v, cv, sv) = sides
                size_u, size_v = np.array([len(s) for s in su]), np.array([len(s) for s in sv])
                found = rule.linked(common_counts(su, sv), size_u[:, None], size_v[None, :]) & (cu[:, None] != cv[None, :])
                i, j = np.nonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array(u[i]), pa.array(v[j])], names=["u", "v"])

    return run


def join_in_blocks(members: DataFrame, links: DataFrame, rule: Rule, block: int = BLOCK) -> DataFrame:
    """Links inside regions of any size: blocks of members meet pair by pair, except where all are known to be connected.

    Members are numbered by region, component so far, and size; blocks whose sizes are too far apart for a link, or that lie within one component, don't meet.
    """
    comps = components(links).select("vertex", F.col("root").alias("comp"))
    known = members.join(comps, "vertex", "left").select("region", "vertex", F.coalesce("comp", "vertex").alias("comp"), "shingles")
    known = materialize(known.dropDuplicates(["region", "vertex"]), "members")
    size = (F.length("shingles") / 8).cast("long")
    order = known.select("region", "vertex", "comp", size.alias("n"), F.struct("region", "comp", size.alias("n"), "vertex").alias("rank"))
    placed = numbered(order, "rank", "place").withColumn("block", F.floor(F.col("place") / block)).drop("rank", "place")
    placed = materialize(placed, "placed")
    facts = placed.groupBy("region", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("comp").alias("c1"), F.max("comp").alias("c2")
    )
    facts = materialize(facts, "blocks")
    other = facts.withColumnsRenamed({c: f"{c}_" for c in facts.columns if c != "region"})
    apart = (F.col("high") * 100 < F.col("low_") * rule.percent) | (F.col("high_") * 100 < F.col("low") * rule.percent)
    one = (F.col("c1") == F.col("c2")) & (F.col("c1_") == F.col("c2_")) & (F.col("c1") == F.col("c1_"))
    pairs = facts.join(other, "region").where((F.col("block") <= F.col("block_")) & ~apart & ~one).select("region", "block", "block_")
    packed = placed.select("region", "vertex", "block").join(known, ["region", "vertex"]).groupBy("region", "block").agg(
        F.collect_list(F.struct("vertex", "comp", "shingles")).alias("rows")
    )
    packed = materialize(packed, "packed")
    met = pairs.join(packed.withColumnRenamed("rows", "left"), ["region", "block"]).join(
        packed.withColumnsRenamed({"block": "block_", "rows": "right"}), ["region", "block_"]
    )
    return met.select("left", "right").mapInArrow(_join_blocks(rule), "u bigint, v bigint")


def link_regions(members: DataFrame, rule: Rule, region_sets: int = REGION_SETS, region_shingles: int = REGION_SHINGLES, rounds: int = ROUNDS) -> DataFrame:
    """All links inside regions (``region``, ``vertex``, ``shingles``), but those between sets that other links connect."""
    links = []
    for depth in range(rounds + 1):
        sizes = _sizes(members).withColumn("small", (F.col("sets") <= region_sets) & (F.col("weight") <= region_shingles))
        sizes, facts = materialize_with(sizes.where("sets > 1").select("region", "small", "sets"), "sizes", n="count_if(not small)", all="count(1)")
        sized = _beside(members, sizes, facts["all"])
        few = sized.where("small").select("region", "vertex", "shingles").repartition("region").sortWithinPartitions("region")
        links.append(materialize(few.mapInArrow(_join_regions(rule), "u bigint, v bigint"), "links"))
        if not facts["n"]:
            break
        members = materialize(sized.where("not small").select("region", "vertex", "shingles"), "large")
        if depth == rounds:
            so_far = _union(links)
            links.append(materialize(join_in_blocks(members, so_far, rule), "links"))
            break
        cells, to_pivots = split_by_pivots(members, sizes.where("not small"), facts["n"], rule, depth)
        links.append(materialize(to_pivots, "links"))
        if cells.count() > 2 * members.count():  # windows copy more than they separate: go to blocks of what there is
            links.append(materialize(join_in_blocks(members, _union(links), rule), "links"))
            break
        members = materialize(cells.join(members.dropDuplicates(["vertex"]).select("vertex", "shingles"), "vertex").select("region", "vertex", "shingles"), "cells")
    return _union(links)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _members(own: DataFrame, classes: DataFrame, rule: Rule, broadcast_ids: int) -> DataFrame:
    """``(region, vertex, shingles)`` of every set that shares a region, from one row of its lowest id."""
    spark = own.sparkSession
    with own_scratch(spark) as outside:
        regions = slice_regions(own.select("_text"), rule)
        code = F.col("h1").bitwiseAND(F.lit(CODE))
        wanted = regions.withColumnRenamed("root", "region").join(classes.withColumn("code", code), F.col("code") == regions["vertex"])
        with outside():
            wanted, facts = materialize_with(
                wanted.select("h1", "h2", classes["vertex"], "rows", "region"), "wanted", n="count(1)", again="count_if(rows > 1)"
            )
    few = facts["n"] <= broadcast_ids
    ids = wanted.select(F.col("vertex").alias("_id")).distinct()
    texts = own.where("_text is not null").join(F.broadcast(ids) if few else ids, "_id", "left_semi")
    sets = texts.select("_id", "_text").mapInArrow(_sets(rule.words), "_id bigint, h1 bigint, h2 bigint, shingles binary")
    wanted = wanted.withColumnRenamed("vertex", "_id").drop("rows")
    members = sets.join(F.broadcast(wanted) if few else wanted, ["_id", "h1", "h2"])
    if facts["again"]:
        members = members.dropDuplicates(["region", "_id", "h1", "h2"])
    return materialize(members.select("region", F.col("_id").alias("vertex"), "shingles"), "members")


def link_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
    region_sets: int = REGION_SETS, region_shingles: int = REGION_SHINGLES, rounds: int = ROUNDS, broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row: set size, and the smallest id it is connected to by links.

    A document's set has its distinct shingles of ``words`` words (A-Z lower-cased, words between ASCII white space); a text
    with fewer words is one shingle, one without any has an empty set and no links. Two documents link if 100 times the intersection is at
    least ``percent`` times the union. Equal sets are one class, however many rows hold them; links are sought between classes: regions by slices, then
    pivots inside large regions, exact intersections throughout. Sets are held as 64-bit hashes of shingles.

    Rows with the same id are one document. Null ids get a null component, unless they equal a text with an id.
    Null texts are empty. Other columns are not read.
    """
    own = docs.select(col(id_col).cast("long").alias("_id"), col(text_col).alias("_text"))
    seen = materialize(own.mapInArrow(_digests(words), DIGESTS), "sets")
    often = seen.where("popular").groupBy("h1").agg(F.sum("h2").alias("n")).orderBy(F.desc("n"), "h1").limit(POPULAR)
    popular = np.sort(np.array([r["h1"] for r in often.select("h1").collect()], dtype=np.int64).view(np.uint64))
    info = seen.where("not popular").drop("popular")
    full = info.where("n > 0")
    classes = full.where("_id is not null").groupBy("h1", "h2", "_id").agg(F.count(F.lit(1)).alias("rows"))
    classes = classes.groupBy("h1", "h2").agg(F.min(F.struct("_id", "rows")).alias("v"))
    classes = materialize(classes.select("h1", "h2", F.col("v._id").alias("vertex"), F.col("v.rows").alias("rows")), "classes")

    rule = Rule(words, percent, popular)
    spark = docs.sparkSession
    with own_scratch(spark) as outside:
        members = _members(own, classes, rule, broadcast_ids)
        links = link_regions(members, rule, region_sets, region_shingles, rounds)
        with outside():
            links = materialize(links, "links")
    with own_scratch(spark) as outside:
        comps = components(links)
        with outside():
            comps = materialize(comps, "components").withColumnsRenamed({"vertex": "_v"})

    placed = full.join(classes, ["h1", "h2"], "left").join(comps, F.col("vertex") == F.col("_v"), "left")
    # one id may hold several texts: they are joined through it
    placed = placed.select("_id", "n", "h1", "h2", F.coalesce("root", "vertex").alias("component"))
    repeated = full.where("_id is not null").groupBy("_id").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a < b").select("_id")
    repeated, facts = materialize_with(repeated, "repeated", n="count(1)")
    if facts["n"]:
        extra = placed.join(repeated, "_id", "left_semi").select(F.col("_id").alias("u"), F.col("component").alias("v"))
        comps = materialize(components(links.union(extra)), "components").withColumnsRenamed({"vertex": "_v"})
        placed = full.join(classes, ["h1", "h2"], "left").join(comps, F.col("vertex") == F.col("_v"), "left")
        placed = placed.select("_id", "n", "h1", "h2", F.coalesce("root", "vertex").alias("component"))
    placed = placed.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    empty = info.where("n = 0").select(F.col("_id").alias(id_col), F.lit(0).cast("long").alias("n_shingles"), F.col("_id").alias("component_id"))
    return placed.union(empty)


def op9_jaccard(spark: SparkSession, base: str) -> DataFrame:
    return link_documents(table(spark, base, "documents"))


JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * common >= 90 * (x.n + y.n - common)
), both_ways AS (
  SELECT u, v FROM links UNION SELECT v, u FROM links
), reach(doc_id, low) AS (
  SELECT u, u FROM both_ways UNION SELECT b.v, r.low FROM reach r JOIN both_ways b ON b.u = r.doc_id WHERE r.low < b.v
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce((SELECT min(low) FROM reach r WHERE r.doc_id = d.doc_id), d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

QUERIES = {"op9_jaccard": op9_jaccard}
SQL = {"op9_jaccard": JACCARD_SQL}
