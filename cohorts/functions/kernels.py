"""NumPy work done inside tasks on blocks of bounded size.

Functions here are shipped by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def squared_distances(x: np.ndarray, y: np.ndarray, near: float | None = None) -> np.ndarray:
    """All squared distances between two blocks.

    A matrix product gives them quickly but not to the last digit. Entries where
    that matters, close to zero or close to ``near``, are summed again feature by
    feature, as a plain expression would.
    """
    xx, yy = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
    out = x @ y.T
    out *= -2.0
    out += xx[:, None]
    out += yy[None, :]
    size = (xx.max() + yy.max()) if len(x) and len(y) else 0.0
    again = out <= 1e-8 * size
    if near is not None:
        again |= np.abs(out - near) <= 1e-10 * size
    i, j = np.nonzero(again)
    if len(i):
        exact = np.zeros(len(i))
        for k in range(x.shape[1]):
            step = x[i, k] - y[j, k]
            exact += step * step
        out[i, j] = exact
    return out


def components(adjacent: np.ndarray) -> np.ndarray:
    """Lowest member index per connected component of a small symmetric matrix."""
    n = len(adjacent)
    label = np.arange(n)
    linked = adjacent | np.eye(n, dtype=bool)
    while True:
        lower = np.where(linked, label[None, :], n).min(axis=1)
        lower = lower[lower]
        if np.array_equal(lower, label):
            return label
        label = lower


def star_forest():
    """Lowest vertex of the component for every other vertex of a small edge table."""

    def run(batches):
        edges = pd.concat(list(batches), ignore_index=True)
        names, at = np.unique(edges[["a", "b"]].to_numpy(), return_inverse=True)
        left, right = at.reshape(-1, 2).T
        label = np.arange(len(names))
        while True:
            lower = label.copy()
            np.minimum.at(lower, left, label[right])
            np.minimum.at(lower, right, label[left])
            lower = np.minimum(lower, lower[lower])
            if np.array_equal(lower, label):
                break
            label = lower
        moved = label != np.arange(len(names))
        yield pd.DataFrame({"a": names[moved], "b": names[label[moved]]})

    return run


def split_plan(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Median splits of the widest feature, as a heap of ``2**depth - 1`` nodes.

    Also gives the widest feature of every end region. The sample only decides
    where regions end; every row is placed by the splits afterwards.
    """
    width = sample.shape[1]
    dims = np.zeros((1 << depth) - 1, dtype=np.int64)
    cuts = np.full((1 << depth) - 1, np.inf)
    ends = np.zeros(1 << depth, dtype=np.int64)
    members = {0: np.arange(len(sample))}
    for node in range((1 << (depth + 1)) - 1):
        rows = members.pop(node, np.empty(0, dtype=np.int64))
        values = sample[rows]
        dim = int(values.std(axis=0).argmax()) if len(rows) > 1 else node % width
        if node >= len(dims):
            ends[node - len(dims)] = dim
            continue
        dims[node] = dim
        column = values[:, dim]
        if len(rows) > 1 and column.min() < column.max():
            cut = float(np.median(column))
            if not (column > cut).any():
                cut = float(column[column < column.max()].max())
            cuts[node] = cut
        right = column > cuts[node]
        members[2 * node + 1], members[2 * node + 2] = rows[~right], rows[right]
    return dims, cuts, ends


def turn(x: np.ndarray, middle: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Rows by principal axes. Distances stay what they are, but for rounding."""
    return (x - middle) @ axes


def principal_axes(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Middle of a sample and its axes of decreasing spread; without spread, or finite figures, the axes are the features."""
    width = sample.shape[1]
    if len(sample) < 2 or not np.isfinite(sample).all():
        return np.zeros(width), np.eye(width)
    middle = sample.mean(axis=0)
    _, axes = np.linalg.eigh(np.atleast_2d(np.cov(sample - middle, rowvar=False)))
    return middle, np.ascontiguousarray(axes[:, ::-1])


def region_assigner(features: list[str], splits, depth: int):
    def run(batches):
        for pdf in batches:
            x = turn(pdf[features].to_numpy(dtype=float), splits.middle, splits.axes)
            row, node = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[row, splits.dims[node]] > splits.cuts[node])
            region = node - len(splits.dims)
            yield pdf.assign(region=region, inner=x[row, splits.ends[region]])

    return run


def halved(x: np.ndarray, rows: np.ndarray, size: int):
    """``rows`` in parts of at most ``size``, by halves along the widest axis, neighbours next to each other."""
    if len(rows) <= size:
        yield rows
        return
    axis = int(np.ptp(x[rows], axis=0).argmax())
    middle = size * -(-len(rows) // (2 * size))
    order = rows[np.argpartition(x[rows, axis], middle - 1)]
    yield from halved(x, order[:middle], size)
    yield from halved(x, order[middle:], size)


def leaf_packer(features: list[str], size: int, keep: list[str], splits, held: int):
    """Cut the rows of a region, ``held`` at a time, into leaves of at most ``size`` by halving; a leaf never spans two regions.

    Boxes are along the principal axes and wider by more than rounding; the known row of a leaf is as it came.
    """
    p = len(features)
    rounding = 64 * np.finfo(float).eps

    def leaf(region, number, x, turned, pdf):
        row = {"region": region, "number": number, "n": len(pdf), "w": int(pdf["w"].sum())}
        pad = rounding * (1 + p) * float(np.abs(turned).max())
        low, high = turned.min(axis=0) - pad, turned.max(axis=0) + pad
        for i in range(p):
            row[f"lo{i}"], row[f"hi{i}"], row[f"rep{i}"] = low[i], high[i], x[0, i]
        row["span"] = float(((high - low) ** 2).sum())
        row["xs"] = x.ravel()
        row["ws"] = pdf["w"].to_numpy()
        for name in keep:
            row[name] = pdf[name].tolist()
        return row

    def leaves(region, number, pdf):
        x = pdf[features].to_numpy(dtype=float)
        turned = turn(x, splits.middle, splits.axes)
        for rows in halved(turned, np.arange(len(x)), size):
            rows = np.sort(rows)
            yield leaf(region, number, x[rows], turned[rows], pdf.iloc[rows])
            number += 1

    def run(batches):
        waiting, n, region, number = [], 0, None, 0

        def flush():
            nonlocal waiting, n, number
            out = list(leaves(region, number, pd.concat(waiting, ignore_index=True))) if n else []
            number += len(out)
            waiting, n = [], 0
            for start in range(0, len(out), 1024):
                yield pd.DataFrame(out[start : start + 1024])

        for batch in batches:
            if not len(batch):
                continue
            bounds = [0, *(np.flatnonzero(np.diff(batch["region"].to_numpy())) + 1).tolist(), len(batch)]
            for start, stop in zip(bounds, bounds[1:]):
                here = int(batch["region"].iat[start])
                if here != region:
                    yield from flush()
                    region, number = here, 0
                waiting.append(batch.iloc[start:stop])
                n += stop - start
                if n >= held:
                    yield from flush()
        yield from flush()

    return run


def _runs(batches, column: str):
    """Rows of sorted batches as one frame for each value of ``column``."""
    waiting, now = [], None
    for batch in batches:
        if not len(batch):
            continue
        names = batch[column].to_numpy()
        bounds = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(batch)]
        for start, stop in zip(bounds, bounds[1:]):
            if waiting and names[start] != now:
                yield pd.concat(waiting, ignore_index=True)
                waiting = []
            now = names[start]
            waiting.append(batch.iloc[start:stop])
    if waiting:
        yield pd.concat(waiting, ignore_index=True)


def _spans(sizes) -> list[tuple[int, int]]:
    ends = np.cumsum(sizes)
    return list(zip((ends - sizes).tolist(), ends.tolist()))


def home_cores(p: int, limit: float, min_samples: int):
    """Rows that are core by the rows of their own box alone; a row's count ends once it is known to be core."""

    def run(batches):
        for pdf in _runs(batches, "node"):
            x = np.concatenate([np.reshape(v, (-1, p)) for v in pdf["xs"]])
            weight = np.concatenate(list(pdf["ws"])).astype(float)
            found = []
            for (start, stop), solid in zip(_spans(pdf["n"].to_numpy()), pdf["unified"]):
                known = np.full(stop - start, bool(solid))
                if not solid:
                    known = (squared_distances(x[start:stop], x[start:stop], limit) <= limit) @ weight[start:stop] >= min_samples
                left = np.flatnonzero(~known)
                if len(left):
                    known[left] = (squared_distances(x[start + left], x, limit) <= limit) @ weight >= min_samples
                found.append(known)
            yield pd.DataFrame({"leaf": pdf["leaf"], "known": found})

    return run


def home_parts(p: int, limit: float, leaf_bits: int):
    """Components that the core rows of a box form among themselves, named by a row of theirs; -1 for other rows."""

    def run(batches):
        for pdf in _runs(batches, "node"):
            sizes = pdf["n"].to_numpy()
            core = np.concatenate(list(pdf["core"])).astype(bool)
            names = np.concatenate([(int(leaf) << leaf_bits) + np.arange(n) for leaf, n in zip(pdf["leaf"], sizes)])[core]
            x = np.concatenate([np.reshape(v, (-1, p)) for v in pdf["xs"]])[core]
            label = np.arange(len(x))
            spans = _spans(np.array([int(core[start:stop].sum()) for start, stop in _spans(sizes)]))
            for (start, stop), solid in zip(spans, pdf["unified"]):
                if solid:
                    label[start:stop] = start
                elif stop > start:
                    label[start:stop] = start + components(squared_distances(x[start:stop], x[start:stop], limit) <= limit)
            for start, stop in spans:
                if start == stop:
                    continue
                own = label[start:stop].copy()
                others = np.arange(stop, len(x))
                if (own == own[0]).all():
                    others = others[label[stop:] != own[0]]
                if not len(others):
                    continue
                close = squared_distances(x[start:stop], x[others], limit) <= limit
                for name in np.unique(own):
                    rows = own == name
                    met = np.unique(np.append(label[others[close[rows].any(axis=0)]], label[start:stop][rows][0]))
                    if len(met) > 1:
                        label[np.isin(label, met)] = met[0]
            part = np.full(len(core), -1, dtype=np.int64)
            part[core] = names[label]
            yield pdf.assign(part=[part[start:stop] for start, stop in _spans(sizes)])

    return run


def chooser(p: int, splits):
    """The picked rows of leaves, with the box they fill along the principal axes, their positions and their tags."""
    rounding = 64 * np.finfo(float).eps

    def run(batches):
        for pdf in batches:
            out = []
            for node, leaf, xs, pick, tag in zip(*(pdf[c] for c in ("node", "leaf", "xs", "pick", "tag"))):
                at = np.flatnonzero(np.asarray(pick, dtype=bool))
                if not len(at):
                    continue
                x = np.reshape(xs, (-1, p))[at]
                turned = turn(x, splits.middle, splits.axes)
                pad = rounding * (1 + p) * float(np.abs(turned).max())
                out.append((node, leaf, turned.min(axis=0) - pad, turned.max(axis=0) + pad, x.ravel(), at, np.asarray(tag)[at]))
            if out:
                yield pd.DataFrame(out, columns=["node", "leaf", "lo", "hi", "xs", "pos", "tag"])

    return run


class Held:
    """Leaves of one tile, held while others pass by."""

    def __init__(self, pdf: pd.DataFrame, p: int):
        sizes = np.array([len(v) for v in pdf["tag"]])
        self.low, self.high = np.stack(list(pdf["lo"])), np.stack(list(pdf["hi"]))
        self.x = np.concatenate(list(pdf["xs"])).reshape(-1, p)
        self.tag = np.concatenate(list(pdf["tag"])).astype(np.int64)
        self.spans = _spans(sizes)

    def near(self, low, high, reach: float, chunk: int = 2048):
        """Held rows whose leaves come within ``reach``, nearest leaves first, some thousand at a time, and the least gap of each lot."""
        gap = np.maximum(self.low - high, low - self.high)
        gap = np.square(np.maximum(gap, 0.0, out=gap), out=gap).sum(axis=1)
        order = np.flatnonzero(gap <= reach)
        order = order[np.argsort(gap[order], kind="stable")]
        rows, n, least = [], 0, 0.0
        for leaf in order:
            start, stop = self.spans[leaf]
            if not rows:
                least = gap[leaf]
            rows.append(np.arange(start, stop))
            n += stop - start
            if n >= chunk:
                yield least, np.concatenate(rows)
                rows, n = [], 0
        if rows:
            yield least, np.concatenate(rows)

    def by_row(self, low, high, x, pad: float, reach: float, chunk: int = 64):
        """Held leaves that come within ``reach`` of a box, nearest first, ``chunk`` at a time: the least gap of the lot, its leaves, and the squared gap between each row ``x`` of the box and each leaf.

        ``x`` is along the axes of the boxes; gaps of rows are much wider than those of the box that holds them all.
        """
        gap = np.maximum(self.low - high, low - self.high)
        gap = np.square(np.maximum(gap, 0.0, out=gap), out=gap).sum(axis=1)
        order = np.flatnonzero(gap <= reach)
        order = order[np.argsort(gap[order], kind="stable")]
        for start in range(0, len(order), chunk):
            leaves = order[start : start + chunk]
            lows, highs = self.low[leaves].T - pad, self.high[leaves].T + pad
            between = np.zeros((len(x), len(leaves)))
            for column, low_, high_ in zip(x.T, lows, highs):
                step = np.maximum(low_ - column[:, None], column[:, None] - high_)
                between += np.square(np.maximum(step, 0.0, out=step), out=step)
            yield gap[leaves[0]], leaves, between


def tiles(p: int, meet, columns: list[str]):
    """Per tile, targets (side 0) are held and queries (side 1) pass by one leaf at a time; ``meet`` gives the output columns."""

    def run(batches):
        tile, waiting, held = None, [], None
        for pdf in batches:
            if not len(pdf):
                continue
            names, sides = pdf["tile"].to_numpy(), pdf["side"].to_numpy()
            edges = np.flatnonzero((names[1:] != names[:-1]) | (sides[1:] != sides[:-1])) + 1
            bounds = [0, *edges.tolist(), len(pdf)]
            out = []
            for start, stop in zip(bounds, bounds[1:]):
                if names[start] != tile:
                    tile, waiting, held = names[start], [], None
                part = pdf.iloc[start:stop]
                if sides[start] == 0:
                    waiting.append(part)
                    continue
                if held is None and waiting:
                    held, waiting = Held(pd.concat(waiting, ignore_index=True), p), []
                if held is None:
                    continue
                for leaf, low, high, xs, pos, tag, most in zip(*(part[c] for c in ("leaf", "lo", "hi", "xs", "pos", "tag", "most"))):
                    pos, tag = np.asarray(pos, dtype=np.int64), np.asarray(tag, dtype=np.int64)
                    out.append(meet(held, int(leaf), low, high, np.reshape(xs, (-1, p)), pos, tag, most))
            out = [o for o in out if o is not None and len(o[0])]
            if out:
                yield pd.DataFrame({c: np.concatenate(v) for c, v in zip(columns, zip(*out))})

    return run


def neighbour_counter(p: int, limit: float, reach: float, min_samples: int, leaf_bits: int):
    """Weighted neighbour counts of query rows in a tile; a count ends once it says that the row is core."""

    def meet(held, leaf, low, high, x, pos, tag, most):
        found = np.zeros(len(x))
        for _, rows in held.near(low, high, reach):
            left = np.flatnonzero(found < min_samples)
            if not len(left):
                break
            found[left] += (squared_distances(x[left], held.x[rows], limit) <= limit) @ held.tag[rows].astype(float)
        at = np.flatnonzero(found)
        return (leaf << leaf_bits) + pos[at], found[at].astype(np.int64)

    return tiles(p, meet, ["pid", "n"])


def linker(p: int, limit: float, reach: float, leaf_bits: int):
    """Components of held core rows that query rows touch: an edge from a core row's own component, else a border row's link."""

    def meet(held, leaf, low, high, x, pos, tag, most):
        own = tag
        source = np.where(own >= 0, own, (leaf << leaf_bits) + pos)
        found = []
        for _, rows in held.near(low, high, reach):
            other = held.tag[rows]
            if (own == own[0]).all():
                rows, other = rows[other != own[0]], other[other != own[0]]
                if not len(rows):
                    continue
            i, j = np.nonzero(squared_distances(x, held.x[rows], limit) <= limit)
            new = other[j] != own[i]
            found.append(np.unique(np.stack([own[i[new]] >= 0, source[i[new]], other[j[new]]]), axis=1))
        if not found:
            return None
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1))

    return tiles(p, meet, ["edge", "x", "y"])


def nearest_core(p: int, limit: float, reach: float, leaf_bits: int, splits, lot: int = 16):
    """Closest held core row within reach for every query row; equal distances go to the lowest label.

    Leaves are opened ``lot`` at a time, only for the rows, and only the leaves, whose gap is no more than what the row has found.

    ``most`` holds a squared distance for every query row that one of its core rows is known to have, or ``limit``. Distances that matter are summed
    feature by feature, so they are the same in whatever block a row stands.
    """
    rounding, middle, axes = 64 * np.finfo(float).eps, splits.middle, splits.axes

    def meet(held, leaf, low, high, x, pos, tag, most):
        best, label = np.array(most, dtype=float), np.full(len(x), np.iinfo(np.int64).max)
        turned = turn(x, middle, axes)
        pad = rounding * (1 + p) * float(np.abs(turned).max())
        squares = np.square(x).sum(axis=1)
        left_side = np.column_stack([-2.0 * x, squares, np.ones(len(x))])

        def opened():
            """Rows and held rows that are to meet, by what has been found so far."""
            for gap, leaves, between in held.by_row(low, high, turned, pad, min(reach, float(best.max()) * (1 + 1e-9))):
                if gap > best.max() * (1 + 1e-9):
                    return
                order = np.argsort(between.sum(axis=0), kind="stable")
                for start in range(0, len(order), lot):
                    at = order[start : start + lot]
                    near = between[:, at] <= (best * (1 + 1e-9))[:, None]
                    if near.any():
                        spans = [held.spans[leaf] for leaf in leaves[at[near.any(axis=0)]]]
                        yield np.flatnonzero(near.any(axis=1)), np.concatenate([np.arange(*s) for s in spans])

        for left, rows in opened():
            part, y = x[left], held.x[rows]
            own = np.square(y).sum(axis=1)
            d2 = left_side[left] @ np.vstack([y.T, np.ones(len(y)), own])
            size = squares[left].max() + own.max()
            i, j = np.nonzero(d2 <= (np.minimum(best[left], d2.min(axis=1)) + 1e-9 * size)[:, None])
            exact = np.zeros(len(i))
            for k in range(p):
                step = part[i, k] - y[j, k]
                exact += step * step
            i, names = left[i], held.tag[rows[j]]
            order = np.lexsort((names, exact, i))
            first = order[np.unique(i[order], return_index=True)[1]]
            at, d2, names = i[first], exact[first], names[first]
            closer = (d2 <= limit) & ((d2 < best[at]) | ((d2 == best[at]) & (names < label[at])))
            best[at[closer]], label[at[closer]] = d2[closer], names[closer]
        at = np.flatnonzero(label < np.iinfo(np.int64).max)
        return (leaf << leaf_bits) + pos[at], best[at], label[at]

    return tiles(p, meet, ["pid", "d2", "label"])


def held_blocks(kernel, columns: list[str], most: int = 16):
    """Runs a kernel of pairs of blocks over tiles, ``most`` pairs at a time: blocks of side 0 are held, those of side 1 pass by.

    Rows come sorted by tile, side and block. A pair counts with the smaller block first, so a tile of one group with itself
    has every pair once.
    """

    def pairs(batches):
        tile, held = None, []
        for pdf in batches:
            for now, side, block, *cells in zip(*(pdf[c] for c in ("tile", "side", "block", *columns))):
                if now != tile:
                    tile, held = now, []
                if side == 0:
                    held.append((block, cells))
                    continue
                met = [h for h in held if h[0] <= block]
                for start in range(0, len(met), most):
                    part = met[start : start + most]
                    frame = {"a": [a for a, _ in part], "b": [block] * len(part)}
                    for i, c in enumerate(columns):
                        frame[f"{c}a"], frame[f"{c}b"] = [own[i] for _, own in part], [cells[i]] * len(part)
                    yield pd.DataFrame(frame)

    def run(batches):
        yield from kernel(pairs(batches))

    return run


def distance_sums(p: int, chunk: int = 32):
    """Per row of both blocks of a tile, the weighted distance sum to each label of the other block.

    A squared distance is one entry of a product of rows that carry their own squares. ``chunk`` rows meet a
    block at a time in one buffer, which stays in a core's cache; entries too close to zero are summed again feature by feature.
    """

    def gaps(left, x, right, y, least, buffer):
        out = np.matmul(left, right, out=buffer[: len(left), : right.shape[1]])
        if out.min() <= least:
            i, j = np.nonzero(out <= least)
            exact = np.zeros(len(i))
            for k in range(p):
                step = x[i, k] - y[j, k]
                exact += step * step
            out[i, j] = exact
        return np.sqrt(out, out=out)

    def by_label(labels):
        order = np.argsort(labels, kind="stable")
        names, starts = np.unique(labels[order], return_index=True)
        return order, names, list(zip(starts, [*starts[1:], len(labels)]))

    def run(batches):
        for pdf in batches:
            blocks, labels, counts, values = [], [], [], []

            def emit(block, order, names, spans, weights, totals):
                for j, (name, (start, stop)) in enumerate(zip(names, spans)):
                    column = np.empty(len(totals))
                    column[order] = totals[:, j]
                    blocks.append(block)
                    labels.append(int(name))
                    counts.append(int(weights[start:stop].sum()))
                    values.append(column)

            buffer = np.empty((chunk, 0))
            columns = (pdf[c] for c in ("a", "b", "xa", "xb", "la", "lb", "wa", "wb"))
            for a, b, xa, xb, la, lb, wa, wb in zip(*columns):
                order_a, names_a, spans_a = by_label(np.asarray(la))
                order_b, names_b, spans_b = by_label(np.asarray(lb))
                x, y = np.reshape(xa, (-1, p))[order_a], np.reshape(xb, (-1, p))[order_b]
                wa, wb = np.asarray(wa, dtype=float)[order_a], np.asarray(wb, dtype=float)[order_b]
                to_b, to_a = np.zeros((len(x), len(names_b))), np.zeros((len(y), len(names_a)))
                xx, yy = np.square(x).sum(axis=1), np.square(y).sum(axis=1)
                left, right = np.column_stack([-2.0 * x, xx, np.ones(len(x))]), np.vstack([y.T, np.ones(len(y)), yy])
                least = 1e-8 * (xx.max() + yy.max())
                if buffer.shape[1] < len(y):
                    buffer = np.empty((chunk, len(y)))
                for low in range(0, len(x), chunk):
                    high = min(low + chunk, len(x))
                    gap = gaps(left[low:high], x[low:high], right, y, least, buffer)
                    for j, (start, stop) in enumerate(spans_b):
                        to_b[low:high, j] = gap[:, start:stop] @ wb[start:stop]
                    for j, (start, stop) in enumerate(spans_a if a != b else ()):
                        start, stop = max(start, low), min(stop, high)
                        if start < stop:
                            to_a[:, j] += wa[start:stop] @ gap[start - low : stop - low]
                emit(a, order_a, names_b, spans_b, wb, to_b)
                if a != b:
                    emit(b, order_b, names_a, spans_a, wa, to_a)
            yield pd.DataFrame({"block": blocks, "other": labels, "size": counts, "sums": values})

    return run


def spread_ratios(p: int):
    """Per cluster of both blocks, the worst ratio of summed spreads to centre distance within the tile."""

    def run(batches):
        for pdf in batches:
            blocks, values = [], []
            for a, b, xa, xb, sa, sb in zip(*(pdf[c] for c in ("a", "b", "xa", "xb", "sa", "sb"))):
                gap = np.sqrt(squared_distances(np.reshape(xa, (-1, p)), np.reshape(xb, (-1, p))))
                total = np.asarray(sa)[:, None] + np.asarray(sb)[None, :]
                ratio = np.divide(total, gap, out=np.zeros_like(total), where=gap > 0)
                if a == b:
                    np.fill_diagonal(ratio, 0.0)
                blocks.append(a)
                values.append(ratio.max(axis=1))
                if a != b:
                    blocks.append(b)
                    values.append(ratio.max(axis=0))
            yield pd.DataFrame({"block": blocks, "worst": values})

    return run


def product_sums(p: int):
    """Sums and products of all column pairs over rows where both are present; one small table per task."""

    def run(batches):
        totals = None
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            present = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            sums = np.stack(
                [present.T @ present, x.T @ present, present.T @ x, (x * x).T @ present, present.T @ (x * x), x.T @ x]
            )
            totals = sums if totals is None else totals + sums
        if totals is not None:
            i, j = np.divmod(np.arange(p * p), p)
            flat = totals.reshape(6, -1)
            yield pd.DataFrame(
                {"i": i, "j": j, **{name: flat[k] for k, name in enumerate(("n", "x", "y", "xx", "yy", "xy"))}}
            )

    return run


def seed_centres(
    sample: np.ndarray, weight: np.ndarray, k: int, seed: int, restarts: int = 3, rounds: int = 15, last_rounds: int = 300
) -> np.ndarray:
    """Start centres for ``k`` clusters: the best of several careful draws, improved on the weighted candidates until they settle.

    A centre is drawn with the chance of its weighted squared distance from those before it; where all rows coincide with
    a centre, fewer than ``k`` come back.
    """
    rng = np.random.default_rng([seed, k])
    norms = np.square(sample).sum(axis=1)

    def improve(centres: np.ndarray, rounds: int) -> tuple[float, np.ndarray]:
        now = np.inf
        for _ in range(rounds):
            d2 = norms[:, None] - 2 * sample @ centres.T + np.square(centres).sum(axis=1)
            own = d2.argmin(axis=1)
            now = float((weight * d2[np.arange(len(own)), own]).sum())
            member = np.zeros((len(centres), len(own)))
            member[own, np.arange(len(own))] = weight
            sizes = member.sum(axis=1, keepdims=True)
            moved = np.where(sizes > 0, member @ sample / np.where(sizes > 0, sizes, 1.0), centres)
            shift, centres = np.square(moved - centres).sum(axis=1).max(), moved
            if shift <= 1e-10:
                break
        return now, centres

    drawn = []
    for _ in range(restarts):
        centres = sample[rng.choice(len(sample), size=1, p=weight / weight.sum())]
        near = weight * np.square(sample - centres[0]).sum(axis=1)
        while len(centres) < k and near.sum() > 0:
            new = sample[rng.choice(len(sample), p=near / near.sum())]
            centres = np.vstack([centres, new])
            near = np.minimum(near, weight * np.square(sample - new).sum(axis=1))
        drawn.append(improve(centres, rounds))
    return improve(min(drawn, key=lambda x: x[0])[1], last_rounds)[1]
