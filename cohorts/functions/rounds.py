"""Work inside tasks for KMeans rounds over packed rows: sums per centre, distance bounds, and what a round changes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

# Rows in a block, blocks that are put in order of their bounds together, and rows of which one margin is noted.
BLOCK, GROUP, STRIDE = 4096, 16, 256
# Bounds are cut by this share of a distance, far more than rounding takes.
SLACK = 1e-9
# Candidates are as many; clusters are fewer.
MANY = 256

BLOCK_DDL = "n int, x binary"


def packer():
    """Rows of numbers to blocks of BLOCK rows, one binary cell each."""

    def block(x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["n", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            if np.isnan(x).any():
                raise ValueError("clustering needs complete rows: fill missing values first")
            held.append(x)
            n += len(x)
            if n >= BLOCK:
                rows = np.vstack(held)
                whole = n - n % BLOCK
                for start in range(0, whole, BLOCK):
                    yield block(rows[start : start + BLOCK])
                held, n = [rows[whole:]], n - whole
        if n:
            yield block(np.vstack(held))

    return run


def unpack(batches: Iterator[pa.RecordBatch], p: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for cell in batch.column("x"):
            yield np.frombuffer(cell.as_buffer()).reshape(-1, p)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, summed feature by feature, so that equal rows have equal distances; from MANY centres on, by a product."""
    if len(centres) >= MANY:
        middle = centres.mean(axis=0)
        x, centres = x - middle, centres - middle
        return np.maximum(np.square(x).sum(axis=1)[:, None] + (np.square(centres).sum(axis=1) - 2 * x @ centres.T), 0.0)
    out, step = np.zeros((len(centres), len(x))), np.empty((len(centres), len(x)))
    for column, middle in zip(np.ascontiguousarray(x.T), centres.T, strict=True):
        np.subtract(column, middle[:, None], out=step)
        step *= step
        out += step
    return out.T


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance from the nearest of many centres: by one product of matrices, and again one by one where that is too coarse."""
    middle = centres.mean(axis=0)
    x, centres = x - middle, centres - middle
    own = np.square(x).sum(axis=1)
    found = (np.square(centres).sum(axis=1) - 2 * x @ centres.T).min(axis=1) + own
    coarse = found < 1e-6 * (own + np.square(centres).sum(axis=1).max())
    if coarse.any():
        found[coarse] = [np.square(centres - one).sum(axis=1).min() for one in x[coarse]]
    return found


def far_drawer(centres: np.ndarray, n: int, seed: int, p: int):
    """Per task, the ``n`` rows with the lowest keys: exponential draws over the squared distance from ``centres`` (1 without any)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        held = np.zeros((0, p + 1))
        for x in unpack(batches, p):
            chance = nearest(x, centres) if len(centres) else np.ones(len(x))
            key = rng.exponential(size=len(x)) / np.where(chance > 0, chance, 1.0)
            rows = np.column_stack([key, x])[chance > 0]
            held = np.vstack([held, rows])
            if len(held) > n:
                held = held[np.argpartition(held[:, 0], n - 1)[:n]]
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.T], names=["key", *[f"x{i}" for i in range(p)]])

    return run


def _emit(totals: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (k, cluster, n, sse, s0, s1, ...) of the clusters that hold anything."""
    for k, total in totals.items():
        held = np.flatnonzero(np.abs(total).sum(axis=1) > 0)
        if len(held):
            arrays = [pa.array(np.full(len(held), k, dtype=np.int32)), pa.array(held.astype(np.int32)), pa.array(total[held, 0].astype(np.int64))]
            arrays += [pa.array(total[held, 1 + i]) for i in range(total.shape[1] - 1)]
            names = ["k", "cluster", "n", "sse", *[f"s{i}" for i in range(total.shape[1] - 2)]]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def _add(total: np.ndarray, own: np.ndarray, x: np.ndarray, sign: float = 1.0) -> None:
    total[:, 0] += sign * np.bincount(own, minlength=len(total))
    for i in range(x.shape[1]):
        total[:, 2 + i] += sign * np.bincount(own, weights=x[:, i], minlength=len(total))


def summer(centres: dict[int, np.ndarray], p: int):
    """Per k and centre, the number of nearest rows, their squared error and sums; ties go to the lowest centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros((len(c), 2 + p)) for k, c in centres.items()}
        for x in unpack(batches, p):
            for k, c in centres.items():
                d2 = distances(x, c)
                own = d2.argmin(axis=1)
                _add(totals[k], own, x)
                totals[k][:, 1] += np.bincount(own, weights=d2[np.arange(len(own)), own], minlength=len(c))
        yield from _emit(totals)

    return run


def bounder(centres: dict[int, np.ndarray], p: int):
    """Blocks with every row's nearest centre and margin for each k.

    The margin is how much farther the second nearest centre is: as long as the two move by less than
    that together, the row stays. Rows of GROUP blocks are put in order of their smallest margin, so that few blocks hold
    the rows that can change, and the columns ``low..`` tell which. ``steps`` has the smallest margin of every STRIDE-th row.
    """
    ks = list(centres)

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x = np.vstack(parts)
        own, margin = np.zeros((len(x), len(ks)), dtype=np.int32), np.zeros((len(x), len(ks)))
        for at, k in enumerate(ks):
            d = np.sqrt(distances(x, centres[k]))
            own[:, at] = d.argmin(axis=1)
            if d.shape[1] > 1:
                one = d.min(axis=1)
                d[np.arange(len(d)), own[:, at]] = np.inf
                two = d.min(axis=1)
                margin[:, at] = two - one - SLACK * (1 + two)
            else:
                margin[:, at] = np.inf
        order = np.argsort(margin.min(axis=1), kind="stable")
        x, own, margin = x[order], own[order], margin[order]
        for start in range(0, len(x), BLOCK):
            part = slice(start, start + BLOCK)
            cells = [x[part], own[part], margin[part]]
            arrays = [pa.array([len(cells[0])], pa.int32()), *[pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cells]]
            arrays += [pa.array([margin[part].min(axis=1)[::STRIDE].tolist()])]
            arrays += [pa.array([float(low)]) for low in margin[part].min(axis=0)]
            yield pa.RecordBatch.from_arrays(arrays, names=["n", "x", "own", "margin", "steps", *[f"low{k}" for k in ks]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for x in unpack(batches, p):
            held.append(x)
            if len(held) == GROUP:
                yield from flush(held)
                held = []
        if held:
            yield from flush(held)

    return run


def bound_ddl(ks: list[int]) -> str:
    return "n int, x binary, own binary, margin binary, steps array<double>, " + ", ".join(f"low{k} double" for k in ks)


def mover(ks: list[int], centres: dict[int, np.ndarray], limits: dict[int, np.ndarray], p: int):
    """What changes against the bounded labels: rows whose margin is under the limit of their centre are compared anew.

    Gives sums to add and, as negative ones, to take away; cluster -1 counts the rows compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros((len(c), 2 + p)) for k, c in centres.items()}
        compared = 0
        for batch in batches:
            cells = zip(batch.column("x"), batch.column("own"), batch.column("margin"), strict=True)
            for one, two, three in cells:
                x = np.frombuffer(one.as_buffer()).reshape(-1, p)
                labels = np.frombuffer(two.as_buffer(), dtype=np.int32).reshape(-1, len(ks))
                margin = np.frombuffer(three.as_buffer()).reshape(-1, len(ks))
                for k, c in centres.items():
                    own = labels[:, ks.index(k)]
                    open_ = np.flatnonzero(margin[:, ks.index(k)] < limits[k][own])
                    compared += len(open_)
                    new = distances(x[open_], c).argmin(axis=1)
                    moved = new != own[open_]
                    if moved.any():
                        rows = x[open_][moved]
                        _add(totals[k], new[moved], rows)
                        _add(totals[k], own[open_][moved], rows, -1.0)
        yield from _emit(totals)
        names = ["k", "cluster", "n", "sse", *[f"s{i}" for i in range(p)]]
        counted = [pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), pa.array([compared], pa.int64())]
        yield pa.RecordBatch.from_arrays(counted + [pa.array([0.0])] * (1 + p), names=names)

    return run


def opener(ks: list[int], wanted: list[int], limit: float, p: int):
    """From bounded blocks, the rows whose margin is under ``limit`` for some wanted k: blocks with their labels, in the order of ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [ks.index(k) for k in wanted]
        for batch in batches:
            cells = zip(batch.column("x"), batch.column("own"), batch.column("margin"), strict=True)
            for one, two, three in cells:
                margin = np.frombuffer(three.as_buffer()).reshape(-1, len(ks))[:, places]
                near = margin.min(axis=1) < limit
                if near.any():
                    x = np.frombuffer(one.as_buffer()).reshape(-1, p)[near]
                    own = np.ascontiguousarray(np.frombuffer(two.as_buffer(), dtype=np.int32).reshape(-1, len(ks))[near][:, places])
                    arrays = [pa.array([len(x)], pa.int32()), pa.array([x.tobytes()], pa.binary()), pa.array([own.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["n", "x", "own"])

    return run


def drift_limits(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Per centre, the margin from which its rows stay: how far itself and the farthest of the others have moved."""
    drift = np.sqrt(np.square(now - before).sum(axis=1))
    others = np.array([np.delete(drift, i).max(initial=0.0) for i in range(len(drift))])
    return (drift + others) * (1 + SLACK)


def means_of(totals: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The means of the rows of each centre, from rows (n, error, sums); a centre without rows stays."""
    n = totals[:, :1]
    return np.where(n > 0, totals[:, 2:] / np.where(n > 0, n, 1.0), centres)


def chainer(
    centres: dict[int, np.ndarray], p: int, rest: float, most: int,
    bounds: tuple[dict[int, np.ndarray], dict[int, np.ndarray], float] | None = None,
):
    """Rounds one after the other in one task, over the few rows that can change.

    Without ``bounds`` these are all rows. Otherwise ``bounds`` has the centres that margins are measured from, the sums of all
    rows by them, and the margin of the rows left out: a k goes on while its centres have moved by less. Gives
    rows (k, cluster, at_rest, rounds, x0, x1, ...).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, labels = [np.zeros((0, p))], [np.zeros((0, len(centres)), dtype=np.int32)]
        for batch in batches:
            for at, cell in enumerate(batch.column("x")):
                xs.append(np.frombuffer(cell.as_buffer()).reshape(-1, p))
                if bounds:
                    labels.append(np.frombuffer(batch.column("own")[at].as_buffer(), dtype=np.int32).reshape(-1, len(centres)))
        x = np.vstack(xs)
        for at, (k, now) in enumerate(centres.items()):
            fixed = np.zeros((len(now), 2 + p))
            if bounds:
                fixed += bounds[1][k]
                _add(fixed, np.vstack(labels)[:, at], x, -1.0)
            done, at_rest = 0, False
            while done < most and not at_rest and (not bounds or drift_limits(bounds[0][k], now).max() < bounds[2]):
                totals = fixed.copy()
                _add(totals, distances(x, now).argmin(axis=1), x)
                totals[:, 0] = np.round(totals[:, 0])
                moved = means_of(totals, now)
                done, at_rest, now = done + 1, bool(np.square(moved - now).sum() <= rest), moved
            arrays = [pa.array(np.full(len(now), k, dtype=np.int32)), pa.array(np.arange(len(now), dtype=np.int32))]
            arrays += [pa.array([at_rest] * len(now)), pa.array(np.full(len(now), done, dtype=np.int32)), *[pa.array(c) for c in now.T]]
            yield pa.RecordBatch.from_arrays(arrays, names=["k", "cluster", "at_rest", "rounds", *[f"x{i}" for i in range(p)]])

    return run
