"""Exact order statistics of many columns without holding a column in one place.

The built-in exact percentile keeps every distinct value of a column in one
buffer. That is the fast way while the row count is small; beyond it the wanted
ranks of all columns are bracketed with mergeable sketches, the brackets are counted exactly, and
the step repeats inside them until the values are pinned down.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohorts.functions.columns import double_sql, number

# Cells of all columns together up to which the built-in percentile, one buffer per column in one task, is used.
DIRECT_ROWS = 4_000_000
GATHER_ROWS = 50_000
# Size of a sketch: ranks are off by about 0.25 %.
SKETCH = 2048


@dataclass
class _Bracket:
    """``inside`` rows of a column lie strictly between ``low`` and ``high``, ``below`` rows under them; the wanted ranks among them."""

    column: str
    ranks: list[int]
    inside: int
    low: float | None = None
    high: float | None = None
    below: int = 0

    def cells(self, value: str) -> str:
        """SQL text of the column where it lies in the bracket."""
        bounds = [f"{value} > {number(self.low)}"] if self.low is not None else []
        bounds += [f"{value} < {number(self.high)}"] if self.high is not None else []
        return f"case when {' and '.join(bounds)} then {value} end" if bounds else value

    def shares(self, margin: float) -> list[float]:
        """Shares on either side of each rank; ranks next to each other have the same ones."""
        middles = sorted({round((r - self.below + 0.5) / self.inside / margin) * margin for r in self.ranks})
        return sorted({min(1.0, max(0.0, m + side)) for m in middles for side in (-2 * margin, 2 * margin)})

    def split(self, cuts: list[float], under: list[int], up_to: list[int], values: dict[tuple[str, int], float]) -> list[_Bracket]:
        """Brackets between the cuts that hold ranks, by exact counts of rows under and up to each cut; ranks on a cut are found."""
        parts: dict[int, _Bracket] = {}
        starts = [0, *up_to]
        for r in self.ranks:
            place = bisect_right(up_to, r - self.below)
            if place < len(cuts) and under[place] <= r - self.below:
                values[self.column, r] = cuts[place]
                continue
            if place not in parts:
                end = under[place] if place < len(cuts) else self.inside
                parts[place] = _Bracket(
                    self.column, [], end - starts[place], cuts[place - 1] if place else self.low,
                    cuts[place] if place < len(cuts) else self.high, self.below + starts[place],
                )
            parts[place].ranks.append(r)
        return list(parts.values())


def values_at(
    df: DataFrame, ranks: dict[str, list[int]], counts: dict[str, int], gather_rows: int = GATHER_ROWS, sketch: int = SKETCH
) -> tuple[dict[tuple[str, int], float], int]:
    """The values of the wanted ranks (from 0) of every column, and the passes over ``df`` that took.

    A pass gathers the brackets of at most ``gather_rows`` rows and sketches the others, one mergeable sketch a bracket
    whatever the number of its ranks; another counts, for all brackets at once, the rows under and up to every cut
    that the sketches gave. Counts are exact, so a poor sketch costs a round and never a wrong value.
    """
    margin = 2.3 / sketch**0.9
    values: dict[tuple[str, int], float] = {}
    cell = {c: double_sql(df, c) for c in ranks}
    open_brackets = [_Bracket(c, sorted(set(r)), counts[c]) for c, r in ranks.items() if r]
    passes = 0
    while open_brackets:
        wanted = []
        for i, b in enumerate(open_brackets):
            inside = b.cells(cell[b.column])
            if b.inside <= gather_rows:
                places = ", ".join(str(r - b.below) for r in b.ranks)
                wanted.append(f"transform(array(sort_array(collect_list({inside}))), x -> transform(array({places}), i -> x[i]))[0] as v{i}")
            else:
                shares = ", ".join(map(number, b.shares(margin)))
                wanted.append(f"kll_sketch_get_quantile_double(kll_sketch_agg_double({inside}, {sketch}), array({shares})) as v{i}")
        row = df.selectExpr(*wanted).first()
        passes += 1
        cuts: dict[int, list[float]] = {}
        for i, b in enumerate(open_brackets):
            if b.inside <= gather_rows:
                values.update({(b.column, r): v for r, v in zip(b.ranks, row[f"v{i}"])})
            else:
                cuts[i] = sorted(set(row[f"v{i}"]))
        if not cuts:
            break
        bands = [
            f"count_if({cell[open_brackets[i].column]} {sign} {number(c)}) as {name}{i}_{j}"
            for i, found in cuts.items() for j, c in enumerate(found) for sign, name in (("<", "u"), ("<=", "t"))
        ]
        row = df.selectExpr(*bands).first()
        passes += 1
        narrower = []
        for i, found in cuts.items():
            b = open_brackets[i]
            under, up_to = ([row[f"{name}{i}_{j}"] - b.below for j in range(len(found))] for name in "ut")
            narrower += b.split(found, under, up_to, values)
        open_brackets = narrower
    return values, passes


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    counts: dict[str, int] | None = None,
    direct_rows: int = DIRECT_ROWS,
    gather_rows: int = GATHER_ROWS,
    sketch: int = SKETCH,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, ignoring missing values.

    ``counts`` are the non-missing counts per column where the caller has them.
    The result has one number per column and probability.
    """
    if counts is None:
        row = df.selectExpr(*[f"count({double_sql(df, c)}) as n{i}" for i, c in enumerate(columns)]).first()
        counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    if sum(counts[c] for c in columns) <= direct_rows:
        shares = f"array({', '.join(map(number, probs))})"
        row = df.selectExpr(
            *[f"percentile({double_sql(df, c)}, {shares}) as q{i}" for i, c in enumerate(columns)]
        ).first()
        return {c: list(row[f"q{i}"] or [None] * len(probs)) for i, c in enumerate(columns)}

    wanted: dict[tuple[str, float], tuple[int, int, float]] = {}
    ranks: dict[str, list[int]] = {}
    for c in columns:
        n = counts[c]
        for p in probs if n else []:
            position = p * (n - 1)
            first = math.floor(position)
            wanted[c, p] = first, min(first + 1, n - 1), position - first
            ranks.setdefault(c, []).extend(wanted[c, p][:2])
    values, _ = values_at(df, ranks, counts, gather_rows, sketch)

    def pick(c: str, p: float) -> float | None:
        if (c, p) not in wanted:
            return None
        first, second, part = wanted[c, p]
        a, b = values[c, first], values[c, second]
        return a if part == 0 or a == b else a + (b - a) * part

    return {c: [pick(c, p) for p in probs] for c in columns}
