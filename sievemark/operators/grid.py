"""Counts of positive values in fine cells, which bracket any equal-width histogram of them without another scan.

A cell takes values whose logarithms are alike; it knows how many values it holds, the least and the greatest. Where both
ends of a cell fall into one bin, all its values do. Only cells that an edge cuts leave a doubt, and the values of those
alone have to be read again if the doubt matters.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .histogram import Bins
from .longform import stack_columns

CELLS = 1024  # for each doubling of a value; a column of money has some ten thousand
_ZERO, _NEGATIVE, _NONE = -(1 << 62), -(1 << 62) - 1, -(1 << 62) - 2


def cell_of(value: Column, cells: int) -> Column:
    """Number of a value's cell; zeros, negative values and missing ones have one each."""
    positive = F.floor(F.ln(value) * (cells / math.log(2)))
    return F.when(value > 0, positive).when(value == 0, _ZERO).when(value < 0, _NEGATIVE).otherwise(_NONE)


@dataclass(frozen=True)
class Grid:
    """Cells of one column, ascending: number, values, least and greatest value."""

    row_count: int
    zero_count: int
    negative_count: int
    lowest: float | None  # of all values, negative ones too
    highest: float | None
    cell: np.ndarray
    held: np.ndarray
    least: np.ndarray
    greatest: np.ndarray

    @property
    def max_value(self) -> float | None:
        """Greatest positive value."""
        return float(self.greatest.max()) if len(self.greatest) else None

    @property
    def positive_count(self) -> int:
        return int(self.held.sum())

    def around(self, rank: int) -> tuple[float | None, int, int, float | None, float | None]:
        """What is known of the positive value of this rank, from 0: the value itself if certain; values in its cell and before
        it; and the next values on both sides of the cell."""
        ends = np.cumsum(self.held)
        at = int(np.searchsorted(ends, rank, side="right"))
        before, held = int(ends[at] - self.held[at]), int(self.held[at])
        low, high = float(self.least[at]), float(self.greatest[at])
        value = low if low == high or rank == before else high if rank == ends[at] - 1 else None
        below = float(self.greatest[at - 1]) if at else None
        above = float(self.least[at + 1]) if at + 1 < len(self.held) else None
        return value, held, before, below, above

    @property
    def in_order(self) -> bool:
        """Whether no value of a cell lies beyond one of the next cell, which rounding of logarithms could in theory bring about."""
        return bool((self.greatest[:-1] < self.least[1:]).all())

    def _bins_of(self, spec: Bins) -> tuple[np.ndarray, np.ndarray]:
        """Zero-based bin of the least and the greatest value of each cell; what lies above the range has bin ``count``."""

        def of(value: np.ndarray) -> np.ndarray:
            with np.errstate(invalid="ignore", over="ignore"):
                index = np.clip(np.nan_to_num(np.ceil(value / spec.upper * spec.count), nan=1), 1, spec.count)
            return np.where(value <= spec.upper, index - 1, spec.count).astype(np.int64)

        return of(self.least), of(self.greatest)

    def cut(self, spec: Bins) -> np.ndarray:
        """Which cells an edge of the bins cuts."""
        low, high = self._bins_of(spec)
        return low != high

    def whole(self, spec: Bins, among: np.ndarray) -> np.ndarray:
        """Values in each bin from those of the marked cells that no edge cuts."""
        low, high = self._bins_of(spec)
        counts = np.zeros(spec.count + 1, dtype=np.int64)
        np.add.at(counts, low[among & (low == high)], self.held[among & (low == high)])
        return counts[: spec.count]

    def bracket(self, spec: Bins) -> tuple[list[int], list[int]]:
        """Least and greatest number of values that each bin can hold."""
        low, high = self._bins_of(spec)
        doubt = low != high
        steps = np.zeros(spec.count + 2, dtype=np.int64)
        np.add.at(steps, low[doubt], self.held[doubt])
        np.add.at(steps, high[doubt] + 1, -self.held[doubt])
        sure = self.whole(spec, ~doubt)
        return sure.tolist(), (sure + np.cumsum(steps)[: spec.count]).tolist()


def count_grids(df: DataFrame, columns: Sequence[Column], cells: int = CELLS) -> list[Grid]:
    """Grids of same-typed columns from one scan; cells are partial sums, so the shuffle carries at most a row for each
    cell and input partition."""
    pairs = [part for c, column in enumerate(columns) for part in (F.lit(c), column)]
    stacked = df.select(F.stack(F.lit(len(columns)), *pairs).alias("c", "v"))
    counted = stacked.groupBy("c", cell_of(F.col("v"), cells).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("greatest")
    )
    return grids_from(counted.toArrow().to_pydict(), len(columns))


def grids_from(found: Mapping[str, list], count: int) -> list[Grid]:
    """Grids from their counted cells (c, cell, n, least, greatest)."""
    table = {name: np.array(found[name], dtype=np.int64) for name in ("c", "cell", "n")}
    ends = {name: np.array([np.nan if v is None else v for v in found[name]], dtype=float) for name in ("least", "greatest")}
    grids = []
    for c in range(count):
        own = table["c"] == c
        cell, n = table["cell"][own], table["n"][own]
        least, greatest = ends["least"][own], ends["greatest"][own]
        some, valued = np.flatnonzero(cell > _ZERO), cell > _NONE
        some = some[np.argsort(cell[some])]
        lowest, highest = (float(least[valued].min()), float(greatest[valued].max())) if valued.any() else (None, None)
        sizes = [int(n[cell == special].sum()) for special in (_ZERO, _NEGATIVE)]
        grids.append(Grid(int(n.sum()), *sizes, lowest, highest, cell[some], n[some], least[some], greatest[some]))
    return grids


def bin_starts(spec: Bins) -> np.ndarray:
    """Least value that ``bin_index`` puts into each bin, and the least above the range; infinity where there is none.

    The index never falls as a value rises, rounding included, so its steps are found by halving among all doubles: the bit
    patterns of positive ones are in their order.
    """
    top = np.float64(max(spec.upper, 0.0)).view(np.int64)
    before = np.arange(spec.count + 1, dtype=float)
    low, high = np.zeros(spec.count + 1, dtype=np.int64), np.full(spec.count + 1, top + 1)
    low[-1] = top
    with np.errstate(invalid="ignore", over="ignore"):
        while (high - low > 1).any():
            middle = low + (high - low) // 2
            reached = middle.view(float) / spec.upper * spec.count > before
            low, high = np.where(reached, low, middle), np.where(reached, middle, high)
    starts = high.view(float)
    starts[0] = 0.0
    return np.where(np.isnan(starts), np.inf, starts)


def exact_counts(
    df: DataFrame, columns: Sequence[Column], grids: Sequence[Grid], wanted: Mapping[int, Sequence[Bins]], cells: int = CELLS
) -> dict[int, list[list[int]]]:
    """Counts of the wanted histograms of each column: whole cells are known, and one scan reads the values of the others.

    A value is looked up once among the edges of all histograms of its column, so a row costs the same however many they are.
    """
    result: dict[int, list[list[int]]] = {}
    read, starts, splits = [], {}, {}
    for c, specs in wanted.items():
        fetched = np.zeros(len(grids[c].cell), dtype=bool)
        for spec in specs:
            fetched |= grids[c].cut(spec)
        result[c] = [grids[c].whole(spec, ~fetched).tolist() for spec in specs]
        starts[c] = [bin_starts(spec) for spec in specs]
        splits[c] = np.unique(np.concatenate([*starts[c], [-np.inf, np.inf]]))
        value = columns[c].cast("double")
        inside = (value > 0) & (value <= F.lit(max(spec.upper for spec in specs)))
        inside &= cell_of(value, cells).isin([int(number) for number in grids[c].cell[fetched]])
        read.append(F.when(inside, value).alias(f"v{c}"))
    placed = Bucketizer(
        splitsArray=[edges.tolist() for edges in splits.values()],
        inputCols=[f"v{c}" for c in wanted],
        outputCols=[f"piece{c}" for c in wanted],
        handleInvalid="keep",
    ).transform(df.select(*read))
    pieces = [F.when(F.col(f"v{c}").isNotNull(), F.col(f"piece{c}").cast("int")) for c in wanted]
    counted = stack_columns(placed, pieces, "piece").groupBy("c", "piece").agg(F.count(F.lit(1)).alias("n"))
    found = {name: np.array(part, dtype=np.int64) for name, part in counted.toArrow().to_pydict().items()}
    for at, c in enumerate(wanted):
        own = found["c"] == at
        edge, n = splits[c][found["piece"][own]], found["n"][own]
        for spec, begins, counts in zip(wanted[c], starts[c], result[c]):
            sums = np.zeros(spec.count + 1, dtype=np.int64)
            np.add.at(sums, np.searchsorted(begins, edge, side="right") - 1, n)
            counts[:] = (np.array(counts) + sums[: spec.count]).tolist()
    return result
