"""Exact continuous quantiles without gathering a column in one task.

A quantile needs two neighbouring order statistics. Each round sketches the open value interval known to hold them,
takes two data values that bracket the wanted ranks, and counts the rows around these exactly. The counts decide
where the ranks are, so a poor sketch costs a round and never the result. Every round removes the bracketing values
themselves from the search, so heavy repeated values end it at once. When the interval holds few rows they are ranked
directly.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grid import Grid
from .longform import lookup, stack_columns

# Rows ranked directly; also the bound on the size of a window partition below.
DIRECT_ROWS = 250_000
SKETCH_ACCURACY = 10_000


@dataclass(frozen=True)
class _Search:
    """Ranks still wanted among the ``size`` values of ``name`` inside the open interval (low, high)."""

    name: str
    low: float | None
    high: float | None
    size: int
    ranks: tuple[tuple[int, int], ...]  # (rank inside the interval, rank in the column)

    def inside(self, value: Column) -> Column:
        kept = value.isNotNull()
        if self.low is not None:
            kept = kept & (value > F.lit(self.low))
        if self.high is not None:
            kept = kept & (value < F.lit(self.high))
        return F.when(kept, value)


def exact_quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    p: float,
    counts: Mapping[str, int],
    direct_rows: int = DIRECT_ROWS,
    accuracy: int = SKETCH_ACCURACY,
    grids: Mapping[str, Grid] | None = None,
) -> dict[str, float | None]:
    """Linearly interpolated quantile ``p`` of each value column (NULL entries are left out).

    ``counts`` are the non-NULL entries per column. All columns share each scan. ``grids`` of the columns, whose values are
    all positive, say in which cell a rank lies, so that the search begins there.
    """
    found: dict[tuple[str, int], float] = {}
    pending = []
    for name, size in counts.items():
        if size:
            position = (size - 1) * p
            ranks = sorted({math.floor(position), math.ceil(position)})
            grid = grids.get(name) if grids else None
            pending += _inside_cells(name, grid, ranks, found) if grid and grid.in_order else [_Search(name, None, None, size, tuple((rank, rank) for rank in ranks))]
    while pending:
        small = [search for search in pending if search.size <= direct_rows]
        large = [search for search in pending if search.size > direct_rows]
        if small:
            found.update(_rank_directly(df, values, small))
        if large:
            pending = _narrow(df, values, large, _sketched(df, values, large, accuracy), found)
        else:
            pending = []

    result: dict[str, float | None] = {}
    for name, size in counts.items():
        if not size:
            result[name] = None
            continue
        position = (size - 1) * p
        low, high = found[name, math.floor(position)], found[name, math.ceil(position)]
        result[name] = _interpolate(low, high, position - math.floor(position))
    return result


def _inside_cells(name: str, grid: Grid, ranks: Sequence[int], found: dict[tuple[str, int], float]) -> list[_Search]:
    """Ranks that the grid knows are found; the others are wanted in their cells."""
    parts: dict[tuple, list] = {}
    for rank in ranks:
        value, held, before, below, above = grid.around(rank)
        if value is not None:
            found[name, rank] = value
        else:
            parts.setdefault((below, above, held), []).append((rank - before, rank))
    return [_Search(name, *cell, tuple(wanted)) for cell, wanted in parts.items()]


def _interpolate(low: float, high: float, fraction: float) -> float:
    """Weighted mean of two neighbours; equal neighbours, or a rank without fraction, give exactly their value."""
    if low == high or fraction == 0:
        return low
    return low * (1 - fraction) + high * fraction


def _rank_directly(df, values, searches) -> dict[tuple[str, int], float]:
    columns = [search.inside(values[search.name]) for search in searches]
    frequencies = stack_columns(df, columns).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("c").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    first = lookup([search.ranks[0][0] for search in searches], F.col("c"), "bigint")
    last = lookup([search.ranks[-1][0] for search in searches], F.col("c"), "bigint")
    hits = (
        frequencies.withColumn("upto", upto)
        .where((F.col("upto") > first) & (F.col("upto") - F.col("n") <= last))
        .select("c", "v", "n", "upto")
        .collect()
    )
    found = {}
    for row in hits:
        search = searches[row.c]
        for rank, absolute in search.ranks:
            if row.upto - row.n <= rank < row.upto:
                found[search.name, absolute] = row.v
    return found


def _sketched(df, values, searches, accuracy) -> dict[str, Sequence[float]]:
    """Two values around the wanted ranks of each search."""
    sketches = []
    for k, search in enumerate(searches):
        slack = 2 * search.size / accuracy + 1
        low = max(0.0, (search.ranks[0][0] - slack) / search.size)
        high = min(1.0, (search.ranks[-1][0] + 1 + slack) / search.size)
        sketches.append(F.percentile_approx(search.inside(values[search.name]), [low, high], accuracy).alias(f"q_{k}"))
    row = df.agg(*sketches).first()
    return {k: row[f"q_{k}"] for k in range(len(searches))}


def _narrow(df, values, searches, known, found) -> list[_Search]:
    brackets = {f"q_{k}": known[k] for k in range(len(searches))}
    counters = []
    for k, search in enumerate(searches):
        low, high = brackets[f"q_{k}"]
        value = search.inside(values[search.name])
        between = F.when((value > low) & (value < high), value)
        counters += [
            F.count_if(value < low).alias(f"below_{k}"),
            F.count_if(value == low).alias(f"low_{k}"),
            F.count(between).alias(f"between_{k}"),
            F.count_if((value == high) & F.lit(low != high)).alias(f"high_{k}"),
            F.min(between).alias(f"min_{k}"),
            F.max(between).alias(f"max_{k}"),
        ]
    row = df.agg(*counters).first()

    remaining = []
    for k, search in enumerate(searches):
        low, high = brackets[f"q_{k}"]
        below, at_low, between, at_high = (row[f"{part}_{k}"] for part in ("below", "low", "between", "high"))
        start_between, start_high = below + at_low, below + at_low + between
        start_above = start_high + at_high
        parts: dict[tuple, list] = {}
        for rank, absolute in search.ranks:
            if rank < below:
                parts.setdefault((search.low, low, below), []).append((rank, absolute))
            elif rank < start_between:
                found[search.name, absolute] = low
            elif rank < start_high:
                inner = rank - start_between
                if inner == 0:
                    found[search.name, absolute] = row[f"min_{k}"]
                elif inner == between - 1:
                    found[search.name, absolute] = row[f"max_{k}"]
                else:
                    parts.setdefault((low, high, between), []).append((inner, absolute))
            elif rank < start_above:
                found[search.name, absolute] = high
            else:
                parts.setdefault((high, search.high, search.size - start_above), []).append((rank - start_above, absolute))
        remaining += [_Search(search.name, *bounds, tuple(ranks)) for bounds, ranks in parts.items()]
    return remaining
