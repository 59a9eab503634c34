"""Outlier caps found from the data by trimming thin histogram tails in two passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..functions.numbers import clean_double, round_scaled
from .grid import CELLS, Grid, count_grids, exact_counts
from .histogram import Bins

# Fixed values of the trim: (bins, smallest share in percent a last bin must hold) for pass 1 and pass 2.
TRIM_PASSES = ((100, 0.05), (10, 0.5))

# Bounds that one more scan can settle for a column, where the grid leaves several open.
OPEN_STEPS = 64


@dataclass
class TrimState:
    """Progress and result of one column."""

    name: str
    max_value: float
    zero_count: int
    nonzero_rows: int
    upper: float
    pass_index: int = 0
    iterations: int = 0
    pass_values: list[float] = field(default_factory=list)
    bin_counts: list[int] = field(default_factory=list)

    @property
    def running(self) -> bool:
        return self.pass_index < len(TRIM_PASSES)

    @property
    def bins(self) -> Bins:
        return Bins(_printed(self.upper), TRIM_PASSES[self.pass_index][0])

    def after(self, counts: list[int]) -> TrimState:
        """The state that one more histogram leads to."""
        state = replace(self, pass_values=list(self.pass_values))
        state.advance(counts)
        return state

    def advance(self, counts: list[int]) -> None:
        """Apply one histogram: shrink the bound, or close the pass when the last bin is full enough."""
        bin_count, threshold = TRIM_PASSES[self.pass_index]
        self.iterations += 1
        self.bin_counts = counts
        shares = [count / self.nonzero_rows * 100 for count in counts] if self.nonzero_rows > 0 else None
        if shares is not None and shares[-1] < threshold:
            kept = next((i for i in reversed(range(bin_count)) if shares[i] >= threshold), 0)
            shrunk = (kept + 1) * (self.upper / bin_count)
            if abs(self.upper - shrunk) > 1e-12:
                self.upper = shrunk
                return
        self.pass_values.append(self.upper)
        self.pass_index += 1


def _printed(value: float) -> float:
    """The bound as its 16-decimal text reads, which is the form values are compared with."""
    return float(f"{value:.16f}") or value


def positive_max_zero_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: largest positive value (1.0 if none) and number of zeros, from one scan."""
    row = df.agg(*_max_and_zero(columns))
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.coalesce(F.col(f"max_{k}"), F.lit(1.0)).alias("max_value"),
                F.col(f"zero_{k}").alias("zero_count"),
            )
            for k, name in enumerate(columns)
        ]
    )
    return row.select(F.inline(entries))


def _max_and_zero(columns: Sequence[str]) -> list[Column]:
    aggregates = []
    for k, name in enumerate(columns):
        value = clean_double(quoted(name))
        aggregates += [F.max(F.when(value > 0, value)).alias(f"max_{k}"), F.count_if(value == 0).alias(f"zero_{k}")]
    return aggregates


def iterative_trim(
    df: DataFrame, columns: Sequence[str], derived: bool = False, cells: int = CELLS
) -> tuple[list[TrimState], int]:
    """Two-pass trim of all columns together; returns the states and the row count.

    One scan counts the values of all columns in fine cells (``cells`` for each doubling). Most steps are decided by the
    bounds which the cells put on every bin; a second scan reads the values in cells that an edge cuts, for all steps that
    are still open and for the final bins, whatever the number of steps. NULL and negative entries stay in the share's
    denominator. The columns of a ``derived`` input, which would be computed again, are cached until the end.
    """
    names = list(columns)
    values, held = [clean_double(quoted(name)) for name in names], None
    if derived:
        df = held = df.select(*[value.alias(name) for name, value in zip(names, values)]).persist(StorageLevel.MEMORY_AND_DISK)
        values = [quoted(name) for name in names]
    try:
        grids = count_grids(df, values, cells)
        total_rows = grids[0].row_count if grids else df.count()
        known: list[dict] = [{} for _ in names]
        while True:
            walks = [_walk(_start(name, grid), grid, exact) for name, grid, exact in zip(names, grids, known)]
            wanted = {c: open_ for c, (_, open_) in enumerate(walks) if open_}
            if not wanted:
                return [final for final, _ in walks], total_rows
            found = exact_counts(df, values, grids, {c: list(open_.values()) for c, open_ in wanted.items()}, cells)
            for c, open_ in wanted.items():
                known[c].update(zip(open_, found[c]))
    finally:
        if held is not None:
            held.unpersist()


def _start(name: str, grid: Grid) -> TrimState:
    max_value = grid.max_value or 1.0
    return TrimState(name, max_value, grid.zero_count, grid.row_count - grid.zero_count, max_value)


def _walk(start: TrimState, grid: Grid, known: Mapping[tuple, list[int]]) -> tuple[TrimState, dict[tuple, Bins]]:
    """The last state reached, and the steps whose counts must be known exactly before it is certain.

    Where the grid allows several outcomes of a step, all of them are followed, so that the steps behind them are asked for
    in the same scan.
    """
    waiting, seen, open_, last = [start], set(), {}, start
    while waiting and len(open_) < OPEN_STEPS:
        state = waiting.pop(0)
        last = state if not state.running else last
        step = (state.pass_index, state.upper)
        if not state.running or step in seen:
            continue
        seen.add(step)
        if step in known:
            waiting.append(state.after(known[step]))
            continue
        low, high = grid.bracket(state.bins)
        after = {(s.pass_index, s.upper): s for s in map(state.after, _outcomes(state, low, high))}
        if low != high and (len(after) > 1 or not all(s.running for s in after.values())):
            open_[step] = state.bins
        waiting += after.values()
    return last, open_


def _outcomes(state: TrimState, low: Sequence[int], high: Sequence[int]) -> list[list[int]]:
    """Bin counts within the bounds that stand for every way the step can end."""
    if state.nonzero_rows <= 0 or low == high:
        return [list(low)]
    threshold, found = TRIM_PASSES[state.pass_index][1], []
    for at in reversed(range(len(low))):
        if high[at] / state.nonzero_rows * 100 >= threshold:
            found.append([*low[:at], high[at], *low[at + 1 :]])
        if low[at] / state.nonzero_rows * 100 >= threshold:
            return found
    return [*found, list(low)]


def trim_table(spark, states: Sequence[TrimState]) -> DataFrame:
    """One row per column: maximum and the bounds after pass 1 and pass 2, unrounded."""
    rows = [(s.name, s.max_value, s.pass_values[0], s.pass_values[-1], s.zero_count) for s in states]
    return spark.createDataFrame(
        rows,
        "column_name string, max_value double, first_pass_value double, second_pass_value double, zero_count bigint",
    )


def upper_bound_bins(spark, states: Sequence[TrimState], total_rows: int) -> DataFrame:
    """The final bins of every column with their share of all rows."""
    rows = []
    for state in states:
        width = state.upper / len(state.bin_counts)
        for i, count in enumerate(state.bin_counts, start=1):
            share = count / total_rows * 100 if total_rows else 0.0
            rows.append((state.name, i, i * width, count, share))
    return spark.createDataFrame(
        rows, "column_name string, bucket int, bin_edge double, bin_count bigint, bin_percentage double"
    )


def upper_bounds(states: Sequence[TrimState], digits: int | None = 2) -> dict[str, float]:
    """The caps to filter with: the pass-2 bound rounded as in the report (rows just above may fall), or exact."""
    if digits is None:
        return {state.name: state.upper for state in states}
    return {state.name: float(f"{round(state.upper, digits):.12f}") for state in states}


def apply_upper_bounds(df: DataFrame, bounds: Mapping[str, float]) -> DataFrame:
    """Rows at or below every cap (NULL fails). The caps are literals, so the scan can push them down."""
    kept = df
    for name, bound in bounds.items():
        kept = kept.where(quoted(name) <= F.lit(bound))
    return kept


def rounded_trim_table(trimmed: DataFrame) -> DataFrame:
    """The report form of ``trim_table``: values at 2 decimals and the number of value ranges (bins and zero)."""
    return trimmed.select(
        "column_name",
        *[round_scaled(F.col(name)).alias(name) for name in ("max_value", "first_pass_value", "second_pass_value")],
        "zero_count",
        F.lit(TRIM_PASSES[-1][0] + 1).cast("bigint").alias("range_count"),
    )
