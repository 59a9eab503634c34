import math
import random

import pytest
from pyspark.sql import functions as F

from sievemark.operators import bounds, grid
from sievemark.operators.histogram import Bins


def brute_trim(values):
    """The trim on a plain list, written independently of the operator."""
    clean = [v for v in values if v is not None and v == v]
    positive = [v for v in clean if v > 0]
    nonzero = len(values) - sum(v == 0 for v in clean)
    upper = max(positive, default=1.0) or 1.0
    ends = []
    for bins, threshold in ((100, 0.05), (10, 0.5)):
        for _ in range(1000):
            counts = [0] * bins
            for v in positive:
                if v <= upper:
                    index = -int(-(v / upper * bins) // 1)
                    counts[min(bins, max(1, index)) - 1] += 1
            if nonzero <= 0 or counts[-1] / nonzero * 100 >= threshold:
                break
            full = [i for i, n in enumerate(counts) if n / nonzero * 100 >= threshold]
            shrunk = ((full[-1] if full else 0) + 1) * (upper / bins)
            if abs(upper - shrunk) <= 1e-12:
                break
            upper = shrunk
        ends.append(upper)
    return ends[0], ends[1], counts


@pytest.mark.parametrize("cells", [1024, 3, 0.1])
def test_trim_matches_brute_force(spark, cells):
    """Fine cells, and coarse ones that leave every step open, on a long tail, cents, zeros, negatives and missing entries together."""
    rng = random.Random(3)
    tail = [rng.lognormvariate(1, 1.5) for _ in range(3000)]
    cents = [round(abs(rng.gauss(10, 4)), 2) if i % 3 else 0.0 for i in range(3000)]
    mixed = [None if i % 7 == 0 else -1.0 if i % 11 == 0 else rng.choice([1.5, 2.5, 400.0 if i % 500 == 3 else 3.0]) for i in range(3000)]
    df = spark.createDataFrame(list(zip(tail, cents, mixed)), "tail double, cents double, mixed double")
    states, total = bounds.iterative_trim(df, ["tail", "cents", "mixed"], cells=cells)
    assert total == 3000
    for state, values in zip(states, (tail, cents, mixed)):
        first, second, counts = brute_trim(values)
        assert (state.pass_values[0], state.upper, state.bin_counts) == (first, second, counts), state.name


def test_many_steps_take_two_scans(spark, monkeypatch):
    """A tail that shrinks step by step; the grid decides the steps and the values are read once more at most twice."""
    values = [(1 - k / 4001) ** -1.2 * 3.0 for k in range(4000)] + [10.0**k for k in range(2, 9)]
    scans = []
    for name in ("count_grids", "exact_counts"):
        whole = getattr(bounds, name)
        monkeypatch.setattr(bounds, name, lambda *args, whole=whole: scans.append(1) or whole(*args))
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    (state,), _ = bounds.iterative_trim(df, ["v"])
    assert (state.pass_values[0], state.upper, state.bin_counts) == brute_trim(values)
    assert state.iterations >= 8 and len(scans) <= 3


def counted(values, spec):
    """Bins of a plain list, by the formula of ``bin_index``."""
    counts = [0] * spec.count
    for v in values:
        if v is not None and 0 < v <= spec.upper:
            share = v / spec.upper * spec.count
            counts[max(1, 1 if math.isnan(share) else math.ceil(share)) - 1] += 1
    return counts


def test_open_histograms_do_not_multiply_rows(spark, monkeypatch):
    """Many histograms of two columns in one scan: each value is placed once, on bin edges and next to them too."""
    rng = random.Random(5)
    specs = [Bins(rng.uniform(0.5, 60.0), rng.choice([10, 100])) for _ in range(40)] + [Bins(50.0, 100), Bins(0.3, 10)]
    edges = [k * (spec.upper / spec.count) for spec in specs[-6:] for k in range(1, spec.count + 1)]
    first = [v for edge in edges for v in (edge, math.nextafter(edge, 0), math.nextafter(edge, 99))] + [0.0, -1.0, None, 5e-324]
    second = [rng.choice([None, 0.1 * k, 2.5]) for k in range(len(first))]
    df = spark.createDataFrame(list(zip(first, second)), "a double, b double").repartition(2)
    columns, rows = [F.col("a"), F.col("b")], []
    grids = grid.count_grids(df, columns, 1)
    whole = grid.stack_columns

    def stacked(*args, **settings):
        rows.append(whole(*args, **settings).count())
        return whole(*args, **settings)

    monkeypatch.setattr(grid, "stack_columns", stacked)
    found = grid.exact_counts(df, columns, grids, {0: specs, 1: specs[::-1]}, 1)
    assert found == {0: [counted(first, spec) for spec in specs], 1: [counted(second, spec) for spec in specs[::-1]]}
    assert sum(rows) <= 2 * len(first)


def test_histograms_of_extreme_values(spark):
    values = [5e-324, 1e-320, 1e-300, 1.0, 3.0, 1e300, 1.7976931348623157e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    grids = grid.count_grids(df, [F.col("v")], 0.01)
    for upper in (5e-324, 1e-320, 3.0, 1e300, 1.7976931348623157e308, float("inf")):
        spec = Bins(upper, 10)
        assert grid.exact_counts(df, [F.col("v")], grids, {0: [spec]}, 0.01) == {0: [counted(values, spec)]}, upper


def test_trim_of_extreme_values(spark):
    values = [5e-324, 1e-300, 1e-9, 2.0, 3.0, 1e300, float("inf")]
    (state,), total = bounds.iterative_trim(spark.createDataFrame([(v,) for v in values[:-1]], "v double"), ["v"])
    assert (state.pass_values[0], state.upper, state.bin_counts) == brute_trim(values[:-1]) and total == 6
    (state,), _ = bounds.iterative_trim(spark.createDataFrame([(v,) for v in values], "v double"), ["v"])
    assert state.max_value == float("inf")


@pytest.mark.parametrize("values", [[0.0, 0.0, None], [-1.0, 0.0], [float("nan"), 0.0], [5.0], []])
def test_trim_without_a_usable_tail(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    states, _ = bounds.iterative_trim(df, ["v"])
    first, second, counts = brute_trim(values)
    assert (states[0].pass_values[0], states[0].upper, states[0].bin_counts) == (first, second, counts)


def test_no_bin_reaches_the_threshold(spark):
    """NULL entries stay in the denominator, so a few values spread over the bins are all below it."""
    values = [None] * 20_000 + [float(v) for v in range(1, 9)]
    states, _ = bounds.iterative_trim(spark.createDataFrame([(v,) for v in values], "v double"), ["v"])
    assert states[0].pass_values == list(brute_trim(values)[:2])


def test_fixture_bounds(spark):
    """Known bounds and iteration counts of the sf0.01 tables."""
    sf = "/root/testdata/sf0.01"
    (events,), _ = bounds.iterative_trim(spark.read.parquet(f"{sf}/events.parquet"), ["value"])
    assert (events.max_value, events.upper, events.iterations) == (490.02, 232.59877343999997, 5)
    (documents,), _ = bounds.iterative_trim(spark.read.parquet(f"{sf}/documents.parquet"), ["n_chars"])
    assert (documents.pass_values[0], documents.upper, documents.iterations) == (33047.0, 13384.035, 5)


def test_bounds_filter(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.001,), (None,)], "v double")
    assert bounds.apply_upper_bounds(df, {"v": 2.0}).count() == 2
    df.write.parquet(str(tmp_path / "t"))
    plan = bounds.apply_upper_bounds(spark.read.parquet(str(tmp_path / "t")), {"v": 2.0})._jdf.queryExecution().toString()
    assert "LessThanOrEqual(v,2.0)" in plan


def test_report_form(spark):
    states = [bounds.TrimState("v", 10.0, 3, 7, 4.5678, 2, 1, [5.4321, 4.5678], [1] * 10)]
    row = bounds.rounded_trim_table(bounds.trim_table(spark, states)).first()
    assert (row.first_pass_value, row.second_pass_value, row.range_count) == (5.43, 4.57, 11)
    assert bounds.upper_bounds(states) == {"v": 4.57}
    assert bounds.upper_bounds(states, None) == {"v": 4.5678}


def test_positive_max_and_zero_count(spark):
    df = spark.createDataFrame([(0.0, -1.0), (3.0, float("nan")), (None, 0.0)], "a double, b double")
    rows = [tuple(row) for row in bounds.positive_max_zero_count(df, ["a", "b"]).collect()]
    assert rows == [("a", 3.0, 1), ("b", 1.0, 1)]
