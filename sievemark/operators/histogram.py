"""Equal-width histograms on (0, upper] with right-closed bins.

A value on an inner edge belongs to the bin it closes, which is why the bin index is a ceiling and not
``width_bucket`` (left-closed).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..functions.numbers import pct
from .longform import lookup


@dataclass(frozen=True)
class Bins:
    """``count`` right-closed bins of equal width on (0, upper]."""

    upper: float
    count: int


def bin_index(value: Column, upper: Column, count: Column) -> Column:
    """One-based bin of a value in (0, upper]."""
    return F.least(count, F.greatest(F.lit(1), F.ceil(value / upper * count).cast("int")))


def bin_edge(index: Column, upper: Column, count: Column) -> Column:
    """Right edge of a bin; the left edge is the one of ``index - 1``."""
    return index * (upper / count)


def _zero_rows(df: DataFrame, bins: Sequence[Bins]) -> DataFrame:
    """Weight-0 rows for every bin and for the bin above the range, so that empty bins are reported."""
    width = max(spec.count for spec in bins) + 1
    ids = df.sparkSession.range(0, len(bins) * width, 1, 1)
    return ids.select(
        F.floor(F.col("id") / width).cast("int").alias("c"),
        (F.col("id") % width + 1).cast("int").alias("bucket"),
        F.lit(0).cast("bigint").alias("w"),
    ).where(F.col("bucket") <= lookup([spec.count + 1 for spec in bins], F.col("c"), "int"))


def label_bins(counts: DataFrame, names: Sequence[str], bins: Sequence[Bins], total_rows: Column) -> DataFrame:
    """Name and edge rows of counted bins (c, bucket, n), without the bin ``count + 1``, which is above the range."""
    upper = lookup([spec.upper for spec in bins], F.col("c"), "double")
    count = lookup([spec.count for spec in bins], F.col("c"), "int")
    return counts.where(F.col("bucket") <= count).select(
        lookup(names, F.col("c"), "string").alias("column_name"),
        "bucket",
        bin_edge(F.col("bucket"), upper, count).alias("bin_edge"),
        F.col("n").alias("bin_count"),
        pct(F.col("n"), total_rows).alias("bin_percentage"),
    )


def histogram(df: DataFrame, column: str, spec: Bins) -> DataFrame:
    """Histogram of one column with empty bins; percentages are of all rows.

    Rows outside the bins are counted in the same scan (bin 0), which gives the total without a second one. A range
    that is empty (``upper <= 0``) has only empty bins.
    """
    value = quoted(column).cast("double")
    inside = ~F.isnan(value) & (value > 0) & (value <= F.lit(spec.upper))
    index = F.when(inside, bin_index(value, F.lit(spec.upper), F.lit(spec.count))).otherwise(0)
    rows = df.select(F.lit(0).alias("c"), index.alias("bucket"), F.lit(1).cast("bigint").alias("w"))
    counts = rows.unionByName(_zero_rows(df, [spec])).groupBy("c", "bucket").agg(F.sum("w").alias("n"))
    totals = counts.withColumn("total_rows", F.sum("n").over(Window.partitionBy("c")))
    return label_bins(totals.where(F.col("bucket") > 0), [column], [spec], F.col("total_rows"))
