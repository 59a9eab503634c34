"""Consistency checks: how often an amount is exactly zero, by category and by column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..functions.numbers import pct


def zero_rate_by_category(df: DataFrame, category: str, amount: str, listed: Sequence) -> DataFrame:
    """Per listed category its rows and the rows with ``amount`` exactly zero; categories without rows report 0."""
    is_zero = quoted(amount) == F.lit(0.0)
    aggregates = []
    for k, value in enumerate(listed):
        match = quoted(category) == F.lit(value)
        aggregates += [F.count_if(match).alias(f"t_{k}"), F.count_if(match & is_zero).alias(f"z_{k}")]
    entries = F.array(
        *[
            F.struct(F.lit(value).alias("category"), F.col(f"z_{k}").alias("zero_count"), F.col(f"t_{k}").alias("total_count"))
            for k, value in enumerate(listed)
        ]
    )
    return (
        df.agg(*aggregates)
        .select(F.inline(entries))
        .withColumn("percent", pct(F.col("zero_count"), F.col("total_count")))
    )


def zero_rate_by_column(
    df: DataFrame, category: str, listed: Sequence, amounts: Sequence[str], ranked: bool = True
) -> DataFrame:
    """Per listed category and amount column the exact zeros and their share of the category, largest share first (or,
    not ``ranked``, in the given order)."""
    aggregates = []
    for k, value in enumerate(listed):
        match = quoted(category) == F.lit(value)
        aggregates.append(F.count_if(match).alias(f"t_{k}"))
        aggregates += [F.count_if(match & (quoted(name) == F.lit(0.0))).alias(f"z_{k}_{i}") for i, name in enumerate(amounts)]
    entries = F.array(
        *[
            F.struct(
                F.lit(value).alias("category"),
                F.lit(name).alias("column_name"),
                F.col(f"z_{k}_{i}").alias("count"),
                pct(F.col(f"z_{k}_{i}"), F.col(f"t_{k}")).alias("percent"),
                F.lit(i).alias("column_index"),
            )
            for k, value in enumerate(listed)
            for i, name in enumerate(amounts)
        ]
    )
    return (
        df.where(quoted(category).isin(*listed))
        .agg(*aggregates)
        .select(F.inline(entries))
        .orderBy("category", *([F.desc("percent")] if ranked else []), "column_index")
        .drop("column_index")
    )
