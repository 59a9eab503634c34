"""Daily side: joining facts with one row per day, and the daily totals every impact table is built from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A calendar of this many days spans more than 270 years; a daily table up to this size is broadcast.
BROADCAST_DAYS = 100_000


@dataclass(frozen=True)
class Metric:
    """A per-row amount averaged per day as ``name``; as in SQL, rows where it is NULL do not count."""

    name: str
    value: Column

    def sums(self) -> list[Column]:
        """The total and the number of values it rests on."""
        return [F.sum(self.value.cast("double")).alias(self.total), F.count(self.value).alias(self.held)]

    @property
    def total(self) -> str:
        return f"total_{self.name}"

    @property
    def held(self) -> str:
        return f"count_{self.name}"

    def mean(self) -> Column:
        return F.when(F.col(self.held) > 0, F.col(self.total) / F.col(self.held))


def sum_names(metrics: Sequence[Metric]) -> list[str]:
    """Columns of daily totals that add up."""
    return ["trip_count", *[name for metric in metrics for name in (metric.total, metric.held)]]


def join_daily(facts: DataFrame, daily: DataFrame, day: str = "date") -> DataFrame:
    """Inner join of facts with the rows of their day, as SQL joins them: facts on days without one disappear, and a day
    that stands there twice gives its facts twice.

    The daily side is computed once and read up to ``BROADCAST_DAYS`` rows; so few are broadcast, and facts are neither
    shuffled nor skewed by a heavy day. A longer one joins by shuffle, where adaptive execution splits a heavy day.
    """
    read = daily.limit(BROADCAST_DAYS + 1).toArrow()
    if read.num_rows > BROADCAST_DAYS:
        return facts.join(daily, day, "inner")
    local = daily.sparkSession.createDataFrame(read, daily.schema)
    return facts.join(F.broadcast(local), day, "inner")


def daily_totals(df: DataFrame, metrics: Sequence[Metric], factors: Sequence[str], day: str = "date") -> DataFrame:
    """Row count and metric totals per day and factor values: the one pass over the facts.

    Totals (not averages) let every later table regroup exactly. Partial sums are combined before the shuffle, so a
    day holding a third of all rows costs no more than another.
    """
    sums = [column for metric in metrics for column in metric.sums()]
    return df.groupBy(day, *factors).agg(F.count(F.lit(1)).alias("trip_count"), *sums)


def joined_totals(
    facts: DataFrame, daily: DataFrame, metrics: Sequence[Metric], factors: Sequence[str], day: str = "date"
) -> DataFrame:
    """``daily_totals`` of facts joined with their day, with the facts summed per day before the join.

    Facts meet the join as one row per day, so it is cheap whatever the size of either side. Days without a daily row
    disappear, and a day that stands there twice counts twice, as in the row-level join.
    """
    per_day = daily_totals(facts, metrics, (), day)
    joined = per_day.join(daily.select(day, *factors), day, "inner")
    return _regroup(joined, metrics, [F.col(name) for name in (day, *factors)])


def _regroup(totals: DataFrame, metrics: Sequence[Metric], keys: Sequence[Column]) -> DataFrame:
    return totals.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in sum_names(metrics)])


def daily_metrics(totals: DataFrame, metrics: Sequence[Metric], factors: Sequence[str], day: str = "date") -> DataFrame:
    """Per day: its factors, row count and averages, ordered by day."""
    means = [metric.mean().alias(metric.name) for metric in metrics]
    return totals.select(day, *factors, "trip_count", *means).orderBy(day)


def mean_of_days(days: DataFrame, metrics: Sequence[Metric], keys: Sequence[str]) -> DataFrame:
    """Second level: each day weighs the same, whatever its number of rows."""
    return days.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("day_count"),
        F.avg("trip_count").alias("avg_trip_count"),
        *[F.avg(metric.mean()).alias(metric.name) for metric in metrics],
    )


def by_day_and(totals: DataFrame, metrics: Sequence[Metric], keys: Sequence[Column], day: str = "date") -> DataFrame:
    return _regroup(totals, metrics, [F.col(day), *keys])


def by_day_value(totals: DataFrame, metrics: Sequence[Metric], factor: str, day: str = "date") -> DataFrame:
    """Totals per day with the day's row-weighted mean of a factor as ``factor_value``."""
    value = F.col(factor).cast("double")
    rows = F.when(value.isNotNull(), F.col("trip_count"))
    weighted = F.try_divide(F.sum(value * rows), F.sum(rows))
    return totals.groupBy(day).agg(
        F.when(F.min(value) == F.max(value), F.min(value)).otherwise(weighted).alias("factor_value"),
        *[F.sum(name).alias(name) for name in sum_names(metrics)],
    )
