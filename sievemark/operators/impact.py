"""Impact tables: mean of daily means per status, day type and fixed level bands, and differences from a baseline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import day_type
from ..functions.numbers import diff_pct
from .daily import Metric, by_day_and, by_day_value, mean_of_days


@dataclass(frozen=True)
class Band:
    """A level up to and including ``upper`` (``None`` for the last one); ``exact`` matches only that value."""

    name: str
    label: str
    upper: float | None
    exact: bool = False


def _banded(value: Column, bands: Sequence[Band], entry) -> Column:
    chain = F
    for order, band in enumerate(bands, start=1):
        if band.upper is None:
            return chain.otherwise(F.lit(entry(order, band)))
        test = value == F.lit(band.upper) if band.exact else value <= F.lit(band.upper)
        chain = chain.when(test, F.lit(entry(order, band)))
    return chain


def wet_status(value: Column, wet: str = "rain", dry: str = "no_rain") -> Column:
    return F.when(value > 0, wet).otherwise(dry)


def status_impact(totals: DataFrame, metrics: Sequence[Metric], factor: str, day: str = "date") -> DataFrame:
    """By status of the factor (positive or not)."""
    status = wet_status(F.col(factor)).alias("rain_status")
    return mean_of_days(by_day_and(totals, metrics, [status], day), metrics, ["rain_status"])


def day_type_impact(totals: DataFrame, metrics: Sequence[Metric], factor: str, day: str = "date") -> DataFrame:
    """By day type and status."""
    keys = [wet_status(F.col(factor)).alias("rain_status"), day_type(F.col(day)).alias("day_type")]
    return mean_of_days(by_day_and(totals, metrics, keys, day), metrics, ["day_type", "rain_status"])


def level_impact(
    totals: DataFrame, metrics: Sequence[Metric], factor: str, bands: Sequence[Band], level_name: str, day: str = "date"
) -> DataFrame:
    """By fixed level of the day's mean factor."""
    value = F.col("factor_value")
    days = by_day_value(totals, metrics, factor, day).select(
        "*",
        _banded(value, bands, lambda order, band: band.name).alias(level_name),
        _banded(value, bands, lambda order, band: band.label).alias("value_range"),
        _banded(value, bands, lambda order, band: order).alias("level_order"),
    )
    return mean_of_days(days, metrics, [level_name, "value_range", "level_order"])


def in_report_order(section: DataFrame) -> DataFrame:
    """Levels in level order; weekdays before weekends and dry before wet."""
    if "level_order" in section.columns:
        return section.orderBy("level_order")
    dry_first = F.when(F.col("rain_status") == "no_rain", 1).otherwise(2)
    if "day_type" in section.columns:
        return section.orderBy(F.when(F.col("day_type") == "weekday", 1).otherwise(2), dry_first)
    return section.orderBy(dry_first)


def metric_rows(section: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Unpivot a section: one row per group and metric."""
    entries = F.array(
        *[
            F.struct(F.lit(k).alias("metric_order"), F.lit(name).alias("metric"), F.col(name).alias("value"))
            for k, name in enumerate(names)
        ]
    )
    return section.select(*keys, F.inline(entries))


@dataclass(frozen=True)
class Comparison:
    """A reported difference: the group to compare and its baseline, both as key values of one section."""

    name: str
    section: str
    group: Mapping[str, str]
    baseline: Mapping[str, str]


def impact_summary(
    sections: Mapping[str, DataFrame], comparisons: Sequence[Comparison], names: Sequence[str]
) -> DataFrame:
    """One row per metric with the percent difference of each comparison; NULL for a missing or zero baseline.

    The sections are unpivoted and united, then folded by conditional aggregation: no join.
    """
    keys = {key: None for item in comparisons for key in {**item.group, **item.baseline}}
    united = None
    for name, section in sections.items():
        rows = metric_rows(section, [key for key in keys if key in section.columns], names)
        rows = rows.withColumn("section", F.lit(name))
        united = rows if united is None else united.unionByName(rows, allowMissingColumns=True)

    def picked(item: Comparison, group: Mapping[str, str]) -> Column:
        test = F.col("section") == F.lit(item.section)
        for key, value in group.items():
            test = test & (F.col(key) == F.lit(value))
        return F.max(F.when(test, F.col("value")))

    differences = [
        _difference(picked(item, item.group), picked(item, item.baseline)).alias(item.name) for item in comparisons
    ]
    return united.groupBy("metric_order", "metric").agg(*differences).orderBy("metric_order").drop("metric_order")


def _difference(value: Column, baseline: Column) -> Column:
    return F.when(baseline != 0, (value - baseline) / baseline * F.lit(100.0))


def diff_from_baseline(
    section: DataFrame, keys: Sequence[str], names: Sequence[str], baseline: Column, within: Sequence[str] = ()
) -> DataFrame:
    """Every group's difference from the baseline group (of the same ``within`` values), per metric.

    The baseline value is spread over the groups of its metric by a window; a section has a handful of groups.
    """
    rows = metric_rows(section.withColumn("is_baseline", baseline), [*keys, "is_baseline"], names)
    over = Window.partitionBy("metric", *within)
    reference = F.max(F.when(F.col("is_baseline"), F.col("value"))).over(over)
    return rows.withColumn("baseline_value", reference).select(
        *keys, "metric", "value", diff_pct(F.col("value"), F.col("baseline_value")).alias("diff_from_baseline")
    )
