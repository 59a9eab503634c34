"""Trips joined with the weather of their day, daily metrics and the impact sections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import minute_boundaries, same_day
from ..functions.numbers import round_scaled
from ..operators import daily, impact
from ..operators.daily import Metric
from ..operators.impact import Band, Comparison

# The three weather factors and their levels.
FACTORS = ("prcp", "avg_temp", "temp_range")
RAIN_BANDS = (
    Band("no_rain", "0", 0.0, exact=True),
    Band("light_rain", "(0, 0.5]", 0.5),
    Band("medium_rain", "(0.5, 1.5]", 1.5),
    Band("heavy_rain", "> 1.5", None),
)
TEMPERATURE_BANDS = (
    Band("very_cold_temp", "<= 0", 0.0),
    Band("cold_temp", "(0, 5]", 5.0),
    Band("cool_temp", "(5, 10]", 10.0),
    Band("mild_low_temp", "(10, 15]", 15.0),
    Band("mild_high_temp", "(15, 20]", 20.0),
    Band("warm_temp", "(20, 25]", 25.0),
    Band("hot_temp", "> 25", None),
)
RANGE_BANDS = (
    Band("low_range", "<= 5", 5.0),
    Band("medium_range", "(5, 10]", 10.0),
    Band("high_range", "(10, 15]", 15.0),
    Band("very_high_range", "> 15", None),
)
LEVELS = {
    "rain_level": ("prcp", RAIN_BANDS),
    "avg_temp_level": ("avg_temp", TEMPERATURE_BANDS),
    "temp_range_level": ("temp_range", RANGE_BANDS),
}
# The level each level section's differences refer to.
BASELINE_LEVELS = {"rain_level": "no_rain", "avg_temp_level": "mild_low_temp", "temp_range_level": "low_range"}

DRY = {"rain_status": "no_rain"}
WET = {"rain_status": "rain"}
DRY_LEVEL = {"rain_level": "no_rain"}
RAIN_COMPARISONS = (
    Comparison("rain_pct", "rain_status", WET, DRY),
    *[
        Comparison(f"{kind}_rain_pct", "rain_weekend", {"day_type": kind, **WET}, {"day_type": kind, **DRY})
        for kind in ("weekday", "weekend")
    ],
    *[
        Comparison(f"{level}_pct", "rain_level", {"rain_level": level}, DRY_LEVEL)
        for level in ("light_rain", "medium_rain", "heavy_rain")
    ],
)


def trip_metrics() -> list[Metric]:
    """The averaged amounts; minutes are whole numbers, the stored amounts are floats."""
    minutes = minute_boundaries(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    amounts = ("trip_distance", "fare_amount", "tip_amount", "total_amount")
    return [
        Metric("avg_duration_minutes", minutes),
        *[Metric(f"avg_{name}", F.col(name)) for name in amounts],
    ]


def weather_features(weather: DataFrame) -> DataFrame:
    """Mean temperature and range of days without snowfall and snow cover."""
    mean = (F.col("tmin") + F.col("tmax")) / F.lit(2.0)
    return weather.where((F.col("snow") == 0) & (F.col("snwd") == 0)).select(
        "date", "prcp", mean.cast("float").alias("avg_temp"), (F.col("tmax") - F.col("tmin")).alias("temp_range")
    )


def trip_features(trips: DataFrame) -> DataFrame:
    """Trips that end on the day they start, with that day."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return trips.where(same_day(pickup, dropoff)).select(
        F.to_date(pickup).alias("date"),
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "total_amount",
    )


def features(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """The ten feature columns: clean trips with the weather of their day."""
    return daily.join_daily(trip_features(trips), weather_features(weather))


@dataclass(frozen=True)
class ImpactTables:
    """The daily table and the sections built from it; ``totals`` is cached until ``release``."""

    totals: DataFrame
    daily: DataFrame
    sections: Mapping[str, DataFrame]
    summary: DataFrame

    def release(self) -> None:
        self.totals.unpersist()


Levels = Mapping[str, tuple[str, Sequence[Band]]]


def section(totals: DataFrame, metrics: Sequence[Metric], levels: Levels, name: str) -> DataFrame:
    """One section from the daily totals, unordered: ``rain_status``, ``rain_weekend`` or a level of ``levels``."""
    if name in levels:
        factor, bands = levels[name]
        return impact.level_impact(totals, metrics, factor, bands, name)
    build = {"rain_status": impact.status_impact, "rain_weekend": impact.day_type_impact}[name]
    return build(totals, metrics, levels["rain_level"][0])


def sections_of(totals: DataFrame, metrics: Sequence[Metric], levels: Levels) -> dict[str, DataFrame]:
    return {name: section(totals, metrics, levels, name) for name in ("rain_status", "rain_weekend", *levels)}


def report_values(found: DataFrame, names: Sequence[str], digits: int = 2) -> DataFrame:
    """A section with its metrics rounded as in the report, which the summary and differences start from."""
    return found.withColumns({name: round_scaled(F.col(name), digits) for name in names})


def metric_names(metrics: Sequence[Metric]) -> list[str]:
    return ["avg_trip_count", *[metric.name for metric in metrics]]


SUMMARISED = ("rain_status", "rain_weekend", "rain_level")


def summary_of(sections: Mapping[str, DataFrame], metrics: Sequence[Metric]) -> DataFrame:
    names = metric_names(metrics)
    rounded = {name: report_values(sections[name], names) for name in SUMMARISED}
    return impact.impact_summary(rounded, RAIN_COMPARISONS, names)


def impact_tables(totals: DataFrame, metrics: Sequence[Metric] | None = None) -> ImpactTables:
    """All impact tables from the daily totals, which have one row per day and are cached for the sections."""
    metrics = trip_metrics() if metrics is None else metrics
    totals = totals.persist(StorageLevel.MEMORY_AND_DISK)
    sections = sections_of(totals, metrics, LEVELS)
    ordered = {name: impact.in_report_order(found) for name, found in sections.items()}
    return ImpactTables(
        totals, daily.daily_metrics(totals, metrics, FACTORS), ordered, summary_of(sections, metrics)
    )


def feature_totals(featured: DataFrame) -> DataFrame:
    """Daily totals of a stored feature table."""
    return daily.daily_totals(featured, trip_metrics(), FACTORS)


def trip_totals(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """The same totals straight from clean trips and weather; trips are summed per day before they meet the weather."""
    return daily.joined_totals(trip_features(trips), weather_features(weather), trip_metrics(), FACTORS)


def level_differences(found: DataFrame, level_name: str, names: Sequence[str]) -> DataFrame:
    """Differences of each level from its section's baseline level."""
    baseline = F.col(level_name) == F.lit(BASELINE_LEVELS[level_name])
    return impact.diff_from_baseline(found, [level_name, "value_range"], names, baseline)


def status_differences(found: DataFrame, names: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Differences of wet from dry days, inside each day type where the section has one."""
    baseline = F.col("rain_status") == F.lit("no_rain")
    return impact.diff_from_baseline(found, [*within, "rain_status"], names, baseline, within)
