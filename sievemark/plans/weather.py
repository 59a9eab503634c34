"""Daily weather: row rules, metric units, narrow types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_scaled
from ..operators import rules
from ..operators.rules import Rule

# Fixed values of the weather model.
YEAR = 2019
ABSOLUTE_ZERO_FAHRENHEIT = -459.67
CENTIMETRES_PER_INCH = 2.54
INCH_COLUMNS = ("PRCP", "SNOW", "SNWD")
FAHRENHEIT_COLUMNS = ("TMIN", "TMAX")


def weather_rules(year: int = YEAR) -> list[Rule]:
    return [
        *rules.in_years("DATE", year, year, "date"),
        *[rules.at_least(name, 0) for name in INCH_COLUMNS],
        *[rules.above(name, ABSOLUTE_ZERO_FAHRENHEIT) for name in FAHRENHEIT_COLUMNS],
    ]


def centimetres(inches: Column) -> Column:
    return round_scaled(inches * F.lit(CENTIMETRES_PER_INCH))


def celsius(fahrenheit: Column) -> Column:
    return round_scaled((fahrenheit - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0))


def apply_business_rules(raw: DataFrame, year: int = YEAR) -> DataFrame:
    """Rows passing the rules, in centimetres and degrees Celsius at 2 decimals."""
    return rules.apply_rules(raw, weather_rules(year)).select(
        "DATE",
        *[centimetres(F.col(name)).alias(name) for name in INCH_COLUMNS],
        *[celsius(F.col(name)).alias(name) for name in FAHRENHEIT_COLUMNS],
    )


def clean(raw: DataFrame, year: int = YEAR) -> DataFrame:
    """Raw weather to clean weather: lower-case names, a date and five floats."""
    ruled = apply_business_rules(raw, year)
    amounts = [F.col(name).cast("float").alias(name.lower()) for name in (*INCH_COLUMNS, *FAHRENHEIT_COLUMNS)]
    return ruled.select(F.col("DATE").cast("date").alias("date"), *amounts)
