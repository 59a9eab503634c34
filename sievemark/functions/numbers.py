"""Numeric column helpers. Each returns a Column built from JVM-side functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest value of the unsigned types that narrowing targets; Spark has no unsigned types, so each maps to the
# smallest signed type that holds the range.
UNSIGNED_RANGES = {8: (255, "smallint"), 16: (65535, "int"), 32: (4294967295, "bigint")}

INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}

# Any text that parses as a number starts like this (digits, a point, infinity or NaN, after blanks and a sign).
NUMBER_START = r"^[\x00-\x20]*[+-]?[0-9.iInN]"


def round_scaled(value: Column, digits: int = 2) -> Column:
    """Round a double half away from zero on the scaled value (1.005 -> 1.0 at 2 digits)."""
    scale = F.lit(float(10**digits))
    return F.round(value.cast("double") * scale) / scale


def pct(part: Column, total: Column) -> Column:
    """Share of ``total`` in percent, 0.0 for an empty total."""
    ratio = part.cast("double") / F.nullif(total.cast("double"), F.lit(0.0)) * F.lit(100.0)
    return F.coalesce(ratio, F.lit(0.0))


def diff_pct(value: Column, baseline: Column) -> Column:
    """Percent difference from a baseline; NULL where the baseline is missing or practically zero."""
    return F.when(F.abs(baseline) >= 1e-12, (value - baseline) / baseline * F.lit(100.0))


def narrow_unsigned(value: Column, bits: int, name: str) -> Column:
    """Round half to even, then store as an unsigned integer of ``bits`` bits; out-of-range values raise."""
    top, spark_type = UNSIGNED_RANGES[bits]
    rounded = F.rint(value.cast("double"))
    message = F.concat(F.lit(f"{name} out of range for {bits} unsigned bits: "), value.cast("string"))
    return (
        F.when(value.isNull(), F.lit(None).cast(spark_type))
        .when(rounded.between(0, top), rounded.cast(spark_type))
        .otherwise(F.raise_error(message).cast(spark_type))
    )


def try_narrow(value: Column, source: T.DataType, target: str) -> Column:
    """TRY_CAST that rounds fractional numbers half to even before an integer cast.

    Values that cannot pass are told apart by a plain test first: inside the cast each costs an exception.
    """
    if isinstance(source, T.StringType) and target in ("float", "double"):
        return F.when(value.rlike(NUMBER_START), value).try_cast(target)
    if isinstance(source, T.NumericType) and target in INTEGER_BITS:
        if isinstance(source, (T.FloatType, T.DoubleType)):
            value = F.rint(value)
        edge = 2 ** (INTEGER_BITS[target] - 1)
        if target != "bigint":
            value = F.when(value.between(-edge, edge - 1), value)
    return value.try_cast(target)


def clean_double(value: Column) -> Column:
    """The value as a double, with NULL for what is not a number (uncastable or NaN)."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def settled(value: Column, digits: int) -> Column:
    """An average rounded so that the order of its summation does not show: exact halves are first moved up by a
    hundredth of the last place, far more than summation errors and far less than the rounding."""
    return round_scaled(value + F.lit(10.0 ** -(digits + 2)), digits)


def plain_number(value: Column, digits: int = 2) -> Column:
    """Decimal text without trailing zeros: 9.50 -> '9.5', 100.00 -> '100'."""
    return F.regexp_replace(F.format_string(f"%.{digits}f", value), r"\.?0+$", "")
