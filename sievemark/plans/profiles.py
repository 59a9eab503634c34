"""Whole-table profiles: the low and high column reports and their CSV folders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import type_family
from ..functions.numbers import pct, round_scaled
from ..operators import profile
from ..operators.profile import TableScan
from ..sources.reports import metadata_frame, write_reports
from ..sources.schemas import table_type


@dataclass(frozen=True)
class TableProfile:
    """Report tables of one source table; a kind of column that does not occur has no entry."""

    scan: TableScan
    low: list[str]
    high: list[str]
    reports: dict[str, DataFrame]


def _column_facts(df: DataFrame, scan: TableScan, names: Sequence[str], unique: dict[str, int]) -> DataFrame:
    """One row per named column from what is already known of it."""
    rows = [
        (k, name, table_type(df.schema[name].dataType), unique[name], scan.valid_counts[name], scan.row_count)
        for k, name in enumerate(scan.names)
        if name in names
    ]
    facts = df.sparkSession.createDataFrame(
        rows, "column_index int, column_name string, data_type string, unique_count bigint, valid bigint, total bigint"
    )
    percent = round_scaled(pct(F.col("valid"), F.col("total"))).alias("valid_type_percent")
    return facts.select("column_index", "column_name", "data_type", "unique_count", percent)


def profile_columns(
    df: DataFrame,
    year: int,
    columns: Sequence[str] | None = None,
    split: tuple[list[str], list[str]] | None = None,
    filtered: str | None = None,
) -> TableProfile:
    """Split the columns by cardinality and profile each group by type; a known ``split`` (low, high) decides what is
    counted and saves the look at cardinality. The row of a high column that the table is ``filtered`` by (a date) also tells
    how it covers the year.

    Scans: one for counts, cardinality, the calendar and the grids of the high columns; one for the values of the low columns;
    and two that read numeric columns only, for the values around a quantile and around the edges of a histogram.
    """
    scan = profile.scan_table(df, columns, year=year) if split is None else profile.split_scan(df, *split)
    unique = profile.collect_unique_counts(df, scan)
    low, high = split or (
        [name for name in scan.names if unique[name] <= scan.limit],
        [name for name in scan.names if unique[name] > scan.limit],
    )
    families = {name: type_family(df.schema[name].dataType) for name in high}
    numeric = [name for name in high if families[name] == "numeric"]
    datetime = [name for name in high if families[name] == "datetime"]
    simple = [name for name in high if name not in numeric and name not in datetime]

    def facts(names: Sequence[str]) -> DataFrame:
        return _column_facts(df, scan, names, unique)

    def with_filter(rows: DataFrame, names: Sequence[str]) -> DataFrame:
        """Rows of high columns, in table order, with the coverage of the year by the filter's column."""
        rows = rows.drop("unique_count")
        if filtered in names:
            coverage = profile.date_coverage(df, filtered, [year]).withColumn("column_name", F.lit(filtered))
            rows = rows.join(coverage, "column_name", "left")
        return rows.orderBy("column_index").drop("column_index")

    reports: dict[str, DataFrame] = {}
    if low:
        reports["low_unique_columns"] = facts(low).orderBy("column_index").drop("column_index")
        reports["low_unique_columns_array"] = profile.value_counts_of(df, scan)
    if simple:
        reports["high_unique_columns"] = with_filter(facts(simple), simple)
    if datetime:
        slots = profile.known_slots(df, datetime, year, scan.slots)
        dates = profile.datetime_profile_of(slots, datetime).drop("in_year_count")
        reports["high_unique_columns_datetime"] = with_filter(facts(datetime).join(dates, "column_name"), datetime)
        reports["high_unique_columns_datetime_array"] = profile.month_counts_of(slots, datetime)
    if numeric:
        found = profile.numeric_profile(df, numeric, grids=scan.grids)
        joined = facts(numeric).join(found.summary, "column_name").orderBy("column_index")
        reports["high_unique_columns_numeric"] = joined.drop("column_index", "unique_count")
        reports["high_unique_columns_numeric_array"] = found.bins.orderBy("column_name", "bucket")
    return TableProfile(scan, low, high, reports)


NUMERIC_STATS = (
    "column_name string, min_value double, negative_count bigint, zero_count bigint, chart_max_value double, "
    "above_chart_max_value_count bigint, max_value double, range_count bigint"
)
DATETIME_STATS = (
    "column_name string, min_value timestamp_ntz, before_year_count bigint, in_year_count bigint, "
    "after_year_count bigint, max_value timestamp_ntz, month_count bigint"
)


def profile_table(df: DataFrame, year: int, columns: Sequence[str] | None = None) -> DataFrame:
    """One wide row per column: type, validity, cardinality group and, for high columns, the statistics of its type."""
    spark = df.sparkSession
    scan = profile.scan_table(df, columns, year=year)
    unique = profile.collect_unique_counts(df, scan)
    high = [name for name in scan.names if unique[name] > scan.limit]
    families = {name: type_family(df.schema[name].dataType) for name in high}
    numeric = [name for name in high if families[name] == "numeric"]
    datetime = [name for name in high if families[name] == "datetime"]
    numbers = profile.numeric_profile(df, numeric, grids=scan.grids).summary if numeric else spark.createDataFrame([], NUMERIC_STATS)
    slots = profile.known_slots(df, datetime, year, scan.slots)
    dates = profile.datetime_profile_of(slots, datetime) if datetime else spark.createDataFrame([], DATETIME_STATS)
    dates = dates.select(
        "column_name",
        F.col("min_value").alias("first_time"),
        F.col("max_value").alias("last_time"),
        "before_year_count",
        "after_year_count",
    )
    group = F.when(F.col("unique_count") <= scan.limit, "low").otherwise("high").alias("column_group")
    facts = _column_facts(df, scan, scan.names, unique).select("*", group)
    return facts.join(numbers, "column_name", "left").join(dates, "column_name", "left").orderBy("column_index")


def write_profile(found: TableProfile, folder: str) -> list[str]:
    """Store the report tables and their metadata as CSV folders; returns the names written."""
    spark = next(iter(found.reports.values())).sparkSession
    values = {
        "row_count": found.scan.row_count,
        "low_unique_column_count": len(found.low),
        "high_unique_column_count": len(found.high),
    }
    if "high_unique_columns_numeric" in found.reports:
        values |= {"tail_ratio": "1/101", "positive_bin_count": profile.POSITIVE_BIN_COUNT}
    metadata = metadata_frame(spark, values)
    return write_reports({"metadata": metadata, **found.reports}, folder)
