"""The report tables of each analysis step, ready for ``write_reports``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bounds, profile, rules
from ..operators.rules import Rule
from ..sources import schemas
from ..sources.files import file_month
from ..sources.reports import metadata_frame, report_form
from .features import BASELINE_LEVELS, ImpactTables

Reports = dict[str, DataFrame]


def file_schemas(spark: SparkSession, paths: str | Sequence[str], reference_file: str, stored: DataFrame) -> Reports:
    """Files against the schema of one of them, and that schema against the stored table."""
    found = schemas.read_schemas(spark, paths)
    mismatches = schemas.drift(spark, found, reference_file)
    reference = schemas.reference_of(found, reference_file)
    file_types = spark.createDataFrame(list(reference.fields), "column_name string, file_type string")
    listed = spark.createDataFrame([(item.path, item.file) for item in found], "path string, file string")
    return {
        "metadata": metadata_frame(spark, schemas.drift_summary(found, mismatches, reference_file)),
        "files": listed.select(file_month(F.col("path")).alias("index"), "file").orderBy("index", "file"),
        "schema": schemas.compare_types(file_types, schemas.types_of(stored, stored.columns)),
        "mismatches": mismatches.drop("path", "row_count").orderBy("file", F.desc("mismatch"), "column_name"),
    }


def csv_schema(raw: DataFrame, stored: DataFrame) -> Reports:
    """Types read from a CSV file against the stored table."""
    spark = raw.sparkSession
    compared = schemas.compare_types(schemas.schema_types(raw.schema, spark), schemas.types_of(stored, stored.columns))
    values = {"column_count": len(raw.columns), "all_match": schemas.all_match(compared)}
    return {"metadata": metadata_frame(spark, values), "schema": compared}


def business_rules(raw: DataFrame, listed: Sequence[Rule]) -> Reports:
    """Totals and per-rule impact from one scan, whose single row of counts is kept."""
    counted = rules.failure_counts(raw, listed)
    counts = raw.sparkSession.createDataFrame(counted.collect(), counted.schema)
    totals = report_form(rules.totals_of(counts, listed)).first().asDict()
    return {
        "metadata": metadata_frame(raw.sparkSession, totals),
        "rules": rules.impact_of(counts, listed).drop("rule_index"),
    }


def upper_bounds(ruled: DataFrame, columns: Sequence[str]) -> Reports:
    """Caps of the long-tailed columns and their final bins."""
    spark = ruled.sparkSession
    states, total_rows = bounds.iterative_trim(ruled, columns, derived=True)
    bins = bounds.upper_bound_bins(spark, states, total_rows).orderBy("column_name", "bucket").drop("bucket")
    return {
        "metadata": metadata_frame(spark, {"row_count": total_rows, "column_count": len(columns)}),
        "column_bins": bounds.rounded_trim_table(bounds.trim_table(spark, states)),
        "column_bins_array": bins,
    }


def date_filter(raw: DataFrame, column: str, year: int) -> Reports:
    """Coverage of the year by a date column."""
    return {"date_coverage": profile.date_coverage(raw, column, [year])}


def daily_metrics(found: ImpactTables) -> Reports:
    days = found.daily
    spark = days.sparkSession
    return {
        "metadata": metadata_frame(spark, {"group_by": "date", "row_count": days.count()}),
        "daily_weather_metrics": days,
    }


def impact(found: ImpactTables) -> Reports:
    """The five sections (rounded) and the summary of differences."""
    spark = found.summary.sparkSession
    sections = {name: section.drop("level_order") for name, section in found.sections.items()}
    metadata = {"weather_column_count": len(BASELINE_LEVELS), "metric_count": found.summary.count()}
    return {"metadata": metadata_frame(spark, metadata), **sections, "impact_rain_summary": found.summary}
