"""Reports as CSV folders: fixed column order, the word ``null`` for NULL, yes/no for booleans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import round_scaled
from .tables import discard

# Columns that come first in a report file, in this order.
LEADING_COLUMNS = (
    "check",
    "column_name",
    "month",
    "payment_type",
    "key",
    "value",
    "count",
    "percentage",
    "month_count",
    "month_percentage",
    "bin_edge",
    "bin_count",
    "bin_percentage",
)

NULL_TEXT = "null"


def ordered_columns(columns: Sequence[str]) -> list[str]:
    leading = [name for name in LEADING_COLUMNS if name in columns]
    return leading + [name for name in columns if name not in leading]


def yes_no(value: Column) -> Column:
    return F.when(value, "yes").when(~value, "no")


def report_form(df: DataFrame, digits: int = 2) -> DataFrame:
    """The columns in report order, fractional numbers rounded and booleans as yes/no."""

    def shaped(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, T.BooleanType):
            return yes_no(F.col(name)).alias(name)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return round_scaled(F.col(name), digits).alias(name)
        return F.col(name)

    return df.select(*[shaped(name) for name in ordered_columns(df.columns)])


def write_report(df: DataFrame, path: str, digits: int = 2) -> bool:
    """Write a report table; returns whether it had rows.

    Rows are counted while they are written, in the same job. A table without rows leaves no report, not even an earlier one.
    """
    counted = Observation()
    shaped = report_form(df, digits).observe(counted, F.count(F.lit(1)).alias("rows"))
    shaped.write.mode("overwrite").option("header", True).option("nullValue", NULL_TEXT).csv(path)
    if counted.get.get("rows"):
        return True
    discard(df.sparkSession, path)
    return False


def metadata_frame(spark: SparkSession, values: Mapping[str, object]) -> DataFrame:
    """(key, value) rows of a report's metadata; booleans as yes/no."""

    def text(value: object) -> str | None:
        if isinstance(value, bool):
            return "yes" if value else "no"
        return None if value is None else str(value)

    return spark.createDataFrame([(key, text(value)) for key, value in values.items()], "key string, value string")


def metadata_row(metadata: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Metadata rows as one wide row."""
    return metadata.agg(*[F.max(F.when(F.col("key") == key, F.col("value"))).alias(key) for key in keys])


def write_reports(reports: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Write each table to a folder of its name; returns the names that had rows."""
    return [name for name, table in reports.items() if write_report(table, f"{folder}/{name}")]


def columns_to_rows(columnar: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Rows from array columns read in parallel; shorter arrays are filled with NULL."""
    others = [name for name in columnar.columns if name not in arrays]
    return columnar.select(*others, F.inline(F.arrays_zip(*arrays)))


def normalise_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a report into the given types: names are normalised, ``null`` is NULL, yes/no become booleans.

    Columns of the schema that the file lacks are NULL; columns outside the schema are dropped.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = spark.read.option("header", True).option("nullValue", NULL_TEXT).csv(path)
    raw = raw.toDF(*[normalise_name(name) for name in raw.columns])
    columns = []
    for item in schema.fields:
        if item.name not in raw.columns:
            column = F.lit(None).cast(item.dataType)
        elif isinstance(item.dataType, T.BooleanType):
            word = F.lower(F.trim(F.col(item.name)))
            column = F.when(word == "yes", True).when(word == "no", False)
        else:
            column = F.col(item.name).try_cast(item.dataType)
        columns.append(column.alias(item.name))
    return raw.select(*columns)


def attach_rows(summary: DataFrame, rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the long rows of each column to its summary row as an ordered array.

    The long rows are report rows: bins, months or the counted values of low columns, of which a column has a few hundred
    at most. Value counts of a column without that limit do not belong here, as their array would be as long as they are.
    """
    entries = [item for item in rows.columns if item != "column_name"]
    leading = [F.col(item) for item in order] + [F.col(item) for item in entries if item not in order]
    gathered = rows.groupBy("column_name").agg(F.sort_array(F.collect_list(F.struct(*leading))).alias(name))
    return summary.join(gathered, "column_name", "left")


def saved_split(spark: SparkSession, folder: str, columns: Sequence[str]) -> tuple[list[str], list[str]] | None:
    """Low and high columns from an earlier profile report, or ``None`` if it does not cover exactly ``columns``."""

    def names(report: str) -> list[str]:
        try:
            rows = read_report(spark, f"{folder}/{report}", "column_name string").collect()
        except AnalysisException:
            return []  # a profile has no file for a kind of column that does not occur
        return [row.column_name for row in rows if row.column_name]

    low = names("low_unique_columns")
    high = [name for kind in ("", "_datetime", "_numeric") for name in names(f"high_unique_columns{kind}")]
    if sorted(low + high) != sorted(columns):
        return None
    return [name for name in columns if name in low], [name for name in columns if name in high]


def saved_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> dict[str, float] | None:
    """Caps from an earlier bounds report, or ``None`` if one of ``columns`` is absent or not a number."""
    try:
        report = read_report(spark, path, "column_name string, second_pass_value double")
        rows = report.where(F.col("column_name").isin(*columns)).collect()
    except AnalysisException:
        return None
    bounds = {row.column_name: row.second_pass_value for row in rows}
    if any(bounds.get(name) is None for name in columns):
        return None
    return {name: bounds[name] for name in columns}
