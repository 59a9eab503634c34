"""Trip records: ingest, 22 business rules, outlier caps, narrow types, and the checks on the raw rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import narrow_unsigned
from ..operators import bounds, checks, rules
from ..operators.rules import Rule, null_default_in, shifted_when
from ..sources.files import monthly_names, require_files
from ..sources.ingest import ingest_parquet

# Fixed values of the trip model.
YEAR = 2019
CAPPED_COLUMNS = ("trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount")
PAYMENT_TYPES = (1, 2, 3, 4)
NO_TIP_PAYMENT_TYPES = (2, 3, 4)
MONEY_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
)
FEE_THRESHOLD = 2.5

# Target storage of each column, in table order: unsigned bits, float, timestamp or yes/no flag.
CLEAN_TYPES = {
    "VendorID": 8,
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": 8,
    "trip_distance": "float",
    "RatecodeID": 8,
    "store_and_fwd_flag": "flag",
    "PULocationID": 16,
    "DOLocationID": 16,
    "payment_type": 8,
    "fare_amount": "float",
    "extra": "float",
    "mta_tax": "float",
    "tip_amount": "float",
    "tolls_amount": "float",
    "improvement_surcharge": "float",
    "total_amount": "float",
    "congestion_surcharge": "float",
}


def ingest(spark: SparkSession, directory: str, prefix: str = "yellow_tripdata_", year: int = YEAR) -> DataFrame:
    """The twelve monthly files of the year in the columns of the January file; raises if a month is absent."""
    return ingest_parquet(spark, require_files(spark, directory, monthly_names(prefix, year), "*.parquet"))


def trip_rules(year: int = YEAR) -> list[Rule]:
    """The row rules, used by the filter and by the audit."""
    extra, fare = F.col("extra"), F.col("fare_amount")
    tip_rule = rules.never_both(
        "tip_payment_type",
        f"no tip unless paid by card (payment_type in {NO_TIP_PAYMENT_TYPES})",
        F.col("payment_type").isin(*NO_TIP_PAYMENT_TYPES),
        F.col("tip_amount") > 0,
    )
    return [
        *rules.in_years("tpep_pickup_datetime", year, year, "timestamp_ntz"),
        *rules.in_years("tpep_dropoff_datetime", year, year, "timestamp_ntz"),
        rules.earlier("trip_datetime", "tpep_pickup_datetime", "tpep_dropoff_datetime"),
        rules.one_of("VendorID", 1, 2),
        rules.within("passenger_count", 1, 5),
        rules.within("RatecodeID", 1, 6),
        rules.one_of("store_and_fwd_flag", "Y", "N"),
        rules.within("PULocationID", 1, 263),
        rules.within("DOLocationID", 1, 263),
        rules.within("payment_type", 1, 4),
        Rule(
            "congestion_surcharge (NULL as 0) in (0.0, 0.75, 2.5)",
            "congestion_surcharge",
            null_default_in(F.col("congestion_surcharge"), 0.0, (0.0, 0.75, 2.5)),
        ),
        rules.above("trip_distance", 0.0),
        Rule(
            "fare_amount, plus 2.5 where extra >= 2.5, > 0",
            "fare_amount",
            shifted_when(extra, FEE_THRESHOLD, fare, FEE_THRESHOLD) > 0,
        ),
        Rule(
            "extra, minus 2.5 where extra >= 2.5, in (0.0, 0.5, 1.0)",
            "extra",
            shifted_when(extra, FEE_THRESHOLD, extra, -FEE_THRESHOLD).isin(0.0, 0.5, 1.0),
        ),
        rules.equal_to("mta_tax", 0.5),
        rules.at_least("tip_amount", 0.0),
        rules.at_least("tolls_amount", 0.0),
        rules.equal_to("improvement_surcharge", 0.3),
        rules.at_least("total_amount", 0.0),
        tip_rule,
    ]


def apply_business_rules(raw: DataFrame, year: int = YEAR) -> DataFrame:
    return rules.apply_rules(raw, trip_rules(year), list(CLEAN_TYPES))


def find_caps(ruled: DataFrame) -> dict[str, float]:
    """Caps of the long-tailed columns, from the rows that passed the rules."""
    states, _ = bounds.iterative_trim(ruled, CAPPED_COLUMNS, derived=True)
    return bounds.upper_bounds(states)


def narrow(trips: DataFrame) -> DataFrame:
    """Cast to the stored types; the Y/N flag becomes a boolean."""
    columns = []
    for name, target in CLEAN_TYPES.items():
        value = F.col(name)
        if isinstance(target, int):
            value = narrow_unsigned(value, target, name)
        elif target == "flag":
            value = flag(value, "Y", "N")
        else:
            value = value.cast(target)
        columns.append(value.alias(name))
    return trips.select(*columns)


def flag(value, true_text: str, false_text: str):
    """Two texts to a boolean; any other text is NULL."""
    return F.when(value == true_text, True).when(value == false_text, False)


def clean(raw: DataFrame, year: int = YEAR, caps: Mapping[str, float] | None = None) -> DataFrame:
    """Raw trips to clean trips; without given caps they are found from the rows that pass the rules.

    The result is one lazy scan of the raw rows with the rules and caps as filters, which reach the files.
    """
    ruled = apply_business_rules(raw, year)
    caps = find_caps(ruled) if caps is None else caps
    return narrow(bounds.apply_upper_bounds(ruled, caps))


def payment_checks(raw: DataFrame) -> dict[str, DataFrame]:
    """How often tips are zero per payment type (check 1), and every amount for no-charge (2) and disputed trips (3), each
    with a table that describes the checks."""
    spark = raw.sparkSession
    tips = checks.zero_rate_by_category(raw, "payment_type", "tip_amount", PAYMENT_TYPES).collect()
    totals = {row.category: row.total_count for row in tips}
    groups = {2: 3, 3: 4}  # check: payment type
    amounts = checks.zero_rate_by_column(raw, "payment_type", tuple(groups.values()), MONEY_COLUMNS, ranked=False)
    check = F.when(F.col("category") == groups[2], 2).otherwise(3).alias("check")
    return {
        "check_1": spark.createDataFrame(
            [(1, "Share of trips without a tip, by payment type.", len(PAYMENT_TYPES))], "check int, description string, column_count int"
        ),
        "check_1_array": spark.createDataFrame(
            [(1, row.category, row.zero_count, row.total_count, row.percent) for row in tips],
            "check int, payment_type bigint, tip_0_count bigint, total_count bigint, percent double",
        ),
        "check_2_3": spark.createDataFrame(
            [(k, f"Share of zeros in each amount of payment type {kind}.", kind, totals[kind], len(MONEY_COLUMNS)) for k, kind in groups.items()],
            "check int, description string, payment_type bigint, row_count bigint, column_count int",
        ),
        "check_2_3_array": amounts.select(check, "column_name", "count", "percent"),
    }
