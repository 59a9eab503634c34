"""Column profiles: type validity, cardinality split, value counts, numeric and calendar profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import days_in_year, month_label, year_start
from ..functions.columns import quoted, type_family
from ..functions.numbers import clean_double, pct, round_scaled, try_narrow
from .grid import CELLS, Grid, cell_of, count_grids, exact_counts, grids_from
from .histogram import Bins, label_bins
from .longform import lookup
from .quantile import DIRECT_ROWS, exact_quantiles

# Fixed values of the profile reports.
MAX_UNIQUE_VALUES = 300
POSITIVE_BIN_COUNT = 100
CHART_QUANTILE = 0.990099009901  # 1 - 1/101 at 12 decimals

# A bitmap aggregate of Spark holds this many bits (4 KiB).
HASH_SLOTS = 32768
PROBE_ROWS = 20_000  # a first look that proves most columns with many values
# grouping_id is a 64-bit mask with one bit per column.
GROUPING_SET_COLUMNS = 32


def _names(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else df.columns


# --- type validity -------------------------------------------------------------------------------------------------


def type_validity(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per column: rows castable to the given type, and their share of all rows (2 decimals)."""
    names = list(types)
    checks = [
        F.count(try_narrow(quoted(name), df.schema[name].dataType, types[name])).alias(f"v_{k}")
        for k, name in enumerate(names)
    ]
    row = df.agg(F.count(F.lit(1)).alias("row_count"), *checks)
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"), F.lit(types[name]).alias("data_type"), F.col(f"v_{k}").alias("valid_count")
            )
            for k, name in enumerate(names)
        ]
    )
    return row.select("row_count", F.inline(entries)).select(
        "column_name",
        "data_type",
        "valid_count",
        round_scaled(pct(F.col("valid_count"), F.col("row_count"))).alias("valid_type_percent"),
    )


# --- cardinality ---------------------------------------------------------------------------------------------------


def _distinct_floor(column: Column) -> Column:
    """A proven lower bound of the distinct values (NULL is one) in a fixed 4 KiB of state.

    Values are hashed to slots; equal values share a slot, so there are at least as many values as slots hit.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(HASH_SLOTS)) + 1
    return F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(slot)))


@dataclass(frozen=True)
class TableScan:
    """What one scan tells about the columns of a table."""

    names: list[str]
    row_count: int
    valid_counts: dict[str, int]
    candidates: list[str]  # may have at most the limit of distinct values
    limit: int
    grids: dict[str, Grid] = field(default_factory=dict, repr=False)  # of numeric columns known to have more
    slots: dict[str, list[tuple]] = field(default_factory=dict, repr=False)  # (slot, n, low, high) of such date columns


def scan_table(
    df: DataFrame, columns: Sequence[str] | None = None, limit: int = MAX_UNIQUE_VALUES, counted: bool = True, year: int | None = None
) -> TableScan:
    """Row count, the columns not proven to exceed ``limit`` distinct values and, if ``counted``, non-NULL counts.

    Some rows already prove columns with many values, so a first look at few rows leaves less to hash in the scan of all
    rows. A column that neither pass proves stays a candidate, which its full count decides. With a ``year`` the same scan
    gives the grids of proven numeric columns and the calendar slots of proven date columns.
    """
    names = _names(df, columns)
    first = _floors(df.limit(PROBE_ROWS), names)
    open_ = [name for name in names if first[name] <= limit]
    facts = [
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(quoted(name)).alias(f"v_{k}") for k, name in enumerate(names) if counted],
        *[_distinct_floor(quoted(name)).alias(f"d_{k}") for k, name in enumerate(names) if name in open_],
    ]
    families = {name: type_family(df.schema[name].dataType) for name in names if name not in open_}
    numeric = [name for name, family in families.items() if family == "numeric"] if year is not None else []
    dates = [name for name, family in families.items() if family == "datetime"] if year is not None else []
    row, grids, slots = None, {}, {}
    if numeric or dates:
        observed = Observation()
        grids, slots = _grids_and_slots(df.observe(observed, *facts), numeric, dates, year)
        row = observed.get
    if not row or row.get("row_count") is None:
        row = df.agg(*facts).first().asDict()
    return TableScan(
        names,
        row["row_count"],
        {name: row[f"v_{k}"] for k, name in enumerate(names) if counted},
        [name for k, name in enumerate(names) if name in open_ and row[f"d_{k}"] <= limit],
        limit,
        grids,
        slots,
    )


def _grids_and_slots(df: DataFrame, numeric: Sequence[str], dates: Sequence[str], year: int) -> tuple[dict[str, Grid], dict[str, list[tuple]]]:
    """Grids of numeric columns and calendar slots of date columns from one scan."""
    no_number, no_stamp = F.lit(None).cast("double"), F.lit(None).cast("timestamp_ntz")
    parts: list[Column] = []
    for c, name in enumerate([*numeric, *dates]):
        pair = (clean_double(quoted(name)), no_stamp) if c < len(numeric) else (no_number, quoted(name).try_cast("timestamp_ntz"))
        parts += [F.lit(c), *pair]
    stacked = df.select(F.stack(F.lit(len(numeric) + len(dates)), *parts).alias("c", "v", "t"))
    cell = F.when(F.col("c") < len(numeric), cell_of(F.col("v"), CELLS)).otherwise(calendar_slot(F.col("t"), year))
    counted = stacked.groupBy("c", cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("greatest"), F.min("t").alias("low"), F.max("t").alias("high")
    )
    found = counted.toArrow().to_pydict()
    slots: dict[str, list[tuple]] = {name: [] for name in dates}
    for c, slot, n, low, high in zip(*(found[name] for name in ("c", "cell", "n", "low", "high"))):
        if c >= len(numeric):
            slots[dates[c - len(numeric)]].append((slot, n, low, high))
    return dict(zip(numeric, grids_from(found, len(numeric)))), slots


def _floors(df: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """A lower bound of the distinct values of each column."""
    row = df.agg(*[_distinct_floor(quoted(name)).alias(f"d_{k}") for k, name in enumerate(names)]).first() if names else ()
    return dict(zip(names, row))


def split_scan(df: DataFrame, low: Sequence[str], high: Sequence[str]) -> TableScan:
    """Row and non-NULL counts of a table whose split into low and high columns is known: nothing is hashed."""
    chosen = {*low, *high}
    names = [name for name in df.columns if name in chosen]
    row = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count(quoted(name)).alias(f"v_{k}") for k, name in enumerate(names)]).first()
    valid = {name: row[f"v_{k}"] for k, name in enumerate(names)}
    return TableScan(names, row["row_count"], valid, [name for name in names if name in set(low)], MAX_UNIQUE_VALUES)


def _typed_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column_name, numeric_value, value, n) per distinct value of each column, from one scan and one shuffle.

    Grouping sets keep the native types until after the aggregation, so values are turned to text once per distinct
    value and not once per row. Counts are combined before the shuffle, so a value held by a third of all rows
    arrives as one row per input partition.
    """
    blocks = []
    for start in range(0, len(names), GROUPING_SET_COLUMNS):
        block = list(names[start : start + GROUPING_SET_COLUMNS])
        keyed = df.select(*[quoted(name).alias(f"k{i}") for i, name in enumerate(block)])
        keys = keyed.columns
        grouped = keyed.groupingSets([[key] for key in keys], *keys).agg(
            F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")
        )
        full = (1 << len(block)) - 1
        entries = [
            (F.col("gid") == F.lit(full ^ (1 << (len(block) - 1 - i))), name, F.col(f"k{i}"), df.schema[name].dataType)
            for i, name in enumerate(block)
        ]
        blocks.append(
            grouped.select(
                _first_match([(test, F.lit(name)) for test, name, _, _ in entries]).alias("column_name"),
                _first_match([(test, _number(key, kind)) for test, _, key, kind in entries]).alias("numeric_value"),
                _first_match([(test, key.cast("string")) for test, _, key, _ in entries]).alias("value"),
                "n",
            )
        )
    return reduce(DataFrame.unionByName, blocks)


def _first_match(cases: Sequence[tuple[Column, Column]]) -> Column:
    chain = F
    for test, result in cases:
        chain = chain.when(test, result)
    return chain


def _number(key: Column, kind: T.DataType) -> Column:
    return key.cast("double") if isinstance(kind, (T.NumericType, T.BooleanType)) else F.lit(None).cast("double")


def _empty_counts(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "column_name string, numeric_value double, value string, n bigint")


def unique_counts(df: DataFrame, scan: TableScan) -> DataFrame:
    """(column_name, unique_count) for all scanned columns, counted up to ``limit + 1``; NULL is one value."""
    found = _typed_counts(df, scan.candidates) if scan.candidates else _empty_counts(df)
    exact = found.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
    proven = df.sparkSession.createDataFrame(
        [(name, scan.limit + 1) for name in scan.names if name not in scan.candidates], "column_name string, n bigint"
    )
    # A table without rows leaves the candidates uncounted.
    blank = df.sparkSession.createDataFrame([(name, 0) for name in scan.candidates], "column_name string, n bigint")
    return (
        exact.unionByName(proven)
        .unionByName(blank)
        .groupBy("column_name")
        .agg(F.least(F.max("n"), F.lit(scan.limit + 1)).cast("bigint").alias("unique_count"))
    )


def capped_distinct_count(df: DataFrame, columns: Sequence[str] | None = None, limit: int = MAX_UNIQUE_VALUES) -> DataFrame:
    return unique_counts(df, scan_table(df, columns, limit, counted=False))


def cardinality_split(df: DataFrame, columns: Sequence[str] | None = None, limit: int = MAX_UNIQUE_VALUES) -> DataFrame:
    """(column_index, column_name, unique_count, column_group) in table order; 'low' has at most ``limit`` values."""
    scan = scan_table(df, columns, limit, counted=False)
    position = F.array_position(F.array(*[F.lit(name) for name in scan.names]), F.col("column_name")).cast("int") - 1
    return (
        unique_counts(df, scan)
        .select(
            position.alias("column_index"),
            "column_name",
            "unique_count",
            F.when(F.col("unique_count") <= limit, "low").otherwise("high").alias("column_group"),
        )
        .orderBy("column_index")
    )


def collect_unique_counts(df: DataFrame, scan: TableScan) -> dict[str, int]:
    """``unique_counts`` on the driver: one number per column."""
    return {row.column_name: row.unique_count for row in unique_counts(df, scan).collect()}


# --- value counts --------------------------------------------------------------------------------------------------


def value_counts(df: DataFrame, columns: Sequence[str] | None = None, limit: int = MAX_UNIQUE_VALUES) -> DataFrame:
    """Value counts of every low column with the share of all rows.

    Order: columns in table order; inside a column numbers ascending, then text, then NULL. The columns proven high
    never reach the shuffle; the window runs over the distinct values of one column, which the scan has bounded.
    """
    return value_counts_of(df, scan_table(df, columns, limit, counted=False))


def value_counts_of(df: DataFrame, scan: TableScan) -> DataFrame:
    counted = _typed_counts(df, scan.candidates) if scan.candidates else _empty_counts(df)
    distinct = F.count(F.lit(1)).over(Window.partitionBy("column_name"))
    position = F.array_position(F.array(*[F.lit(name) for name in scan.names]), F.col("column_name"))
    return (
        counted.withColumn("unique_count", distinct)
        .where(F.col("unique_count") <= scan.limit)
        .select(
            "column_name",
            "numeric_value",
            "value",
            F.col("n").alias("count"),
            pct(F.col("n"), F.lit(scan.row_count)).alias("percentage"),
        )
        .orderBy(position, value_kind(), "numeric_value", "value")
    )


def value_kind() -> Column:
    """Sort class of a counted value: 0 number, 1 text, 2 NULL."""
    return F.when(F.col("value").isNull(), 2).when(F.col("numeric_value").isNull(), 1).otherwise(0)


def column_value_counts(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Value counts of one column, whatever its cardinality, with the share of all rows.

    The total is a plain row count, which Parquet files answer from their footers.
    """
    counted = df.groupBy(quoted(column).alias("k")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        F.lit(name or column).alias("column_name"),
        _number(F.col("k"), df.schema[column].dataType).alias("numeric_value"),
        F.col("k").cast("string").alias("value"),
        "count",
        pct(F.col("count"), F.lit(df.count())).alias("percentage"),
    )


# --- numeric profile -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class NumericStats:
    names: list[str]
    row_count: int
    stats: dict[str, dict] = field(repr=False)
    grids: dict[str, Grid] = field(repr=False)

    def bins(self, bin_count: int) -> list[Bins]:
        return [
            Bins(self.stats[name]["chart_max"], bin_count)
            if self.stats[name]["chart_max"] is not None
            else Bins(float("inf"), 0)
            for name in self.names
        ]


def numeric_stats(
    df: DataFrame,
    columns: Sequence[str],
    p: float = CHART_QUANTILE,
    direct_rows: int = DIRECT_ROWS,
    grids: Mapping[str, Grid] | None = None,
) -> NumericStats:
    """Extremes, sign counts and the chart maximum (quantile ``p`` of the positive values) of each column.

    All but the quantile come from the columns' grids, known from an earlier scan or counted by one; of the quantile they
    say the cell, whose values a second scan ranks.
    """
    names = list(columns)
    values = {name: clean_double(quoted(name)) for name in names}
    known = dict(grids or {})
    left = [name for name in names if name not in known]
    known.update(zip(left, count_grids(df, [values[name] for name in left])) if left else ())
    stats = {
        name: {
            "min": known[name].lowest,
            "max": known[name].highest,
            "negative": known[name].negative_count,
            "zero": known[name].zero_count,
            "positive": known[name].positive_count,
        }
        for name in names
    }
    positives = {name: F.when(value > 0, value) for name, value in values.items()}
    quantiles = exact_quantiles(df, positives, p, {name: stats[name]["positive"] for name in names}, direct_rows, grids=known)
    for name in names:
        stats[name]["chart_max"] = quantiles[name]
    return NumericStats(names, known[names[0]].row_count, stats, known)


@dataclass(frozen=True)
class NumericProfile:
    """``summary`` has one row per column, ``bins`` the histogram rows up to the chart maximum."""

    summary: DataFrame
    bins: DataFrame
    row_count: int


def numeric_profile(
    df: DataFrame,
    columns: Sequence[str],
    p: float = CHART_QUANTILE,
    bin_count: int = POSITIVE_BIN_COUNT,
    direct_rows: int = DIRECT_ROWS,
    grids: Mapping[str, Grid] | None = None,
) -> NumericProfile:
    """Profile of numeric columns; NULL, uncastable and NaN entries count only in the percentages' denominator.

    Three scans: the grid of all columns (unless it is known), the values in the cell of the quantile, and those in the cells
    that the edges of the histogram cut.
    """
    found = numeric_stats(df, columns, p, direct_rows, grids)
    specs = found.bins(bin_count)
    values = [clean_double(quoted(name)) for name in found.names]
    held = [found.grids[name] for name in found.names]
    filled = {c: [spec] for c, spec in enumerate(specs) if spec.count}
    binned = exact_counts(df, values, held, filled) if filled else {}
    rows = []
    for c, (grid, spec) in enumerate(zip(held, specs)):
        inside = binned[c][0] if c in binned else []
        rows += [(c, bucket, n) for bucket, n in enumerate([*inside, grid.positive_count - sum(inside)], start=1)]
    counts = df.sparkSession.createDataFrame(rows, "c int, bucket int, n bigint")

    def known(part: str, type_name: str) -> Column:
        return lookup([found.stats[name][part] for name in found.names], F.col("c"), type_name)

    spec_count = lookup([spec.count for spec in specs], F.col("c"), "int")
    summary = counts.where(F.col("bucket") == spec_count + 1).select(
        lookup(found.names, F.col("c"), "string").alias("column_name"),
        known("min", "double").alias("min_value"),
        known("negative", "bigint").alias("negative_count"),
        known("zero", "bigint").alias("zero_count"),
        known("chart_max", "double").alias("chart_max_value"),
        F.col("n").alias("above_chart_max_value_count"),
        known("max", "double").alias("max_value"),
        (spec_count + 2).cast("bigint").alias("range_count"),
    )
    return NumericProfile(summary, label_bins(counts, found.names, specs, F.lit(found.row_count)), found.row_count)


# --- calendar profile ----------------------------------------------------------------------------------------------


def calendar_slot(stamp: Column, year: int) -> Column:
    """Months of the year as 1-12, 0 before it, 13 after it, -1 for NULL."""
    return (
        F.when(stamp.isNull(), -1)
        .when(stamp < year_start(year, "timestamp_ntz"), 0)
        .when(stamp >= year_start(year + 1, "timestamp_ntz"), 13)
        .otherwise(F.month(stamp))
    )


def calendar_slots(df: DataFrame, columns: Sequence[str], year: int) -> DataFrame:
    """(c, slot, n, low, high) per column: rows before the year (slot 0), in its months (1-12), after it (13), NULL (-1)."""
    stamps = [part for c, name in enumerate(columns) for part in (F.lit(c), quoted(name).try_cast("timestamp_ntz"))]
    # A slot without rows for each column, so that an input without rows has its columns too.
    none = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("c"), F.lit(-1).alias("slot"), F.lit(None).cast("timestamp_ntz").alias("v"))
    return (
        df.select(F.stack(F.lit(len(columns)), *stamps).alias("c", "v"))
        .select("c", calendar_slot(F.col("v"), year).alias("slot"), "v", F.lit(1).alias("rows"))
        .unionByName(none.withColumn("rows", F.lit(0)))
        .groupBy("c", "slot")
        .agg(F.sum("rows").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )


def _slot_sum(first: int, last: int) -> Column:
    return F.sum(F.when(F.col("slot").between(first, last), F.col("n")).otherwise(0))


def known_slots(df: DataFrame, columns: Sequence[str], year: int, known: Mapping[str, list[tuple]] | None = None) -> DataFrame:
    """``calendar_slots`` computed once, for everything that is folded from them: at most 15 rows a column. Those of columns
    that an earlier scan has seen are ``known``."""
    known = known or {}
    schema = "c int, slot int, n bigint, low timestamp_ntz, high timestamp_ntz"
    rows = [(c, -1, 0, None, None) for c in range(len(columns))]
    rows += [(c, *slot) for c, name in enumerate(columns) for slot in known.get(name, ())]
    left = [name for name in columns if name not in known]
    if left:
        place = {at: list(columns).index(name) for at, name in enumerate(left)}
        rows += [(place[row.c], row.slot, row.n, row.low, row.high) for row in calendar_slots(df, left, year).collect()]
    return df.sparkSession.createDataFrame(rows, schema)


def datetime_profile(df: DataFrame, columns: Sequence[str], year: int) -> DataFrame:
    """One row per column: extremes and the rows before, inside and after the year."""
    return datetime_profile_of(calendar_slots(df, columns, year), columns)


def datetime_profile_of(slots: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        slots.groupBy("c")
        .agg(
            F.min("low").alias("min_value"),
            _slot_sum(0, 0).alias("before_year_count"),
            _slot_sum(1, 12).alias("in_year_count"),
            _slot_sum(13, 13).alias("after_year_count"),
            F.max("high").alias("max_value"),
            F.lit(12).cast("bigint").alias("month_count"),
        )
        .select(
            lookup(list(columns), F.col("c"), "string").alias("column_name"),
            "min_value",
            "before_year_count",
            "in_year_count",
            "after_year_count",
            "max_value",
            "month_count",
        )
    )


def month_counts(df: DataFrame, columns: Sequence[str], year: int) -> DataFrame:
    """Twelve rows per column: rows in each month of the year and their share of all rows (NULL included)."""
    return month_counts_of(calendar_slots(df, columns, year), columns)


def month_counts_of(slots: DataFrame, columns: Sequence[str]) -> DataFrame:
    sums = [_slot_sum(month, month).alias(f"m_{month}") for month in range(1, 13)]
    folded = slots.groupBy("c").agg(F.sum("n").alias("total_rows"), *sums)
    months = F.array(*[F.struct(F.lit(month).alias("month"), F.col(f"m_{month}").alias("month_count")) for month in range(1, 13)])
    return (
        folded.select(lookup(list(columns), F.col("c"), "string").alias("column_name"), "total_rows", F.inline(months))
        .select(
            "column_name",
            "month",
            month_label(F.col("month")).alias("month_label"),
            "month_count",
            pct(F.col("month_count"), F.col("total_rows")).alias("month_percentage"),
        )
        .orderBy("column_name", "month")
    )


def date_coverage(df: DataFrame, column: str, years: Sequence[int]) -> DataFrame:
    """Per asked year: rows, distinct dates, first and last date, whether dates are unique, whether every day is present.

    A year without rows counts 0. Rows are first counted per date, so at most one row per day and input partition is shuffled.
    """
    day = quoted(column).try_cast("date")
    span = (day >= year_start(min(years), "date")) & (day < year_start(max(years) + 1, "date"))
    daily = df.where(span).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    asked = df.sparkSession.createDataFrame([(year,) for year in years], "filter_year int")
    dated = daily.select(F.year("day").alias("filter_year"), "day", "n")
    per_year = dated.unionByName(asked, allowMissingColumns=True).groupBy("filter_year").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("day").alias("unique_count"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )
    year_days = F.create_map(*[part for year in years for part in (F.lit(year), F.lit(days_in_year(year)))])
    return (
        per_year.where(F.col("filter_year").isin(*years))
        .select(
            "filter_year",
            "row_count",
            "unique_count",
            F.col("first_day").cast("string").alias("min_date"),
            F.col("last_day").cast("string").alias("max_date"),
            (F.col("row_count") == F.col("unique_count")).alias("is_unique"),
            (F.col("unique_count") == year_days[F.col("filter_year")]).alias("full_year"),
        )
        .orderBy("filter_year")
    )
