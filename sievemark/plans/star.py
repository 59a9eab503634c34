"""Every operator bound to the star-schema tables (lineitem, orders, events, customer, part, documents)."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import minute_boundaries, same_day
from ..functions.concurrent import side_by_side, union_of
from ..functions.numbers import narrow_unsigned, round_scaled, settled
from ..operators import bounds, charts, checks, daily, impact, profile, rules
from ..operators.daily import Metric
from ..operators.histogram import Bins, histogram
from ..operators.impact import Band
from ..operators.rules import Rule, apply_rules, null_default_in, shifted_when
from ..sources import schemas
from ..sources.ingest import unite_pinned
from . import features, trips, weather
from .profiles import profile_table

Query = Callable[[SparkSession, str], DataFrame]

TRIP_COLUMNS = (
    "l_orderkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_shipdate",
    "o_orderdate",
    "o_orderstatus",
    "o_orderpriority",
    "o_totalprice",
)
PRICE_SHIFT_TAX = 0.05
PRICE_SHIFT = -2500.0
KEPT_DISCOUNTS = (0.0, 0.02, 0.04, 0.05, 0.06, 0.08, 0.1)
LOW_PRIORITIES = ("4-NOT SPECIFIED", "5-LOW")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PROFILE_YEAR = 1998
DIGITS = 6  # of interpolated and averaged values, whose last bits depend on the order of operations
ORDER_YEARS = (*range(1995, 2002), 2030)  # the last one has no orders
URGENT_WEIGHT = 0.75
RAIN_BANDS = (
    Band("no_rain", "0", 0.0, exact=True),
    Band("light_rain", "(0, 0.75]", 0.75),
    Band("medium_rain", "(0.75, 1.5]", 1.5),
    Band("heavy_rain", "> 1.5", None),
)
LEVELS = {**features.LEVELS, "rain_level": ("prcp", RAIN_BANDS)}
LINEITEM_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- derived inputs ------------------------------------------------------------------------------------------------


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order. Both sides grow with the data, so the join shuffles on the order key."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "inner")
    return joined.select(*TRIP_COLUMNS)


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order date with the three daily factors."""
    price = F.col("o_totalprice")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(
            (F.count_if(F.col("o_orderpriority") == "1-URGENT") * F.lit(URGENT_WEIGHT)).alias("prcp"),
            ((F.avg(price) - 200000) / 8000).alias("avg_temp"),
            ((F.max(price) - F.min(price)) / 25000).alias("temp_range"),
        )
    )


def featured_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the factors of their ship date."""
    columns = ("date", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    return daily.join_daily(dated_lines(spark, sf_dir).select(*columns), daily_orders(spark, sf_dir))


def line_metrics() -> list[Metric]:
    return [
        Metric("avg_quantity", F.col("l_quantity")),
        Metric("avg_price", F.col("l_extendedprice")),
        Metric("avg_discount", F.col("l_discount")),
    ]


def dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("date", F.to_date("l_shipdate"))


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.joined_totals(dated_lines(spark, sf_dir), daily_orders(spark, sf_dir), line_metrics(), features.FACTORS)


def event_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last event per user, type and two-day block."""
    block = F.floor(F.unix_date(F.to_date("ts")) / 2).alias("block")
    grouped = table(spark, sf_dir, "events").groupBy("user_id", "event_type", block)
    return grouped.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))


def order_line_rules() -> list[Rule]:
    """Thirteen rules with the shapes of the trip rules, on line items and orders."""
    price = shifted_when(F.col("l_tax"), PRICE_SHIFT_TAX, F.col("l_extendedprice"), PRICE_SHIFT)
    return [
        *rules.in_years("o_orderdate", 1996, 2000, "timestamp_ntz"),
        *rules.in_years("l_shipdate", 1996, 2000, "timestamp_ntz"),
        rules.earlier("order_ship", "o_orderdate", "l_shipdate"),
        rules.within("l_linenumber", 1, 6),
        rules.one_of("l_returnflag", "A", "R"),
        rules.one_of("o_orderstatus", "F", "O"),
        Rule("l_discount in list", "l_discount", null_default_in(F.col("l_discount"), 0.0, KEPT_DISCOUNTS)),
        rules.above("l_quantity", 2.0),
        Rule("shifted l_extendedprice > 0", "l_extendedprice", price > 0),
        rules.at_least("o_totalprice", 10000.0),
        rules.never_both(
            "priority_discount",
            "low priority without high discount",
            F.col("o_orderpriority").isin(*LOW_PRIORITIES),
            F.col("l_discount") > 0.08,
        ),
    ]


# --- sources -------------------------------------------------------------------------------------------------------


def ingest_pinned_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arriving in parts: one with a further column, one with other types and order, united on the first's."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    kind = F.col("event_type")
    first = events.where(kind == "click")
    wider = events.where(kind.isin("view", "signup")).withColumn("source_note", F.lit("late column"))
    retyped = events.where(~kind.isin("click", "view", "signup") | kind.isNull()).select(
        F.col("value").cast("decimal(18,6)").alias("value"), "event_type", F.col("user_id").cast("int").alias("user_id"), "event_id"
    )
    return unite_pinned([first, wider, retyped])


def schema_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders, events = (
        schemas.inventory(table(spark, sf_dir, name), name) for name in ("lineitem", "orders", "events")
    )
    return lines.unionByName(orders).unionByName(events)


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against line items, by column name without the table prefix."""
    paths = [f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet"]
    found = schemas.read_schemas(spark, paths)
    return schemas.drift(spark, found, paths[0], lambda name: re.sub("^[a-z]+_", "", name)).drop("path")


def schema_type_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File types of orders against the types Spark reads them as, with the values each column holds."""
    orders = table(spark, sf_dir, "orders")
    compared = schemas.compare_types(schemas.schema_types(orders.schema, spark), schemas.types_of(orders, orders.columns))
    held = schemas.inventory(orders, "orders").select("column_name", "non_null_count")
    return compared.join(held, "column_name").select("column_name", "file_type", "match", "non_null_count")


# --- filters and projections ---------------------------------------------------------------------------------------


def business_rules_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(order_lines(spark, sf_dir), order_line_rules(), TRIP_COLUMNS)


def conditional_adjust_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = shifted_when(F.col("l_tax"), PRICE_SHIFT_TAX, F.col("l_extendedprice"), PRICE_SHIFT)
    kept = apply_rules(table(spark, sf_dir, "lineitem"), [Rule("shifted price > 0", "l_extendedprice", price > 0)])
    return kept.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")


def null_default_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A discount of 0.07 is stored as NULL; NULL counts as 0, which the list holds, and stays NULL in the result."""
    lines = table(spark, sf_dir, "lineitem").withColumn("discount", F.nullif(F.col("l_discount"), F.lit(0.07)))
    listed = Rule("discount in list", "discount", null_default_in(F.col("discount"), 0.0, (0.0, 0.02, 0.05)))
    return apply_rules(lines, [listed]).select("l_orderkey", "l_linenumber", "discount")


def unit_conversion_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances read as degrees Fahrenheit and part sizes as inches, in metric units at 2 decimals."""
    warm = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > weather.ABSOLUTE_ZERO_FAHRENHEIT)
    sized = table(spark, sf_dir, "part").where(F.col("p_size") >= 0)

    def shaped(df: DataFrame, source: str, key: str, value) -> DataFrame:
        return df.select(F.lit(source).alias("source"), F.col(key).alias("id"), value.alias("metric_value"))

    customers = shaped(warm, "customer", "c_custkey", weather.celsius(F.col("c_acctbal")))
    return customers.unionByName(shaped(sized, "part", "p_partkey", weather.centimetres(F.col("p_size"))))


def narrow_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        narrow_unsigned(F.col("l_linenumber"), 8, "l_linenumber").alias("l_linenumber"),
        narrow_unsigned(F.col("l_quantity") / 2, 16, "l_quantity").alias("half_quantity"),
        F.col("l_extendedprice").cast("float").alias("l_extendedprice"),
        F.col("l_discount").cast("float").alias("l_discount"),
        F.col("l_tax").cast("float").alias("l_tax"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"),
    )


def flag_to_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        trips.flag(F.col("l_linestatus"), "F", "O").alias("is_final"),
        trips.flag(F.col("l_returnflag"), "A", "R").alias("is_accepted"),
    )


def same_day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = event_spans(spark, sf_dir)
    return spans.where((F.col("a") < F.col("b")) & same_day(F.col("a"), F.col("b"))).select("user_id", "event_type", "a", "b")


def derived_daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-sum and difference of a day's extremes, on days without urgent orders."""
    price = F.col("o_totalprice")
    days = (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("day"))
        .agg(
            F.min(price).alias("tmin"),
            F.max(price).alias("tmax"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        )
    )
    return days.where(F.col("urgent") == 0).select(
        F.col("day").cast("string").alias("date"),
        ((F.col("tmin") + F.col("tmax")) / 2.0).alias("mid_value"),
        (F.col("tmax") - F.col("tmin")).alias("value_range"),
    )


def join_daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured_lines(spark, sf_dir).withColumns(
        {"date": F.col("date").cast("string"), "avg_temp": settled(F.col("avg_temp"), DIGITS)}
    )


def minute_boundary_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = minute_boundaries(F.col("a"), F.col("b"))
    grouped = event_spans(spark, sf_dir).groupBy("event_type")
    return grouped.agg(
        F.count(F.lit(1)).alias("span_count"), F.sum(minutes).alias("total_minutes"), F.max(minutes).alias("longest_minutes")
    )


# --- audits and profiles -------------------------------------------------------------------------------------------


def step_removal_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.removal_audit(order_lines(spark, sf_dir), order_line_rules())


def rule_impact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_totals(order_lines(spark, sf_dir), order_line_rules())


def rule_impact_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_impact(order_lines(spark, sf_dir), order_line_rules())


def rule_top_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_page(rule_impact_audit(spark, sf_dir)).drop("rule_index")


def type_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = profile.type_validity(
        table(spark, sf_dir, "events"),
        {"event_id": "tinyint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "double", "value": "double", "props": "double"},
    )
    lines = profile.type_validity(
        table(spark, sf_dir, "lineitem"), {"l_extendedprice": "smallint", "l_returnflag": "string", "l_linenumber": "int"}
    )
    return events.unionByName(lines)


def _over_tables(spark: SparkSession, sf_dir: str, names, build) -> DataFrame:
    def named(name: str) -> DataFrame:
        return build(table(spark, sf_dir, name)).withColumn("table_name", F.lit(name))

    return union_of(spark, [partial(named, name) for name in names])


def capped_distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_tables(spark, sf_dir, ("lineitem", "events", "part"), profile.capped_distinct_count)


def column_cardinality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_tables(spark, sf_dir, ("lineitem", "events", "part"), profile.cardinality_split)


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(table(spark, sf_dir, "lineitem"))


def value_counts_other_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = profile.column_value_counts(table(spark, sf_dir, "lineitem"), "l_suppkey")
    brands = profile.column_value_counts(table(spark, sf_dir, "part"), "p_brand")
    return charts.other_bucket(suppliers, min_percent_above=1.0).unionByName(charts.other_bucket(brands))


PROFILED_NUMBERS = (("customer", ("c_acctbal",)), ("lineitem", ("l_discount", "l_extendedprice")), ("events", ("value",)))


def numeric_profile(spark: SparkSession, sf_dir: str, direct_rows: int = profile.DIRECT_ROWS) -> DataFrame:
    def summary(name: str, columns) -> DataFrame:
        return profile.numeric_profile(table(spark, sf_dir, name), columns, direct_rows=direct_rows).summary

    united = union_of(spark, [partial(summary, name, columns) for name, columns in PROFILED_NUMBERS])
    return united.withColumn("chart_max_value", round_scaled(F.col("chart_max_value"), DIGITS))


def datetime_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.datetime_profile(table(spark, sf_dir, "orders"), ["o_orderdate"], PROFILE_YEAR)


def month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.month_counts(table(spark, sf_dir, "orders"), ["o_orderdate"], PROFILE_YEAR)


def date_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.date_coverage(table(spark, sf_dir, "orders"), "o_orderdate", ORDER_YEARS)


def profiled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile_table(table(spark, sf_dir, "orders"), PROFILE_YEAR)
    return found.withColumn("chart_max_value", round_scaled(F.col("chart_max_value"), DIGITS))


# --- histograms and bounds -----------------------------------------------------------------------------------------


CHARTED = (("customer", "c_acctbal"), ("events", "value"))


def _charted(spark: SparkSession, sf_dir: str, build) -> DataFrame:
    def rows(name: str, column: str) -> DataFrame:
        return build(profile.numeric_profile(table(spark, sf_dir, name), [column]))

    return union_of(spark, [partial(rows, name, column) for name, column in CHARTED])


def histogram_right_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed ranges: balances on (0, 10000] in 100 bins, event values on (0, 500] in 50."""
    balances = histogram(table(spark, sf_dir, "customer"), "c_acctbal", Bins(10000.0, 100))
    values = histogram(table(spark, sf_dir, "events"), "value", Bins(500.0, 50))
    return balances.unionByName(values)


def histogram_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _charted(spark, sf_dir, charts.labeled_histogram)


def histogram_chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _charted(spark, sf_dir, charts.chart_rows)


def positive_max_zero_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounds.positive_max_zero_count(table(spark, sf_dir, "lineitem"), LINEITEM_NUMBERS)


TRIMMED = (("events", ("value",)), ("documents", ("n_chars",)), ("lineitem", ("l_extendedprice", "l_quantity")))


def _trimmed(spark: SparkSession, sf_dir: str, sources=TRIMMED, **settings):
    """(states, row count) per source."""
    calls = [partial(bounds.iterative_trim, table(spark, sf_dir, name), columns, **settings) for name, columns in sources]
    return side_by_side(spark, calls)


def iterative_trim_bounds(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    return bounds.trim_table(spark, [state for states, _ in _trimmed(spark, sf_dir, **settings) for state in states])


def upper_bound_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [bounds.upper_bound_bins(spark, states, total_rows) for states, total_rows in _trimmed(spark, sf_dir)]
    return reduce(DataFrame.unionByName, parts)


def apply_upper_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and documents at or below their caps."""
    parts = []
    for (name, (column,)), key, (states, _) in zip(TRIMMED, ("event_id", "doc_id"), _trimmed(spark, sf_dir, TRIMMED[:2])):
        rows = table(spark, sf_dir, name).select(key, column)
        kept = bounds.apply_upper_bounds(rows, bounds.upper_bounds(states))
        value = F.col(column).cast("double").alias("kept_value")
        parts.append(kept.select(F.lit(name).alias("source"), F.col(key).alias("id"), value))
    return reduce(DataFrame.unionByName, parts)


def zero_rate_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.zero_rate_by_category(order_lines(spark, sf_dir), "o_orderpriority", "l_discount", PRIORITIES)


def zero_rate_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = ("l_discount", "l_tax", "l_quantity", "l_extendedprice")
    return checks.zero_rate_by_column(order_lines(spark, sf_dir), "o_orderpriority", ("1-URGENT", "5-LOW"), amounts)


# --- impact --------------------------------------------------------------------------------------------------------


def _section(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    metrics = line_metrics()
    section = features.section(line_totals(spark, sf_dir), metrics, LEVELS, name)
    return impact.in_report_order(features.report_values(section, features.metric_names(metrics), DIGITS))


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily.daily_metrics(line_totals(spark, sf_dir), line_metrics(), features.FACTORS)
    means = ["avg_temp", *(metric.name for metric in line_metrics())]
    return days.withColumns({"date": F.col("date").cast("string"), **{name: settled(F.col(name), DIGITS) for name in means}})


def impact_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _section(spark, sf_dir, "rain_status")


def impact_by_daytype_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _section(spark, sf_dir, "rain_weekend")


def impact_by_rain_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _section(spark, sf_dir, "rain_level")


def impact_by_temp_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _section(spark, sf_dir, "avg_temp_level")


def impact_by_range_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _section(spark, sf_dir, "temp_range_level")


def impact_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = line_metrics()
    totals = line_totals(spark, sf_dir)  # every section reads the same shuffle of daily sums
    sections = {name: features.section(totals, metrics, LEVELS, name) for name in features.SUMMARISED}
    return features.summary_of(sections, metrics)


def impact_diff_from_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of every level and status group from its baseline group, in one long table."""
    metrics = line_metrics()
    names = features.metric_names(metrics)
    sections = features.sections_of(line_totals(spark, sf_dir), metrics, LEVELS)
    rounded = {name: features.report_values(section, names) for name, section in sections.items()}

    def shaped(differences: DataFrame, section: str, group) -> DataFrame:
        keys = [F.lit(section).alias("section"), group.alias("group_name")]
        return differences.select(*keys, "metric", "value", "diff_from_baseline")

    parts = [shaped(features.level_differences(rounded[name], name, names), name, F.col(name)) for name in LEVELS]
    status = features.status_differences(rounded["rain_status"], names)
    weekend = features.status_differences(rounded["rain_weekend"], names, ["day_type"])
    parts.append(shaped(status, "rain_status", F.col("rain_status")))
    parts.append(shaped(weekend, "rain_weekend", F.concat_ws("/", "day_type", "rain_status")))
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Query] = {
    "ingest_pinned_schema": ingest_pinned_schema,
    "schema_inventory": schema_inventory,
    "schema_drift": schema_drift,
    "schema_type_match": schema_type_match,
    "business_rules_filter": business_rules_filter,
    "conditional_adjust_filter": conditional_adjust_filter,
    "null_default_membership": null_default_membership,
    "unit_conversion_filter": unit_conversion_filter,
    "narrow_types": narrow_types,
    "flag_to_boolean": flag_to_boolean,
    "same_day_filter": same_day_filter,
    "derived_daily_features": derived_daily_features,
    "join_daily_features": join_daily_features,
    "step_removal_audit": step_removal_audit,
    "rule_impact_totals": rule_impact_totals,
    "rule_impact_audit": rule_impact_audit,
    "rule_top_removed": rule_top_removed,
    "type_validity": type_validity,
    "capped_distinct_count": capped_distinct_count,
    "column_cardinality_split": column_cardinality_split,
    "value_counts": value_counts,
    "value_counts_other_bucket": value_counts_other_bucket,
    "numeric_profile": numeric_profile,
    "numeric_profile_searched": partial(numeric_profile, direct_rows=20),
    "datetime_profile": datetime_profile,
    "month_counts": month_counts,
    "date_coverage": date_coverage,
    "profile_table": profiled_orders,
    "histogram_right_closed": histogram_right_closed,
    "histogram_labeled": histogram_labeled,
    "histogram_chart_rows": histogram_chart_rows,
    "positive_max_zero_count": positive_max_zero_count,
    "iterative_trim_bounds": iterative_trim_bounds,
    "iterative_trim_bounds_rescanned": partial(iterative_trim_bounds, cells=4),
    "upper_bound_bins": upper_bound_bins,
    "apply_upper_bounds": apply_upper_bounds,
    "zero_rate_by_category": zero_rate_by_category,
    "zero_rate_by_column": zero_rate_by_column,
    "minute_boundary_duration": minute_boundary_duration,
    "daily_metrics": daily_metrics,
    "impact_by_status": impact_by_status,
    "impact_by_daytype_status": impact_by_daytype_status,
    "impact_by_rain_level": impact_by_rain_level,
    "impact_by_temp_level": impact_by_temp_level,
    "impact_by_range_level": impact_by_range_level,
    "impact_summary": impact_summary,
    "impact_diff_from_baseline": impact_diff_from_baseline,
}
