import math
import random

import pytest
from pyspark.sql import functions as F

from sievemark.operators import bounds, charts, checks, profile
from sievemark.operators.histogram import Bins, histogram
from sievemark.operators.quantile import exact_quantiles
from sievemark.plans import profiles
from sievemark.sources import schemas


def column(spark, values, kind="double", name="v"):
    return spark.createDataFrame([(value,) for value in values], f"{name} {kind}")


# --- cardinality and value counts ---


@pytest.mark.parametrize("distinct,with_null,expected", [(300, False, 300), (299, True, 300), (300, True, 301), (301, False, 301), (5000, False, 301)])
def test_capped_distinct(spark, distinct, with_null, expected):
    df = column(spark, list(range(distinct)) * 2 + ([None] if with_null else []), "int")
    row = profile.cardinality_split(df).first()
    assert row.unique_count == expected
    assert row.column_group == ("low" if expected <= 300 else "high")


def test_empty_table(spark):
    df = column(spark, [])
    assert profile.cardinality_split(df).first().unique_count == 0
    assert profile.value_counts(df).count() == 0


def test_value_count_order_and_totals(spark):
    df = spark.createDataFrame([(2.0, "b"), (None, "a"), (10.0, "a"), (2.0, None)], "n double, t string")
    rows = [tuple(row)[:4] for row in profile.value_counts(df).collect()]
    assert rows == [("n", 2.0, "2.0", 2), ("n", 10.0, "10.0", 1), ("n", None, None, 1), ("t", None, "a", 2), ("t", None, "b", 1), ("t", None, None, 1)]


def test_more_columns_than_one_grouping_block(spark):
    names = [f"c{i}" for i in range(40)]
    df = spark.range(10).select(*[(F.col("id") % (i % 5 + 1)).alias(name) for i, name in enumerate(names)])
    found = profile.value_counts(df).groupBy("column_name").agg(F.count("*").alias("n"), F.sum("count").alias("s")).collect()
    assert {row.column_name: row.n for row in found} == {name: i % 5 + 1 for i, name in enumerate(names)}
    assert {row.s for row in found} == {10}


def test_type_validity(spark):
    df = spark.createDataFrame([("1", 127.4), ("x", 127.6), (None, -128.4)], "t string, d double")
    rows = {row.column_name: row for row in profile.type_validity(df, {"t": "double", "d": "tinyint"}).collect()}
    assert (rows["t"].valid_count, rows["t"].valid_type_percent) == (1, 33.33)
    assert rows["d"].valid_count == 2


# --- quantiles ---


def brute_quantile(values, p):
    ordered = sorted(values)
    position = (len(ordered) - 1) * p
    low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
    return low if low == high else low * (1 - position % 1) + high * (position % 1)


@pytest.mark.parametrize("p", [0.0, 0.37, 0.5, 0.990099009901, 1.0])
@pytest.mark.parametrize("direct_rows,accuracy", [(10**6, 10_000), (10, 10), (3, 4)])
def test_quantile_matches_sorting(spark, p, direct_rows, accuracy):
    """Coarse sketches and a tiny direct size force many narrowing rounds; a third of one column is a single value."""
    rng = random.Random(7)
    spread = [rng.lognormvariate(0, 3) for _ in range(900)]
    skewed = [5.0 if i % 3 == 0 else round(rng.uniform(0, 10), 1) for i in range(900)]
    df = spark.createDataFrame(list(zip(spread, skewed)), "a double, b double")
    found = exact_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, p, {"a": 900, "b": 900}, direct_rows, accuracy)
    assert found == {"a": brute_quantile(spread, p), "b": brute_quantile(skewed, p)}


def test_quantile_of_nothing(spark):
    assert exact_quantiles(column(spark, [None]), {"v": F.col("v")}, 0.5, {"v": 0}) == {"v": None}


# --- numeric profile and histograms ---


def test_numeric_profile_leaves_out_null_and_nan(spark):
    df = column(spark, [None, float("nan"), -1.0, 0.0, 1.0, 2.0, 3.0, 4.0])
    found = profile.numeric_profile(df, ["v"], bin_count=4)
    row = found.summary.first()
    assert (row.min_value, row.max_value, row.negative_count, row.zero_count, row.range_count) == (-1.0, 4.0, 1, 1, 6)
    assert row.above_chart_max_value_count == 1
    bins = found.bins.collect()
    assert sum(item.bin_count for item in bins) + row.above_chart_max_value_count == 4
    assert sum(item.bin_percentage for item in bins) == pytest.approx(3 / 8 * 100)


def test_no_positive_values(spark):
    found = profile.numeric_profile(column(spark, [0.0, -2.0, None]), ["v"])
    row = found.summary.first()
    assert (row.chart_max_value, row.above_chart_max_value_count, row.range_count) == (None, 0, 2)
    assert found.bins.count() == 0


def test_histogram_edges_belong_to_the_bin_they_close(spark):
    df = column(spark, [0.0, 1e-9, 25.0, 25.000001, 50.0, 100.0, 100.1, -3.0, None])
    rows = histogram(df, "v", Bins(100.0, 4)).orderBy("bucket").collect()
    assert [row.bin_count for row in rows] == [2, 2, 0, 1]
    assert [row.bin_edge for row in rows] == [25.0, 50.0, 75.0, 100.0]
    assert rows[0].bin_percentage == 2 / 9 * 100


def test_histogram_of_an_empty_range(spark):
    rows = histogram(column(spark, [1.0, 2.0]), "v", Bins(0.0, 5)).collect()
    assert [row.bin_count for row in rows] == [0] * 5


# --- calendar ---


def test_datetime_profile_and_months(spark):
    stamps = ["2018-12-31 23:59:59", "2019-01-01 00:00:00", "2019-02-10 05:00:00", "2019-12-31 23:59:59", "2020-01-01 00:00:00", None]
    df = column(spark, stamps, "string").select(F.col("v").cast("timestamp_ntz").alias("v"))
    row = profile.datetime_profile(df, ["v"], 2019).first()
    assert (row.before_year_count, row.in_year_count, row.after_year_count) == (1, 3, 1)
    months = profile.month_counts(df, ["v"], 2019).collect()
    assert [item.month_count for item in months] == [1, 1] + [0] * 9 + [1]
    assert months[0].month_percentage == pytest.approx(100 / 6)
    assert [item.month_label for item in months][:2] == ["Jan", "Feb"]


@pytest.mark.parametrize("year,skip,repeat,unique,full", [(2019, 0, 0, True, True), (2020, 0, 0, True, True), (2020, 1, 0, True, False), (2019, 0, 1, False, True)])
def test_date_coverage(spark, year, skip, repeat, unique, full):
    days = 366 if year % 4 == 0 else 365
    df = spark.range(skip, days).select(F.date_add(F.lit(f"{year}-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    if repeat:
        df = df.unionByName(df.limit(1))
    row = profile.date_coverage(df, "d", [year]).first()
    assert (row.is_unique, row.full_year) == (unique, full)
    assert row.row_count == days - skip + repeat


# --- report rows ---


def test_other_bucket(spark):
    values = [v for v in range(25) for _ in range(1 if v else 30_000)]
    rows = charts.other_bucket(profile.column_value_counts(column(spark, values, "int"), "v")).collect()
    assert [(row.label, row["count"]) for row in rows] == [("0", 30_000), ("Other (24 values)", 24)]
    few = charts.other_bucket(profile.column_value_counts(column(spark, [1, 2, None], "int"), "v")).collect()
    assert [row.label for row in few] == ["1", "2", "null"]


def test_other_bucket_threshold(spark):
    df = column(spark, [1] * 98 + [2, 3], "int")
    rows = charts.other_bucket(profile.column_value_counts(df, "v"), min_percent_above=1.0).collect()
    assert [(row.label, row["count"], row.percent) for row in rows] == [("1", 98, 98.0), ("Other (2 values)", 2, 2.0)]


def test_labels_and_negative_row(spark):
    found = profile.numeric_profile(column(spark, [float(v) for v in range(1, 102)]), ["v"], bin_count=2)
    labels = [row.label for row in charts.labeled_histogram(found).collect()]
    assert labels == ["0", "(100.01, 101]", "(0.00, 50.00]", "(50.00, 100.01]"] or labels[0] == "0"
    negative = profile.numeric_profile(column(spark, [-1.5, 1.0, 2.0]), ["v"], bin_count=2)
    assert charts.labeled_histogram(negative).first().label == "[-1.5, 0)"


def test_dominant_zero_bar_is_dropped(spark):
    crowded = profile.numeric_profile(column(spark, [0.0] * 60 + [1.0] * 40), ["v"], bin_count=20)
    assert "0" not in [row.label for row in charts.chart_rows(crowded).collect()]
    sparse = profile.numeric_profile(column(spark, [0.0] * 60 + [1.0] * 40), ["v"], bin_count=5)
    assert charts.chart_rows(sparse).first().label == "0"


def test_names_with_dots_and_ticks(spark):
    """Every operator that takes a column name takes it as it is."""
    held_before = set(spark.sparkContext._jsc.getPersistentRDDs())
    name = "a.b`c"
    df = spark.createDataFrame([(float(k % 7), "2019-01-02") for k in range(40)], "v double, d string").toDF(name, "d.t")
    assert {row.column_name: row.non_null_count for row in schemas.inventory(df, "t").collect()} == {name: 40, "d.t": 40}
    assert {row.column_name: row.unique_count for row in profile.capped_distinct_count(df).collect()} == {name: 7, "d.t": 1}
    assert profile.value_counts(df).count() == 8
    assert profile.column_value_counts(df, name).count() == 7
    assert profile.numeric_profile(df, [name]).summary.first().max_value == 6.0
    assert profile.date_coverage(df, "d.t", [2019]).first().row_count == 40
    assert profile.month_counts(df, ["d.t"], 2019).first().month_count == 40
    assert bounds.positive_max_zero_count(df, [name]).first().max_value == 6.0
    states, _ = bounds.iterative_trim(df, [name], derived=True)
    assert bounds.apply_upper_bounds(df, {name: 3.0}).count() == 24 and states[0].name == name
    assert histogram(df, name, Bins(6.0, 3)).count() == 3
    assert checks.zero_rate_by_category(df, "d.t", name, ["2019-01-02"]).first().zero_count == 6
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= held_before


def test_an_empty_input_has_its_rows(spark):
    empty = spark.createDataFrame([], "d date")
    assert [(r.column_name, r.min_value, r.in_year_count) for r in profile.datetime_profile(empty, ["d"], 2019).collect()] == [("d", None, 0)]
    assert [(r.month, r.month_count) for r in profile.month_counts(empty, ["d"], 2019).collect()] == [(m, 0) for m in range(1, 13)]
    (row,) = profile.date_coverage(empty, "d", [2019]).collect()
    assert (row.filter_year, row.row_count, row.unique_count, row.is_unique, row.full_year) == (2019, 0, 0, True, False)


def test_a_known_split_decides_what_is_counted(spark):
    df = spark.createDataFrame([(k % 3, k % 5) for k in range(60)], "a int, b int")
    found = profiles.profile_columns(df, 2019, split=(["b"], ["a"]))
    values = found.reports["low_unique_columns_array"].collect()
    assert {row.column_name for row in values} == {"b"} and len(values) == 5
    assert [row.column_name for row in found.reports["high_unique_columns_numeric"].collect()] == ["a"]


def files_read(df):
    """Scans that a query makes, those it reuses not counted."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return plan.count("FileScan"), plan.count("ReusedExchange")


def test_other_bucket_counts_once(spark, tmp_path):
    spark.range(2000).select((F.col("id") % 37).alias("v")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    scans, reused = files_read(charts.other_bucket(profile.column_value_counts(df, "v"), 2.6))
    assert scans - reused == 1 or scans == 1


def test_a_known_scan_gives_the_same_profiles(spark):
    """Grids and calendar slots of the fused scan lead to what the single operators find."""
    rng = random.Random(8)
    rows = [(k, rng.choice([None, rng.gauss(0, 9), 0.0]), rng.lognormvariate(2, 1), f"2019-{k % 12 + 1:02d}-{k % 28 + 1:02d} {k % 24:02d}:00:{k % 60:02d}", k % 3) for k in range(25_000)]
    df = spark.createDataFrame(rows, "k bigint, g double, l double, s string, low int").withColumn("d", F.col("s").cast("timestamp_ntz")).drop("s")
    scan = profile.scan_table(df, year=2019)
    assert set(scan.grids) == {"k", "g", "l"} and set(scan.slots) == {"d"} and scan.candidates == ["low"]
    assert scan.valid_counts["g"] == sum(row[1] is not None for row in rows) and scan.row_count == 25_000
    alone, known = profile.numeric_profile(df, ["k", "g", "l"]), profile.numeric_profile(df, ["k", "g", "l"], grids=scan.grids)
    assert sorted(alone.summary.collect()) == sorted(known.summary.collect()) and sorted(alone.bins.collect()) == sorted(known.bins.collect())
    slots = profile.known_slots(df, ["d"], 2019, scan.slots)
    assert profile.datetime_profile_of(slots, ["d"]).collect() == profile.datetime_profile(df, ["d"], 2019).collect()
    assert profile.month_counts_of(slots, ["d"]).collect() == profile.month_counts(df, ["d"], 2019).collect()
    by_column = {row.column_name: row for row in profiles.profile_table(df, 2019).collect()}
    lognormal = sorted(row[2] for row in rows)
    assert abs(by_column["l"].chart_max_value - brute_quantile(lognormal, 0.990099009901)) < 1e-9
    assert by_column["g"].negative_count == sum(row[1] is not None and row[1] < 0 for row in rows)
    assert by_column["low"].column_group == "low" and by_column["d"].first_time is not None


def test_the_row_of_the_filter_column_tells_its_coverage(spark):
    days = spark.range(365).select(F.date_add(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("DATE"), F.col("id").alias("n"))
    more = spark.createDataFrame([("2018-12-31", 1), (None, 2), ("2019-05-05", 3)], "d string, n bigint").select(F.col("d").cast("date").alias("DATE"), "n")
    df = days.unionByName(more)
    found = profiles.profile_columns(df, 2019, filtered="DATE")
    row = found.reports["high_unique_columns_datetime"].first()
    assert (row.filter_year, row.row_count, row.unique_count, row.min_date, row.max_date) == (2019, 366, 365, "2019-01-01", "2019-12-31")
    assert not row.is_unique and row.full_year and row.before_year_count == 1
    assert "filter_year" not in profiles.profile_columns(df, 2019).reports["high_unique_columns_datetime"].columns
    text = df.select(F.col("DATE").cast("string").alias("DATE"), "n")
    assert profiles.profile_columns(text, 2019, filtered="DATE").reports["high_unique_columns"].first().unique_count == 365
