"""The trip, weather and feature flows on small files in the source formats."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from sievemark.operators import daily, rules
from sievemark.plans import features, profiles, star, steps, trips, weather
from sievemark.sources import files, ingest, reports, schemas, tables

TRIP_SCHEMA = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
    "trip_distance double, RatecodeID double, store_and_fwd_flag string, PULocationID bigint, DOLocationID bigint, "
    "payment_type bigint, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double, airport_fee double"
)
GOOD = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2019, 5, 4, 10, 0, 59),
    "tpep_dropoff_datetime": datetime(2019, 5, 4, 10, 1, 1),
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 263,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 15.3,
    "congestion_surcharge": 2.5,
    "airport_fee": None,
}
# One change per rule that makes a row fail that rule and no other.
BREAKS = [
    {"tpep_pickup_datetime": datetime(2018, 12, 31, 23, 59), "tpep_dropoff_datetime": datetime(2019, 1, 1, 0, 5)},
    None,  # a late pickup cannot fail alone: its drop-off is later still
    None,  # nor can an early drop-off
    {"tpep_pickup_datetime": datetime(2019, 12, 31, 23, 59), "tpep_dropoff_datetime": datetime(2020, 1, 1, 0, 5)},
    {"tpep_dropoff_datetime": datetime(2019, 5, 4, 10, 0, 59)},
    {"VendorID": 4},
    {"passenger_count": 6.0},
    {"RatecodeID": 99.0},
    {"store_and_fwd_flag": None},
    {"PULocationID": 264},
    {"DOLocationID": 0},
    {"payment_type": 5},
    {"congestion_surcharge": 1.0},
    {"trip_distance": 0.0},
    {"fare_amount": 0.0},
    {"extra": 4.5},
    {"mta_tax": 0.0},
    {"tip_amount": -1.0},
    {"tolls_amount": -0.5},
    {"improvement_surcharge": 0.0},
    {"total_amount": -0.1},
    {"payment_type": 2},
]
ALSO_GOOD = [{}, {"congestion_surcharge": None}, {"extra": 2.5, "fare_amount": -2.0}, {"payment_type": 2, "tip_amount": 0.0}]


def trip_frame(spark, changes):
    names = list(GOOD)
    return spark.createDataFrame([tuple({**GOOD, **change}[name] for name in names) for change in changes], TRIP_SCHEMA)


@pytest.fixture(scope="module")
def raw(spark):
    cached = trip_frame(spark, [*ALSO_GOOD, *[change for change in BREAKS if change is not None]]).cache()
    yield cached
    cached.unpersist()


def test_each_trip_rule_fails_alone(raw):
    listed = trips.trip_rules()
    assert len(listed) == 22
    found = {row.rule_index: row.exclusive_removed_count for row in rules.rule_impact(raw, listed).collect()}
    assert found == {k: 0 if change is None else 1 for k, change in enumerate(BREAKS)}


def test_trip_filter_equals_audit(raw):
    kept = trips.apply_business_rules(raw)
    assert kept.columns == list(trips.CLEAN_TYPES)
    assert kept.count() == rules.rule_totals(raw, trips.trip_rules()).first().clean_count == len(ALSO_GOOD)
    assert kept.where(F.col("extra") == 2.5).first().fare_amount == -2.0
    assert kept.where(F.col("congestion_surcharge").isNull()).count() == 1


def test_clean_trips(raw):
    clean = trips.clean(raw, caps={name: 100.0 for name in trips.CAPPED_COLUMNS})
    types = {field.name: field.dataType.simpleString() for field in clean.schema.fields}
    assert types["VendorID"] == "smallint" and types["PULocationID"] == "int" and types["fare_amount"] == "float"
    assert types["store_and_fwd_flag"] == "boolean" and types["tpep_pickup_datetime"] == "timestamp_ntz"
    assert clean.count() == len(ALSO_GOOD)
    assert trips.clean(raw, caps={"trip_distance": 1.0}).count() == 0
    found = trips.clean(raw)  # caps from the rows themselves
    assert found.count() <= len(ALSO_GOOD)


def test_payment_checks(raw):
    checks = trips.payment_checks(raw)
    first = {row.payment_type: row for row in checks["check_1_array"].collect()}
    assert set(first) == {1, 2, 3, 4} and {row.check for row in first.values()} == {1}
    assert (first[2].tip_0_count, first[2].total_count, first[2].percent) == (1, 2, 50.0)
    assert (first[3].tip_0_count, first[3].total_count, first[3].percent) == (0, 0, 0.0)
    second = checks["check_2_3_array"].collect()
    assert [(row.check, row.column_name) for row in second] == [(check, name) for check in (2, 3) for name in trips.MONEY_COLUMNS]
    described = [(row.check, row.payment_type, row.row_count, row.column_count) for row in checks["check_2_3"].collect()]
    assert described == [(check, kind, first[kind].total_count, 8) for check, kind in ((2, 3), (3, 4))]
    assert [(row.check, row.column_count) for row in checks["check_1"].collect()] == [(1, 4)]


# --- files ---


@pytest.fixture(scope="module")
def month_folder(spark, tmp_path_factory):
    """Twelve monthly files: March has a further column, April other types."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path_factory.mktemp("months")
    for month in range(1, 13):
        data = {"id": pa.array([month, month + 100], pa.int64()), "amount": pa.array([0.5, float(month)], pa.float64())}
        if month == 3:
            data["extra_note"] = pa.array(["a", "b"])
        if month == 4:
            data["amount"] = pa.array([1, month], pa.int64())
        pq.write_table(pa.table(data), folder / f"trips_2019-{month:02d}.parquet")
    return str(folder)


def test_monthly_ingest(spark, month_folder):
    names = files.monthly_names("trips_", 2019)
    paths = files.require_files(spark, month_folder, names, "*.parquet")
    assert [path.rsplit("/", 1)[-1] for path in paths] == names
    df = ingest.ingest_parquet(spark, paths)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [("id", "bigint"), ("amount", "double")]
    assert df.count() == 24
    assert df.where("id = 104").first().amount == 4.0


def test_file_months_and_missing(spark, month_folder):
    listed = files.list_files(spark, month_folder, "*.parquet")
    assert sorted(row.month for row in listed.collect()) == list(range(1, 13))
    with pytest.raises(files.MissingFiles, match="trips_2020-01.parquet"):
        files.require_files(spark, month_folder, files.monthly_names("trips_", 2020), "*.parquet")


def test_missing_column_raises(spark):
    part = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ingest.MissingColumns, match="amount"):
        ingest.unite_pinned([spark.createDataFrame([(1, 2.0)], "id int, amount double"), part])


def test_schema_drift(spark, month_folder):
    read = schemas.read_schemas(spark, month_folder)
    found = schemas.drift(spark, read, "trips_2019-01.parquet")
    rows = sorted((row.file[11:13], row.mismatch, row.column_name, row.parquet_type, row.row_count) for row in found.collect())
    assert rows == [
        ("03", "extra", "extra_note", "string", 2),
        ("04", "extra", "amount", "int64", 2),
        ("04", "missing", "amount", "double", 2),
    ]
    summary = schemas.drift_summary(read, found, "trips_2019-01.parquet")
    assert (summary["file_count"], summary["column_count"], summary["all_match"]) == (12, 2, False)


def test_schemas_of_folder_tables_and_equal_names(spark, tmp_path):
    """Inputs are told apart by path, and a folder of part files is one input."""
    for name, kind in (("a", "int"), ("b", "bigint")):
        rows = spark.createDataFrame([(1,), (2,), (3,)], "v int").select(F.col("v").cast(kind)).repartition(3)
        rows.write.parquet(f"{tmp_path}/{name}/t.parquet")
    paths = [f"{tmp_path}/{name}/t.parquet" for name in ("a", "b")]
    read = schemas.read_schemas(spark, paths)
    rows = {(r.path, r.mismatch, r.parquet_type, r.row_count) for r in schemas.drift(spark, read, paths[0]).collect()}
    assert rows == {(paths[1], "missing", "int32", 3), (paths[1], "extra", "int64", 3)}
    with pytest.raises(ValueError, match="2 inputs"):
        schemas.drift(spark, read, "t.parquet")
    assert ingest.ingest_parquet(spark, paths).count() == 6


def mixed_folder(spark, tmp_path, retyped=1):
    """A folder of part files of which some hold `amount` as whole numbers, and one a further column."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "t.parquet"
    folder.mkdir()
    for at in range(6):
        amount = pa.array([at, at + 10], pa.int64()) if at in range(2, 2 + retyped) else pa.array([at + 0.5, at + 10.5])
        data = {"id": pa.array([at, at + 100], pa.int64()), "amount": amount}
        pq.write_table(pa.table(data), folder / f"part-{at}.parquet")
    (folder / "_SUCCESS").touch()
    return str(folder)


def test_drift_between_part_files(spark, tmp_path):
    folder = mixed_folder(spark, tmp_path)
    read = schemas.read_schemas(spark, folder)
    assert [(item.file, item.row_count) for item in read] == [(f"part-{at}.parquet", 2) for at in range(6)]
    for reference in ("part-0.parquet", folder, "t.parquet"):
        rows = {(r.file, r.mismatch, r.column_name, r.parquet_type, r.row_count) for r in schemas.drift(spark, read, reference).collect()}
        assert rows == {("part-2.parquet", "missing", "amount", "double", 2), ("part-2.parquet", "extra", "amount", "int64", 2)}


def test_part_files_are_ingested_in_one_scan_a_kind(spark, tmp_path):
    df = ingest.ingest_parquet(spark, [mixed_folder(spark, tmp_path, retyped=3)])
    assert {row.id: row.amount for row in df.collect()} == {
        at + more: float(at + more // 10) if at in (2, 3, 4) else at + more // 10 + 0.5 for at in range(6) for more in (0, 100)
    }
    assert dict(df.dtypes)["amount"] == "double"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_folders_that_name_columns(spark, tmp_path):
    """Columns in the names of folders are columns of the input, also where its parts differ."""
    spark.range(4).withColumn("month", F.col("id") % 2).write.partitionBy("month").parquet(f"{tmp_path}/t.parquet")
    (whole,) = schemas.read_schemas(spark, f"{tmp_path}/t.parquet")
    assert whole.fields == (("id", "int64"), ("month", "int32")) and whole.row_count == 4
    spark.range(4, 6).select(F.col("id").cast("int")).write.parquet(f"{tmp_path}/t.parquet/month=2")
    found = ingest.ingest_parquet(spark, [f"{tmp_path}/t.parquet"])
    assert sorted((row.id, row.month) for row in found.collect()) == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 2), (5, 2)]


@pytest.mark.parametrize(
    "file_type,stored,expected",
    [
        ("int64", "BIGINT", True),
        ("double", "DECIMAL(10,2)", True),
        ("string", "BIGINT", False),
        ("timestamp[us]", "TIMESTAMP_NTZ", True),
        ("int32", "INT", False),
        ("int32", "INT32", True),
        ("int32", "INT32(4)", False),
        ("decimal", "DECIMAL(10,2)", False),
        ("", "BIGINT", False),
        (None, "BIGINT", False),
    ],
)
def test_type_matches(spark, file_type, stored, expected):
    df = spark.createDataFrame([(file_type, stored)], "f string, s string")
    assert df.select(schemas.type_matches(F.col("f"), F.col("s")).alias("m")).first().m is expected


# --- weather and features ---

WEATHER_LINES = [
    "STATION,DATE,PRCP,SNOW,SNWD,TMIN,TMAX",
    "A,2019-05-04,0.10,0,0,50,68",
    "A,2019-05-05,0,0,0,41,59",
    "A,2019-05-06,0,0.5,0,30,40",
    "A,2018-12-31,0,0,0,30,40",
    "A,2020-01-01,0,0,0,30,40",
    "A,2019-06-01,-1,0,0,30,40",
    "A,2019-06-02,0,-1,0,30,40",
    "A,2019-06-03,0,0,,30,40",
    "A,2019-06-04,0,0,0,-460,40",
    "A,2019-06-05,0,0,0,30,-459.67",
]


@pytest.fixture(scope="module")
def raw_weather(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("weather") / "daily.csv"
    path.write_text("\n".join(WEATHER_LINES) + "\n")
    return ingest.ingest_csv(spark, str(path))


def test_weather(raw_weather):
    assert dict(raw_weather.dtypes)["DATE"] == "date"
    listed = weather.weather_rules()
    found = {row.rule_index: row.exclusive_removed_count for row in rules.rule_impact(raw_weather, listed).collect()}
    assert found == {k: 1 for k in range(7)}
    clean = weather.clean(raw_weather).orderBy("date").collect()
    assert [row.date for row in clean] == [date(2019, 5, 4), date(2019, 5, 5), date(2019, 5, 6)]
    assert (round(clean[0].prcp, 4), clean[0].tmin, clean[0].tmax) == (0.25, 10.0, 20.0)


def test_csv_against_table(spark, raw_weather):
    stored = schemas.types_of(raw_weather, raw_weather.columns)
    compared = schemas.compare_types(schemas.schema_types(raw_weather.schema, spark), stored)
    rows = {row.column_name: row.match for row in compared.collect()}
    assert rows["DATE"] and rows["PRCP"] and rows["STATION"]
    without = {name: kind for name, kind in stored.items() if name != "PRCP"}
    assert not schemas.all_match(schemas.compare_types(schemas.schema_types(raw_weather.schema, spark), without))


@pytest.fixture(scope="module")
def clean_pair(spark, raw_weather):
    day = datetime(2019, 5, 4, 10, 0, 59)
    changes = [
        {"fare_amount": 10.0},
        {"fare_amount": 20.0, "tpep_dropoff_datetime": day + timedelta(minutes=9)},
        {"tpep_pickup_datetime": day + timedelta(days=1), "tpep_dropoff_datetime": day + timedelta(days=1, minutes=4)},
        {"tpep_pickup_datetime": datetime(2019, 5, 4, 23, 59), "tpep_dropoff_datetime": datetime(2019, 5, 5, 0, 1)},
        {"tpep_pickup_datetime": day + timedelta(days=2), "tpep_dropoff_datetime": day + timedelta(days=2, minutes=4)},
        {"tpep_pickup_datetime": day + timedelta(days=9), "tpep_dropoff_datetime": day + timedelta(days=9, minutes=4)},
    ]
    return trips.narrow(trip_frame(spark, changes)), weather.clean(raw_weather)


def test_features(clean_pair):
    """Kept: same-day trips on days with weather and without snow."""
    featured = features.features(*clean_pair)
    assert featured.columns == [
        "date", "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount", "tip_amount",
        "total_amount", "prcp", "avg_temp", "temp_range",
    ]
    rows = featured.orderBy("tpep_pickup_datetime").collect()
    assert [row.date.day for row in rows] == [4, 4, 5]
    assert (rows[0].avg_temp, rows[0].temp_range) == (15.0, 10.0)


def test_both_ways_to_daily_totals_agree(clean_pair):
    joined = features.trip_totals(*clean_pair)
    stored = features.feature_totals(features.features(*clean_pair))
    columns = sorted(stored.columns)
    assert sorted(map(tuple, joined.select(columns).collect())) == sorted(map(tuple, stored.select(columns).collect()))


def test_impact_tables(clean_pair):
    tables_ = features.impact_tables(features.trip_totals(*clean_pair))
    days = tables_.daily.collect()
    assert [(row.trip_count, row.avg_duration_minutes, row.avg_fare_amount) for row in days] == [(2, 5.0, 15.0), (1, 4.0, 12.0)]
    status = {row.rain_status: row for row in tables_.sections["rain_status"].collect()}
    assert (status["rain"].day_count, status["rain"].avg_trip_count) == (1, 2.0)
    levels = [(row.rain_level, row.value_range) for row in tables_.sections["rain_level"].collect()]
    assert levels == [("no_rain", "0"), ("light_rain", "(0, 0.5]")]
    summary = {row.metric: row for row in tables_.summary.collect()}
    assert list(summary)[0] == "avg_trip_count"
    assert summary["avg_fare_amount"].rain_pct == 25.0
    assert summary["avg_fare_amount"].weekday_rain_pct is None
    assert summary["avg_trip_count"].light_rain_pct == 100.0
    differences = features.level_differences(tables_.sections["avg_temp_level"], "avg_temp_level", ["avg_fare_amount"])
    assert {row.avg_temp_level: row.diff_from_baseline for row in differences.collect()} == {"mild_low_temp": 0.0, "cool_temp": -20.0}
    tables_.release()


def test_mean_of_daily_means_is_not_the_trip_mean(spark):
    rows = [(date(2019, 5, 6), 0.0, 10.0)] * 3 + [(date(2019, 5, 7), 0.0, 20.0)]
    df = spark.createDataFrame(rows, "date date, prcp double, x double")
    metrics = [daily.Metric("avg_x", F.col("x"))]
    totals = daily.daily_totals(df, metrics, ["prcp"])
    assert features.section(totals, metrics, {"rain_level": ("prcp", features.RAIN_BANDS)}, "rain_status").first().avg_x == 15.0


def test_a_repeated_day_counts_twice_on_both_routes(spark):
    repeated = spark.createDataFrame([(date(2019, 1, 1), 1.0)] * 2, "date date, prcp double")
    facts = spark.createDataFrame([(date(2019, 1, 1), 3.0), (date(2019, 1, 1), 5.0), (date(2019, 1, 2), 9.0)], "date date, x double")
    metrics = [daily.Metric("avg_x", F.col("x"))]
    by_join = daily.daily_totals(daily.join_daily(facts, repeated), metrics, ["prcp"])
    for totals in (by_join, daily.joined_totals(facts, repeated, metrics, ["prcp"])):
        (row,) = daily.daily_metrics(totals, metrics, ["prcp"]).collect()
        assert (row.trip_count, row.avg_x) == (4, 4.0)


def test_averages_skip_nulls_and_keep_decimals(spark):
    day = date(2019, 1, 1)
    facts = spark.createDataFrame([(day, 0.125, None), (day, 0.004, None), (day, None, None)], "date date, x double, y double")
    sides = spark.createDataFrame([(day, 0.0)], "date date, prcp double")
    metrics = [daily.Metric("avg_x", F.col("x")), daily.Metric("avg_y", F.col("y"))]
    totals = daily.joined_totals(facts, sides, metrics, ["prcp"])
    (row,) = daily.daily_metrics(totals, metrics, ["prcp"]).collect()
    assert (row.trip_count, row.avg_y) == (3, None) and abs(row.avg_x - 0.0645) < 1e-15
    (section,) = features.section(totals, metrics, {"rain_level": ("prcp", features.RAIN_BANDS)}, "rain_status").collect()
    assert abs(section.avg_x - 0.0645) < 1e-15 and section.avg_y is None and section.avg_trip_count == 3


def test_large_daily_side_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(daily, "BROADCAST_DAYS", 0)
    sides = spark.createDataFrame([(date(2019, 1, 1), 1.0)], "date date, prcp double")
    plan = daily.join_daily(sides.select("date"), sides)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


# --- reports and tables ---


def test_profile_reports_round_trip(spark, tmp_path):
    df = spark.range(400).select(
        (F.col("id") % 3).alias("kind"),
        F.when(F.col("id") > 0, F.col("id") * 0.5).alias("amount"),
        F.timestamp_add("DAY", F.col("id"), F.lit("2019-01-01").cast("timestamp_ntz")).alias("at"),
        F.concat(F.lit("n"), "id").alias("name"),
    )
    found = profiles.profile_columns(df, 2019)
    assert (found.low, found.high) == (["kind"], ["amount", "at", "name"])
    folder = str(tmp_path / "profile")
    written = profiles.write_profile(found, folder)
    assert len(written) == 8
    assert reports.saved_split(spark, folder, df.columns) == (found.low, found.high)
    assert reports.saved_split(spark, folder, [*df.columns, "other"]) is None
    again = profiles.profile_columns(df, 2019, split=reports.saved_split(spark, folder, df.columns))
    assert (again.low, again.high) == (found.low, found.high)
    numbers = reports.read_report(spark, f"{folder}/high_unique_columns_numeric", profiles.NUMERIC_STATS)
    assert numbers.first().max_value == 199.5
    values = reports.read_report(spark, f"{folder}/low_unique_columns_array", "column_name string, value string, count bigint")
    summary = reports.read_report(spark, f"{folder}/low_unique_columns", "column_name string, unique_count bigint")
    attached = reports.attach_rows(summary, values, ["value"], "rows").first()
    assert [(item.value, item["count"]) for item in attached.rows] == [("0", 134), ("1", 133), ("2", 133)]
    metadata = spark.read.option("header", True).csv(f"{folder}/metadata")
    assert reports.metadata_row(metadata, ["row_count"]).first().row_count == "400"


def test_profile_table(spark):
    df = spark.range(400).select("id", (F.col("id") % 2 == 0).alias("even"))
    rows = {row.column_name: row for row in profiles.profile_table(df, 2019).collect()}
    assert (rows["id"].column_group, rows["id"].max_value, rows["id"].zero_count) == ("high", 399.0, 1)
    assert (rows["even"].column_group, rows["even"].unique_count, rows["even"].max_value) == ("low", 2, None)


def test_report_texts(spark, tmp_path):
    df = spark.createDataFrame([(None, True, 1.5, "a"), (2, False, None, "b")], "n int, ok boolean, x double, column_name string")
    path = str(tmp_path / "r")
    assert reports.write_report(df, path)
    text = "".join(item.read_text() for item in sorted((tmp_path / "r").glob("part-*.csv")))
    assert text.startswith("column_name,n,ok,x") and "a,null,yes,1.5" in text and "b,2,no,null" in text
    back = reports.read_report(spark, path, "column_name string, n int, ok boolean, x double, absent string")
    assert sorted(map(tuple, back.collect())) == [("a", None, True, 1.5, None), ("b", 2, False, None, None)]
    assert not reports.write_report(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert reports.metadata_frame(spark, {"all_match": True, "n": 3, "x": None}).collect()[0].value == "yes"


def test_step_reports(spark, raw, raw_weather, clean_pair, month_folder, tmp_path):
    """Every step's tables can be written, and hold what the operators found."""
    stored = spark.read.parquet(f"{month_folder}/trips_2019-01.parquet")
    impact = features.impact_tables(features.trip_totals(*clean_pair))
    steps_ = {
        "schemas": steps.file_schemas(spark, month_folder, "trips_2019-01.parquet", stored),
        "csv": steps.csv_schema(raw_weather, raw_weather),
        "rules": steps.business_rules(raw, trips.trip_rules()),
        "bounds": steps.upper_bounds(trips.apply_business_rules(raw), trips.CAPPED_COLUMNS),
        "dates": steps.date_filter(raw_weather, "DATE", 2019),
        "daily": steps.daily_metrics(impact),
        "impact": steps.impact(impact),
        "payments": trips.payment_checks(raw),
    }
    written = {name: reports.write_reports(tables_, str(tmp_path / name)) for name, tables_ in steps_.items()}
    assert {name: len(found) for name, found in written.items()} == {
        "schemas": 4, "csv": 2, "rules": 2, "bounds": 3, "dates": 1, "daily": 2, "impact": 7, "payments": 4,
    }
    caps = reports.saved_bounds(spark, str(tmp_path / "bounds/column_bins"), trips.CAPPED_COLUMNS)
    assert caps == trips.find_caps(trips.apply_business_rules(raw))
    rule_rows = reports.read_report(spark, str(tmp_path / "rules/rules"), "rule_name string, invalid_count bigint")
    assert rule_rows.count() == 22
    impact.release()


def test_columns_to_rows(spark):
    columnar = spark.createDataFrame([("k", [1, 2], ["a"])], "name string, n array<int>, t array<string>")
    rows = reports.columns_to_rows(columnar, ["n", "t"]).collect()
    assert [tuple(row) for row in rows] == [("k", 1, "a"), ("k", 2, None)]


def test_saved_bounds(spark, tmp_path):
    path = str(tmp_path / "bounds")
    assert reports.saved_bounds(spark, path, ["a"]) is None
    reports.write_report(spark.createDataFrame([("a", 1.5), ("b", None)], "column_name string, second_pass_value double"), path)
    assert reports.saved_bounds(spark, path, ["a"]) == {"a": 1.5}
    assert reports.saved_bounds(spark, path, ["a", "b"]) is None


def test_tables(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert tables.ensure_table(spark, "stored_rows", build).count() == 3
    assert tables.ensure_table(spark, "stored_rows", build).count() == 3
    assert len(calls) == 1
    tables.ensure_table(spark, "stored_rows", build, refresh=True)
    assert len(calls) == 2
    assert tables.replace_table(spark.range(5), "stored_rows").count() == 5
    spark.sql("DROP TABLE stored_rows")


def test_materialise_uses_the_session_folder(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "materialised"
    before = set(folder.iterdir()) if folder.exists() else set()
    stored = tables.materialise(spark.range(4))
    assert stored.count() == 4
    assert len(set(folder.iterdir()) - before) == 1


def test_errors_are_raised(spark, tmp_path):
    with pytest.raises((AnalysisException, PySparkException)):
        ingest.ingest_parquet(spark, [str(tmp_path / "absent.parquet")])


def test_a_day_holding_a_third_of_all_rows(spark):
    """Totals of a heavy day equal a plain count, and neither way to them gathers its rows."""
    facts = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2019-05-04")).otherwise(F.date_add(F.lit("2019-01-01").cast("date"), (F.col("id") % 365).cast("int")).cast("string")).cast("date").alias("date"),
        ((F.col("id") % 1000) / 100).alias("x"),
    )
    days = facts.select("date").distinct().withColumn("prcp", F.lit(0.0))
    metrics = [daily.Metric("avg_x", F.col("x"))]
    by_join = daily.daily_totals(daily.join_daily(facts, days), metrics, ["prcp"])
    by_sum = daily.joined_totals(facts, days, metrics, ["prcp"])
    columns = ["date", "prcp", "trip_count", "total_avg_x"]
    wanted = {}
    for row in facts.collect():
        n, total = wanted.get(row.date, (0, 0))
        wanted[row.date] = (n + 1, total + round(row.x * 100))
    for found in (by_join, by_sum):
        assert {row.date: (row.trip_count, round(row.total_avg_x * 100)) for row in found.select(columns).collect()} == wanted
    plan = by_sum._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > 0 and plan.count("partial_count") >= 1


def test_an_order_holding_a_third_of_all_lines(spark, tmp_path):
    """The join of lines with orders gives every line once, whatever the order it belongs to."""
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 100)
    lines = spark.range(9000).select(
        key.alias("l_orderkey"), F.col("id").alias("l_linenumber"), *[F.lit(1.0).alias(name) for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        F.lit("A").alias("l_returnflag"), F.lit("2019-01-01").cast("timestamp").alias("l_shipdate"),
    )
    orders = spark.range(100).select(
        F.col("id").alias("o_orderkey"), F.lit("2019-01-01").cast("timestamp").alias("o_orderdate"), F.lit("F").alias("o_orderstatus"),
        F.lit("5-LOW").alias("o_orderpriority"), F.col("id").cast("double").alias("o_totalprice"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = star.order_lines(spark, str(tmp_path)).groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("p"))
    rows = {row.l_orderkey: (row.n, row.p) for row in found.collect()}
    assert sum(n for n, _ in rows.values()) == 9000 and rows[1] == (3060, 1.0) and all(p == k for k, (_, p) in rows.items())
