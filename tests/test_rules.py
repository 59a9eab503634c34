import pytest
from pyspark.sql import functions as F

from sievemark.operators import rules
from sievemark.operators.rules import Rule

@pytest.fixture
def listed(spark):
    default = Rule("c default", "c", rules.null_default_in(F.col("c"), 0.0, (0.0, 1.0)))
    return [rules.above("a", 0), rules.one_of("b", "x", "y"), default]


ROWS = [
    (1, "x", 0.0),  # passes
    (1, "y", None),  # passes, c stays NULL
    (-1, "x", 1.0),  # fails a only
    (None, "x", 1.0),  # NULL fails a only
    (1, "z", 1.0),  # fails b only
    (-1, None, 2.0),  # fails all
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "a int, b string, c double")


def impact(df, listed):
    return {row.column_name: row for row in rules.rule_impact(df, listed).collect()}


def test_filter_and_audit_agree(spark, listed):
    df = frame(spark)
    totals = rules.rule_totals(df, listed).first()
    kept = rules.apply_rules(df, listed).collect()
    assert totals.clean_count == len(kept) == 2
    assert totals.raw_count == 6 and totals.removed_count == 4 and totals.rule_count == 3
    assert [row.c for row in kept] == [0.0, None]


def test_null_predicate_is_a_failure(spark, listed):
    found = impact(frame(spark), listed)
    assert (found["a"].invalid_count, found["a"].exclusive_removed_count, found["a"].shared_removed_count) == (3, 2, 1)
    assert (found["b"].invalid_count, found["b"].exclusive_removed_count) == (2, 1)
    assert (found["c"].invalid_count, found["c"].exclusive_removed_count) == (1, 0)
    assert found["a"].invalid_percentage == 50.0


def test_impact_order_is_stable(spark, listed):
    order = [row.column_name for row in rules.rule_impact(frame(spark), listed).collect()]
    assert order == ["a", "b", "c"]
    ties = [row.column_name for row in rules.rule_impact(frame(spark, [(1, "x", 0.0)]), listed).collect()]
    assert ties == ["a", "b", "c"]


def test_all_fail_and_empty(spark, listed):
    assert rules.rule_totals(frame(spark, [(-1, "q", 9.0)]), listed).first().removed_percentage == 100.0
    empty = rules.rule_totals(frame(spark, []), listed).first()
    assert (empty.raw_count, empty.clean_count, empty.removed_percentage) == (0, 0, 0.0)
    audit = rules.removal_audit(frame(spark, []), listed).first()
    assert (audit.input_rows, audit.output_rows, audit.removed_percent) == (0, 0, 0.0)


def test_removal_audit(spark, listed):
    audit = rules.removal_audit(frame(spark), listed).first()
    assert (audit.input_rows, audit.output_rows, audit.removed_rows) == (6, 2, 4)


def test_rule_page(spark):
    many = [Rule(f"r{k}", "a", F.col("a") > k) for k in range(10)]
    audit = rules.rule_impact(spark.createDataFrame([(v,) for v in range(11)], "a int"), many)
    first = [row.rule_name for row in rules.rule_page(audit).collect()]
    second = [row.rule_name for row in rules.rule_page(audit, page=1).collect()]
    assert first == [f"r{k}" for k in range(9, 1, -1)]
    assert second == ["r1", "r0"]


def test_shift_only_inside_the_test(spark):
    df = spark.createDataFrame([(2.5, -1.0), (2.0, -1.0)], "extra double, fare double")
    shifted = Rule("fare", "fare", rules.shifted_when(F.col("extra"), 2.5, F.col("fare"), 2.5) > 0)
    assert [tuple(row) for row in rules.apply_rules(df, [shifted]).collect()] == [(2.5, -1.0)]


def test_rules_reach_the_scan(spark, listed, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "t"))
    plan = rules.apply_rules(spark.read.parquet(str(tmp_path / "t")), listed[:2], ["a"])._jdf.queryExecution().toString()
    assert "GreaterThan(a,0)" in plan and "In(b, [x,y])" in plan
