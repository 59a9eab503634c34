"""Declarative row rules: one list drives both the filter and the audit of what the filter removes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import pct


@dataclass(frozen=True)
class Rule:
    """A row passes when ``passes`` is true; a NULL result is a failure."""

    name: str
    column: str
    passes: Column


def shifted_when(trigger: Column, threshold: float, value: Column, shift: float) -> Column:
    """``value + shift`` where ``trigger`` reaches ``threshold``, else ``value``; for use inside a test only."""
    return F.when(trigger >= F.lit(threshold), value + F.lit(shift)).otherwise(value)


def null_default_in(value: Column, default: float, allowed: Sequence[float]) -> Column:
    """Membership test with NULL read as ``default``; the stored value is left alone."""
    return F.coalesce(value, F.lit(default)).isin(*allowed)


def apply_rules(df: DataFrame, rules: Sequence[Rule], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows passing every rule, optionally projected to ``columns``."""
    kept = df.where(reduce(lambda a, b: a & b, [rule.passes for rule in rules])) if rules else df
    return kept.select(*columns) if columns else kept


def failure_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: row count, clean rows, and per rule the rows failing it (``i_k``) and failing only it (``e_k``).

    The failure flags are projected once and summed in a single pass with map-side partial sums, so the shuffle
    carries one row per input partition.
    """
    keys = range(len(rules))
    flags = df.select(*[F.when(rule.passes, F.lit(0)).otherwise(F.lit(1)).alias(f"f_{k}") for k, rule in enumerate(rules)])
    fails = reduce(lambda a, b: a + b, [F.col(f"f_{k}") for k in keys], F.lit(0))
    return flags.withColumn("fails", fails).agg(
        F.count(F.lit(1)).alias("raw_count"),
        F.count_if(F.col("fails") == 0).alias("clean_count"),
        *[F.count_if(F.col(f"f_{k}") == 1).alias(f"i_{k}") for k in keys],
        *[F.count_if((F.col(f"f_{k}") == 1) & (F.col("fails") == 1)).alias(f"e_{k}") for k in keys],
    )


def removal_audit(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: input, output and removed rows of a filter step, from one scan."""
    passed = reduce(lambda a, b: a & b, [rule.passes for rule in rules], F.lit(True))
    counts = df.agg(F.count(F.lit(1)).alias("input_rows"), F.count_if(passed).alias("output_rows"))
    removed = F.col("input_rows") - F.col("output_rows")
    return counts.select(
        "input_rows", "output_rows", removed.alias("removed_rows"), pct(removed, F.col("input_rows")).alias("removed_percent")
    )


def rule_totals(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: raw, clean and removed rows and the number of rules."""
    return totals_of(failure_counts(df, rules), rules)


def rule_impact(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows failing it, failing only it, and failing it together with others.

    Ordered by exclusive count descending, then by rule position.
    """
    return impact_of(failure_counts(df, rules), rules)


def totals_of(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule_totals`` from the row of ``failure_counts``."""
    removed = F.col("raw_count") - F.col("clean_count")
    return counts.select(
        "raw_count",
        "clean_count",
        removed.alias("removed_count"),
        pct(removed, F.col("raw_count")).alias("removed_percentage"),
        F.lit(len(rules)).cast("bigint").alias("rule_count"),
    )


def impact_of(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule_impact`` from the row of ``failure_counts``."""
    entries = F.array(
        *[
            F.struct(
                F.lit(k).alias("rule_index"),
                F.lit(rule.name).alias("rule_name"),
                F.lit(rule.column).alias("column_name"),
                F.col(f"i_{k}").alias("invalid_count"),
                F.col(f"e_{k}").alias("exclusive_removed_count"),
            )
            for k, rule in enumerate(rules)
        ]
    )
    shared = F.col("invalid_count") - F.col("exclusive_removed_count")
    shares = {
        "invalid_percentage": "invalid_count",
        "exclusive_removed_percentage": "exclusive_removed_count",
        "shared_removed_percentage": "shared_removed_count",
    }
    return (
        counts.select("raw_count", F.inline(entries))
        .withColumn("shared_removed_count", shared)
        .select(
            "rule_index",
            "rule_name",
            "column_name",
            "invalid_count",
            "exclusive_removed_count",
            "shared_removed_count",
            *[pct(F.col(part), F.col("raw_count")).alias(name) for name, part in shares.items()],
        )
        .orderBy(F.desc("exclusive_removed_count"), "rule_index")
    )


def rule_page(impact: DataFrame, page: int = 0, page_size: int = 8) -> DataFrame:
    """One page of rules by total removed rows (exclusive + shared) descending; ties keep the impact order."""
    removed = F.col("exclusive_removed_count") + F.col("shared_removed_count")
    ordered = impact.withColumn("total_removed_count", removed).orderBy(
        F.desc("total_removed_count"), F.desc("exclusive_removed_count"), "rule_index"
    )
    return ordered.offset(page * page_size).limit(page_size)


# --- rule builders: name and predicate from the same arguments ----------------------------------------------------


def one_of(column: str, *allowed) -> Rule:
    return Rule(f"{column} in {allowed!r}", column, F.col(column).isin(*allowed))


def within(column: str, low, high) -> Rule:
    return Rule(f"{column} between {low} and {high}", column, F.col(column).between(low, high))


def equal_to(column: str, value) -> Rule:
    return Rule(f"{column} = {value}", column, F.col(column) == F.lit(value))


def above(column: str, bound) -> Rule:
    return Rule(f"{column} > {bound}", column, F.col(column) > F.lit(bound))


def at_least(column: str, bound) -> Rule:
    return Rule(f"{column} >= {bound}", column, F.col(column) >= F.lit(bound))


def in_years(column: str, first: int, last: int, type_name: str) -> list[Rule]:
    """Two rules: from January 1 of ``first``, and before January 1 of the year after ``last``."""
    start, end = f"{first}-01-01", f"{last + 1}-01-01"
    return [
        Rule(f"{column} >= {start}", column, F.col(column) >= F.lit(start).cast(type_name)),
        Rule(f"{column} < {end}", column, F.col(column) < F.lit(end).cast(type_name)),
    ]


def earlier(label: str, first: str, second: str) -> Rule:
    return Rule(f"{first} < {second}", label, F.col(first) < F.col(second))


def never_both(label: str, name: str, first: Column, second: Column) -> Rule:
    """Fails where both conditions hold."""
    return Rule(name, label, ~(first & second))
