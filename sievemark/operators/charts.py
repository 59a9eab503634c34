"""Report rows derived from profiles: the 'Other' bucket, range labels, range summary and chart rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import pct, plain_number, round_scaled
from .profile import NumericProfile, value_kind

# A column with more values than this hides those whose rounded share is 0; a chart with more points
# than CROWDED_POINTS drops a zero bar holding more than DOMINANT_PERCENT.
MANY_VALUES = 20
CROWDED_POINTS = 15
DOMINANT_PERCENT = 50.0


def other_bucket(counts: DataFrame, min_percent_above: float | None = None) -> DataFrame:
    """Fold hidden values of each column into one 'Other (n values)' row placed last.

    ``counts`` are value counts; shares are compared at 2 decimals. With ``min_percent_above`` only larger shares
    stay. The hidden rows are folded by a partial aggregation, so a column with many values is no burden. The numbers of
    values, one for each column, come from the same shuffle of counts, which is read twice and made once.
    """
    sizes = counts.groupBy("column_name").agg(F.count_if(F.col("count") > 0).alias("held"))
    sized = counts.join(F.broadcast(sizes.withColumnRenamed("column_name", "sized_name")), F.col("column_name") == F.col("sized_name"))
    rounded = sized.drop("sized_name").withColumn("percent", round_scaled(F.col("percentage")))
    shown = F.col("percent") > F.lit(min_percent_above) if min_percent_above is not None else F.lit(True)
    shown = shown & ((F.col("held") <= MANY_VALUES) | (F.col("percent") > 0))
    flagged = rounded.withColumn("shown", shown)
    hundredths = F.rint(F.col("percent") * 100).cast("bigint")
    folded = flagged.groupBy(
        "column_name",
        F.when(F.col("shown"), value_kind()).otherwise(3).alias("row_kind"),
        F.when(F.col("shown"), F.col("numeric_value")).alias("numeric_value"),
        F.when(F.col("shown"), F.coalesce("value", F.lit("null"))).alias("label"),
    ).agg(F.count(F.lit(1)).alias("values"), F.sum("count").alias("count"), (F.sum(hundredths) / 100).alias("percent"))
    other = F.format_string("Other (%d values)", F.col("values"))
    return folded.orderBy("column_name", "row_kind", "numeric_value", "label").select(
        "column_name", F.coalesce("label", other).alias("label"), "count", "percent", "row_kind"
    )


def labeled_bins(bins: DataFrame) -> DataFrame:
    """Bin rows with their range as '(left, right]' at 2 decimals, computed from the bin number."""
    width = F.col("bin_edge") / F.col("bucket")
    left = F.when(F.col("bucket") == 1, F.lit(0.0)).otherwise((F.col("bucket") - 1) * width)
    return bins.select(
        "column_name",
        F.col("bucket").alias("row_order"),
        F.format_string("(%.2f, %.2f]", round_scaled(left), round_scaled(F.col("bin_edge"))).alias("label"),
        F.col("bin_count").alias("count"),
        F.col("bin_percentage").alias("percent"),
    )


def labeled_histogram(profile: NumericProfile) -> DataFrame:
    """The range summary (negative, zero, above the chart maximum) followed by the labeled bins.

    The negative row is left out when there are none and the minimum is not negative.
    """
    summary = profile.summary.withColumn("total", F.lit(profile.row_count))
    low, chart, high = (plain_number(round_scaled(F.col(n))) for n in ("min_value", "chart_max_value", "max_value"))
    entries = F.array(
        F.struct(
            F.lit(-2).alias("row_order"),
            F.concat(F.lit("["), low, F.lit(", 0)")).alias("label"),
            F.col("negative_count").alias("count"),
        ),
        F.struct(F.lit(-1).alias("row_order"), F.lit("0").alias("label"), F.col("zero_count").alias("count")),
        F.struct(
            F.lit(0).alias("row_order"),
            F.concat(F.lit("("), chart, F.lit(", "), high, F.lit("]")).alias("label"),
            F.col("above_chart_max_value_count").alias("count"),
        ),
    )
    rows = (
        summary.select("column_name", "min_value", "total", F.inline(entries))
        .where(~((F.col("row_order") == -2) & (F.col("count") == 0) & (F.col("min_value") >= 0)))
        .select("column_name", "row_order", "label", "count", pct(F.col("count"), F.col("total")).alias("percent"))
    )
    return rows.unionByName(labeled_bins(profile.bins)).orderBy("column_name", "row_order")


def chart_rows(profile: NumericProfile) -> DataFrame:
    """Bars of a histogram chart: the zero bar first unless it dominates a crowded chart, the bins, the rest above."""
    summary = profile.summary.withColumn("total", F.lit(profile.row_count))
    points = F.col("range_count")  # the bins, the zero bar and the bar above
    zero_percent = pct(F.col("zero_count"), F.col("total"))
    entries = F.array(
        F.struct(F.lit(0).alias("row_order"), F.lit("0").alias("label"), F.col("zero_count").alias("count")),
        F.struct(
            F.col("range_count").cast("int").alias("row_order"),
            plain_number(round_scaled(F.col("max_value"))).alias("label"),
            F.col("above_chart_max_value_count").alias("count"),
        ),
    )
    outer = (
        summary.withColumn("crowded", (points > CROWDED_POINTS) & (zero_percent > DOMINANT_PERCENT))
        .select("column_name", "total", "crowded", F.inline(entries))
        .where(~(F.col("crowded") & (F.col("row_order") == 0)))
        .select("column_name", "row_order", "label", "count", pct(F.col("count"), F.col("total")).alias("percent"))
    )
    return outer.unionByName(labeled_bins(profile.bins)).orderBy("column_name", "row_order")
