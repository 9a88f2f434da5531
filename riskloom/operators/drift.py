"""Distribution drift between a reference and a current set of feature rows.

All numeric columns are compared together in long form: one ordered pass over the
distinct values of every column gives both distance measures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import running_totals
from riskloom.schemas import NUMERIC_FEATURES

# A column counts as drifted from these distances on.
NUMERIC_THRESHOLD = 0.1
CATEGORICAL_THRESHOLD = 0.1


def _long(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of either side per column and distinct value, in one grouping."""
    def melt(df: DataFrame, side: str) -> DataFrame:
        cells = F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
            for c in columns
        ])
        return df.select(F.inline(cells).alias("column", "value"), F.lit(side).alias("side"))

    both = melt(reference, "ref").unionByName(melt(current, "cur"))
    return both.where("value is not null").groupBy("column", "value").agg(
        F.count_if(F.col("side") == "ref").alias("ref"),
        F.count_if(F.col("side") == "cur").alias("cur"))


def numeric_distances(reference: DataFrame, current: DataFrame,
                      columns: list[str] = NUMERIC_FEATURES, rows_bound: int | None = None,
                      **limits) -> DataFrame:
    """Per column: ``wasserstein`` (over the reference's standard deviation) and ``ks``.

    A constant reference column is scaled by 1. The deviation is taken around the mean, in
    a pass of its own over the reference, so it holds far from zero as well.
    """
    steps = running_totals(
        _long(reference, current, columns), ["column"], ["value"], ["ref", "cur"],
        previous="value", rows_bound=rows_bound, **limits)
    # An empty side has no shares: its distances are null.
    gap = F.abs(F.try_divide("ref_before", "ref_total") - F.try_divide("cur_before", "cur_total"))
    here = F.abs(F.try_divide(F.col("ref_before") + F.col("ref"), F.col("ref_total"))
                 - F.try_divide(F.col("cur_before") + F.col("cur"), F.col("cur_total")))
    width = F.coalesce(F.col("value") - F.col("previous_value"), F.lit(0.0))
    sums = steps.groupBy("column").agg(F.sum(gap * width).alias("area"), F.max(here).alias("ks"))
    deviations = reference.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in columns])
    sd = F.coalesce(deviations.select(F.create_map(
        *[x for c in columns for x in (F.lit(c), F.col(c))])).scalar()[F.col("column")], F.lit(0.0))
    return sums.withColumn("sd", sd).select(
        "column", (F.col("area") / F.when(F.col("sd") > 1e-9, F.col("sd")).otherwise(1.0))
        .alias("wasserstein"), "ks")


def categorical_distance(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Jensen-Shannon distance (natural logarithm) between the value shares of a column.
    A missing value is a value of its own."""
    value = F.col(column).cast("string").alias("value")
    both = reference.select(value, F.lit(1).alias("ref")).unionByName(
        current.select(value, F.lit(0).alias("ref")))
    counts = both.groupBy("value").agg(
        F.sum("ref").alias("ref"), F.count_if(F.col("ref") == 0).alias("cur"))
    totals = counts.agg(F.struct(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")))
    sized = counts.withColumn("n", totals.scalar())
    p, q = F.try_divide("ref", "n.ref"), F.try_divide("cur", "n.cur")
    middle = (p + q) / 2

    def part(x):
        return F.when(x > 0, x * F.ln(x / middle)).otherwise(0.0)

    return sized.agg(
        F.sqrt(F.greatest(F.sum(part(p) + part(q)) / 2, F.lit(0.0))).alias("js")
    ).select(F.lit(column).alias("column"), "js")


def drift_report(reference: DataFrame, current: DataFrame,
                 categorical: list[str] = ("payment_method",),
                 numeric_threshold: float = NUMERIC_THRESHOLD,
                 categorical_threshold: float = CATEGORICAL_THRESHOLD, **options) -> DataFrame:
    """Per column: method, distance and whether it drifted.

    With no current rows every distance is 0 and nothing drifted.
    """
    lines = numeric_distances(reference, current, **options).select(
        "column", F.lit("wasserstein").alias("method"), F.col("wasserstein").alias("distance"),
        F.lit(numeric_threshold).alias("threshold"))
    for c in categorical:
        lines = lines.unionByName(categorical_distance(reference, current, c).select(
            "column", F.lit("jensen_shannon").alias("method"), F.col("js").alias("distance"),
            F.lit(categorical_threshold).alias("threshold")))
    distance = F.coalesce(F.col("distance"), F.lit(0.0))
    return lines.select("column", "method", distance.alias("distance"),
                        (distance >= F.col("threshold")).alias("drifted"))


def drift_summary(report: DataFrame, current: DataFrame) -> DataFrame:
    """One row: rows checked, how many columns drifted and their share."""
    checked = current.agg(F.count("*")).scalar()
    return report.agg(
        F.count_if("drifted").alias("drifted_columns_count"),
        F.avg(F.col("drifted").cast("int")).alias("drifted_share"),
    ).select(checked.alias("checked_rows"), "drifted_columns_count", "drifted_share")
