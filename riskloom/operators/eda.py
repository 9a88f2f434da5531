"""Exploratory aggregates over transactions joined with their label and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import clip, differs
from riskloom.operators.ordered import exact_quantiles


def star(transactions: DataFrame, ground_truth: DataFrame, merchants: DataFrame,
         customers: DataFrame) -> DataFrame:
    """Transactions with label, merchant category and home country (inner joins)."""
    return (
        transactions
        .join(ground_truth.select("transaction_id", "fraud_label"), "transaction_id")
        .join(merchants.select("merchant_id", "merchant_category"), "merchant_id")
        .join(customers.select("customer_id", "home_country"), "customer_id")
    )


def prevalence(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.avg("fraud_label").alias("prevalence"),
        F.sum("fraud_label").alias("positives"),
        F.count("*").alias("total"),
    )


def rate_by(labelled: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Mean label per value, highest first."""
    rates = labelled.groupBy(column).agg(F.avg("fraud_label").alias("fraud_rate"))
    ordered = rates.orderBy(F.desc("fraud_rate"), column)
    return ordered.limit(top) if top else ordered


def rate_by_hour(labelled: DataFrame, top: int = 6) -> DataFrame:
    return rate_by(labelled.withColumn("hour", F.hour("timestamp").cast("bigint")), "hour", top)


def median_amount(labelled: DataFrame, rows_bound: int | None = None, **limits) -> DataFrame:
    """Exact median amount per label."""
    return exact_quantiles(labelled, ["fraud_label"], "amount", [0.5], rows_bound=rows_bound,
                           **limits).select("fraud_label", F.col("quantile").alias("median_amount"))


def amount_histogram(labelled: DataFrame, bins: int = 50, upper: float = 1000.0) -> DataFrame:
    """Counts of the clipped amount in equal bins over each label's own range.

    The last bin includes its right edge. Empty bins are not listed.
    """
    clipped = labelled.select("fraud_label", clip("amount", upper=upper).alias("x"))
    # Two labels: the range table has two rows.
    ranges = clipped.groupBy("fraud_label").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    # A range of zero width is widened by half a unit on both sides.
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.select("fraud_label",
                           F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                           F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    place = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    return (
        clipped.join(F.broadcast(ranges), "fraud_label")
        .groupBy("fraud_label", F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def flag_lift(labelled: DataFrame, flags: list[str]) -> DataFrame:
    """Mean label with the flag on and off, and their ratio, for every flag in one pass."""
    rates = labelled.agg(*[
        F.avg(F.when(F.col(f) == on, F.col("fraud_label"))).alias(f"{f}_{on}")
        for f in flags for on in (0, 1)
    ])
    lines = F.array(*[
        F.struct(F.lit(f).alias("flag"), F.col(f"{f}_1").alias("rate_flagged"),
                 F.col(f"{f}_0").alias("rate_not_flagged"))
        for f in flags
    ])
    return rates.select(
        F.inline(lines).alias("flag", "rate_flagged", "rate_not_flagged")
    ).withColumn("lift", F.try_divide("rate_flagged", "rate_not_flagged"))


def with_flags(star_rows: DataFrame, features: DataFrame) -> DataFrame:
    """The star join plus the three flags the lift report looks at."""
    return star_rows.join(
        features.select("transaction_id", "is_new_device"), "transaction_id"
    ).select(
        "fraud_label", "is_new_device",
        differs("country", "ip_country").alias("ip_mismatch"),
        differs("country", "home_country").alias("is_cross_border"),
    )
