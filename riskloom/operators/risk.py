"""Scores from weighted columns: z-scores, weighted sums, prior shift; table fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import sigmoid
from riskloom.session import durable

MIN_DEVIATION = 1e-9


def with_zscores(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``z_<column>``: centred and scaled by the population standard deviation.

    A (nearly) constant column is only centred.
    """
    moments = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    )
    facts = moments.select(F.struct("*")).scalar()  # one row
    scaled = df.withColumn("__m", facts)

    def z(c: str) -> Column:
        sd = F.col(f"__m.s_{c}")
        return (F.col(c) - F.col(f"__m.m_{c}")) / F.when(sd > MIN_DEVIATION, sd).otherwise(1.0)

    return scaled.select(*df.columns, *[z(c).alias(f"z_{c}") for c in columns])


def weighted_score(rows: DataFrame, weights: dict[str, float], scaled: list[str],
                   output: str = "z") -> DataFrame:
    """Add the weighted sum of columns, those in ``scaled`` as z-scores over all rows."""
    ready = with_zscores(rows, scaled)
    terms = [F.col(f"z_{c}" if c in scaled else c) * w for c, w in weights.items()]
    return ready.withColumn(output, sum(terms[1:], terms[0]))


def prior_shift(scores: DataFrame, target_rate: float, z: str = "z", low: float = -15.0,
                high: float = 5.0, tolerance: float = 1e-13, rounds: int = 60) -> DataFrame:
    """The intercept in [low, high] that brings mean(sigmoid(intercept + z)) to ``target_rate``.

    The mean rises with the intercept, so a bracket always holds the answer. Each round is
    one aggregate giving the mean and its slope: a Newton step where it stays inside the
    bracket, halving otherwise. Some six rounds over one narrow column reach the precision
    of fifty halvings.
    """
    values = durable(scores.select(F.col(z).cast("double").alias("z")))
    at = (low + high) / 2
    for _ in range(rounds):
        p = sigmoid(F.col("z") + at)
        mean, slope = values.agg(F.avg(p), F.avg(p * (1 - p))).first()
        if mean is None:
            break
        low, high = (at, high) if mean < target_rate else (low, at)
        step = (target_rate - mean) / slope if slope else float("inf")
        proposal = at + step if low < at + step < high else (low + high) / 2
        moved, at = abs(proposal - at), proposal
        if moved < tolerance:
            break
    return values.agg(
        F.lit(at).alias("intercept"),
        F.avg(sigmoid(F.col("z") + at)).alias("mean_probability"),
        F.count("*").alias("rows"),
    )


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Row count and an order-insensitive content hash of a table.

    Rows are hashed one by one and the hashes added, so layout and order do not matter.
    """
    columns = columns or df.columns
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.sum(number).cast("string").alias("content_hash"))
