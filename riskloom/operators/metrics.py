"""Ranking, threshold and calibration metrics, exact and per group.

Rows collapse to distinct scores before anything is ordered. All metrics take
``keys``: the columns that separate one evaluation from another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import ratio
from riskloom.operators.ordered import exact_quantiles, running_totals
from riskloom.session import durable

# The score thresholds reported on.
THRESHOLDS = [0.3, 0.5, 0.7]


def score_steps(scored: DataFrame, keys: list[str] | None = None, score: str = "model_score",
                label: str = "fraud_label", rows_bound: int | None = None, **limits) -> DataFrame:
    """Per distinct score, highest first: positives and negatives at it and above it."""
    keys = keys or []
    steps = scored.groupBy(*keys, (-F.col(score)).alias("rank")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
    )
    if rows_bound is None:
        steps = durable(steps)  # measured before they are ordered: rows are scored once for both
    return running_totals(steps, keys, ["rank"], ["pos", "neg"], rows_bound=rows_bound, **limits)


def average_precision(scored: DataFrame, keys: list[str] | None = None, **options) -> DataFrame:
    """Sum over distinct scores of (recall gained) x (precision there); 0 with no positives."""
    keys = keys or []
    above = F.col("pos_before") + F.col("pos")
    seen = above + F.col("neg_before") + F.col("neg")
    return score_steps(scored, keys, **options).groupBy(*keys).agg(
        ratio(F.sum(F.col("pos") * above / seen), F.sum("pos")).alias("average_precision")
    )


def roc_auc(scored: DataFrame, keys: list[str] | None = None, **options) -> DataFrame:
    """Chance that a positive outranks a negative, ties counting half; null if one class."""
    keys = keys or []
    wins = F.col("neg") * (F.col("pos_before") + F.col("pos") / 2)
    return score_steps(scored, keys, **options).groupBy(*keys).agg(
        F.try_divide(F.sum(wins), F.sum("pos") * F.sum("neg")).alias("roc_auc")
    )


def threshold_metrics(scored: DataFrame, keys: list[str] | None = None,
                      thresholds: list[float] = THRESHOLDS, score: str = "model_score",
                      label: str = "fraud_label") -> DataFrame:
    """Precision, recall and F1 when flagging ``score >= threshold``; 0 where undefined."""
    keys = keys or []
    flagged = [F.col(score) >= t for t in thresholds]
    positive = F.col(label) == 1
    counts = scored.groupBy(*keys).agg(
        F.count_if(positive).alias("p"),
        *[F.count_if(f).alias(f"f{i}") for i, f in enumerate(flagged)],
        *[F.count_if(f & positive).alias(f"tp{i}") for i, f in enumerate(flagged)],
    )
    lines = F.array(*[
        F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"),
                 F.col(f"f{i}").alias("flagged"))
        for i, t in enumerate(thresholds)
    ])
    return counts.select(*keys, "p", F.inline(lines).alias("threshold", "tp", "flagged")).select(
        *keys, "threshold",
        ratio("tp", "flagged").alias("precision"),
        ratio("tp", "p").alias("recall"),
        ratio(2 * F.col("tp"), F.col("flagged") + F.col("p")).alias("f1"),
    )


def calibration_curve(scored: DataFrame, bins: int = 10, score: str = "model_score",
                      label: str = "fraud_label", **options) -> DataFrame:
    """Mean score and observed rate in quantile bins of the score; empty bins drop out.

    A score belongs to the bin given by how many inner edges lie strictly below it.
    """
    inner = [i / bins for i in range(1, bins)]
    edges = [r["quantile"] for r in exact_quantiles(scored, [], score, inner, **options).collect()]
    below = [(F.lit(e) < F.col(score)).cast("int") for e in edges]  # bins - 1 of them
    return scored.where(F.col(score).isNotNull()).groupBy(sum(below, F.lit(0)).alias("bin")).agg(
        F.avg(score).alias("mean_predicted"), F.avg(label).alias("fraction_positive"),
        F.count("*").alias("rows"))


def evaluate(scored: DataFrame, keys: list[str] | None = None, **options) -> DataFrame:
    """Average precision and ROC-AUC side by side, from one ordering."""
    keys = keys or []
    above = F.col("pos_before") + F.col("pos")
    seen = above + F.col("neg_before") + F.col("neg")
    wins = F.col("neg") * (F.col("pos_before") + F.col("pos") / 2)
    return score_steps(scored, keys, **options).groupBy(*keys).agg(
        ratio(F.sum(F.col("pos") * above / seen), F.sum("pos")).alias("pr_auc"),
        F.try_divide(F.sum(wins), F.sum("pos") * F.sum("neg")).alias("roc_auc"),
    )
