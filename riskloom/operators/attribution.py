"""Per-row attribution of linear and tree models and its global summary.

For a linear model the contribution of a feature, in log-odds, is
coefficient x (value - background mean), so the whole table is one projection. Tree models
are explained along their paths (``trees``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators import model, trees


def with_contributions(matrix: DataFrame, coefficients: dict[str, float],
                       background: DataFrame) -> DataFrame:
    """Add ``contributions``: an array of (feature, value) in coefficient order.

    ``background`` holds reference rows of the same matrix; only their means matter.
    """
    means = background.agg(*[F.avg(c).alias(c) for c in coefficients]).first()
    parts = [
        F.struct(F.lit(c).alias("feature"),
                 ((F.col(c) - F.lit(means[c])) * w).cast("double").alias("value"))
        for c, w in coefficients.items()
    ]
    return matrix.select(*matrix.columns, F.array(*parts).alias("contributions"))


def explained(classifier: model.Classifier, rows: DataFrame, inputs: list[str],
              background: DataFrame) -> DataFrame:
    """Add the contributions of any trained classifier; only linear ones use ``background``."""
    if model.is_linear(classifier):
        return with_contributions(rows, model.linear_coefficients(classifier, inputs), background)
    return trees.with_tree_contributions(rows, model.tree_ensemble(classifier, inputs))


def top_features(contributions: str | Column = "contributions", k: int = 5) -> Column:
    """The ``k`` entries of largest magnitude, largest first; ties keep feature order.

    ``sort_array`` compares in compiled code, ``array_sort`` evaluates a lambda per comparison.
    """
    items = F.col(contributions) if isinstance(contributions, str) else contributions
    ranked = F.transform(items, lambda x, i: F.struct(
        (-F.abs(x["value"])).alias("rank"), i.alias("place"), x.alias("item")))
    return F.slice(F.sort_array(ranked), 1, k).getField("item")


def as_map(items: Column) -> Column:
    return F.map_from_entries(items)


def global_importance(rows: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return rows.select(F.inline("contributions")).groupBy("feature").agg(
        F.avg(F.abs("value")).alias("mean_abs_contribution")
    ).orderBy(F.desc("mean_abs_contribution"), "feature")
