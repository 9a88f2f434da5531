"""Cost of a review/block policy and the search for the cheapest one.

Costs depend on a score only through which grid thresholds it reaches, so one pass
counts rows per grid cell and everything after that works on a table as small as
the grid.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.scalar import money
from riskloom.session import durable

# The cost matrix. A missed fraud costs its own amount.
REVIEW_COST = "3.50"
FALSE_POSITIVE_COST = "25.00"


def _cost(value: str | float) -> Column:
    return F.lit(str(value)).cast("decimal(18,2)")


def total_cost(scored: DataFrame, t_review: float, t_block: float,
               review_cost: str = REVIEW_COST,
               false_positive_cost: str = FALSE_POSITIVE_COST) -> DataFrame:
    """One row: the realised cost of the policy and its three parts."""
    s, fraud = F.col("model_score"), F.col("fraud_label") == 1
    missed = F.coalesce(F.sum(F.when((s < t_review) & fraud, money("amount"))), F.lit(0))
    reviewed = F.count_if((s >= t_review) & (s < t_block))
    blocked_legit = F.count_if((s >= t_block) & ~fraud)
    parts = scored.agg(
        missed.alias("missed_fraud"),
        (reviewed * _cost(review_cost)).alias("review_cost"),
        (blocked_legit * _cost(false_positive_cost)).alias("false_positive_cost"),
    )
    total = F.col("missed_fraud") + F.col("review_cost") + F.col("false_positive_cost")
    return parts.select(
        *[F.col(c).cast("double").alias(c) for c in parts.columns],
        total.cast("double").alias("total_cost"),
    )


def grid_size(step: float) -> int:
    """Thresholds 0, step, 2 step, ... up to and including 1."""
    return math.ceil((1.0 + step) / step)


def _reached(score: Column, step: float, count: int, rounded: bool) -> Column:
    """How many of the grid thresholds the score reaches.

    The division only guesses; the comparison with the threshold itself decides.
    """
    def threshold(i: Column) -> Column:
        value = i * F.lit(step)
        return F.round(value, 4) if rounded else value

    guess = F.floor(score / step)
    exact = (
        F.when(score >= threshold(guess + 1), guess + 2)
        .when(score >= threshold(guess), guess + 1)
        .otherwise(guess)
    )
    return F.greatest(F.least(exact, F.lit(count)), F.lit(0)).cast("int")


def score_histogram(scored: DataFrame, step: float = 0.01) -> DataFrame:
    """Rows, legitimate rows and fraud amount per grid cell (at most a few hundred rows).

    ``b`` counts grid thresholds reached; ``b4`` the same after rounding them to 4 digits,
    which is how a chosen block threshold is stored. The result is written once: it is read
    several times, and the scored rows only here.
    """
    n = grid_size(step)
    s = F.col("model_score").cast("double")
    counted = scored.groupBy(
        _reached(s, step, n, False).alias("b"), _reached(s, step, n, True).alias("b4")
    ).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("fraud_label") == 0).alias("legit"),
        F.coalesce(F.sum(F.when(F.col("fraud_label") == 1, money("amount"))), F.lit(0))
        .alias("fraud_amount"),
    )
    return durable(counted)


def best_thresholds(scored: DataFrame, step: float = 0.01,
                    review_cost: str = REVIEW_COST,
                    false_positive_cost: str = FALSE_POSITIVE_COST) -> DataFrame:
    """The cheapest pair t_review < t_block; ties go to the smaller t_review, then t_block."""
    return _best(score_histogram(scored, step), step, review_cost, false_positive_cost)


def _best(cells: DataFrame, step: float, review_cost: str = REVIEW_COST,
          false_positive_cost: str = FALSE_POSITIVE_COST) -> DataFrame:
    return _search(cells, step, review_cost, false_positive_cost).select(
        F.round(F.col("i") * F.lit(step), 4).alias("t_review"),
        F.round(F.col("j") * F.lit(step), 4).alias("t_block"),
        F.col("cost").cast("double").alias("total_cost"),
    )


def _per_threshold(cells: DataFrame, step: float) -> DataFrame:
    """``cells`` summed per ``b`` with every ``b`` from 0 to the grid size present, as ``i``.

    Cell i holds the scores that reach i thresholds, so those below threshold i are the
    cells up to and including i.
    """
    n = grid_size(step)
    every = cells.sparkSession.range(0, n + 1, 1, 1).select(F.col("id").cast("int").alias("i"))
    columns = [c for c in cells.columns if c not in ("b", "b4")]
    sums = cells.groupBy("b").agg(*[F.sum(c).alias(c) for c in columns])
    return every.join(sums, F.col("i") == F.col("b"), "left").drop("b").fillna(0)


def _up_to(column: str) -> Column:
    """Total up to and including cell i. The window runs over one row per threshold."""
    return F.sum(column).over(W.orderBy("i").rowsBetween(W.unboundedPreceding, 0))


def _above(column: str) -> Column:
    after = W.orderBy("i").rowsBetween(1, W.unboundedFollowing)
    return F.coalesce(F.sum(column).over(after), F.lit(0))


def _search(cells: DataFrame, step: float, review_cost: str,
            false_positive_cost: str) -> DataFrame:
    n = grid_size(step)
    dense = _per_threshold(cells, step).select(
        "i",
        _up_to("fraud_amount").alias("missed"),
        _up_to("n").alias("below"),
        _above("legit").alias("legit_above"),
    ).where(F.col("i") < n)
    # The cost falls apart into a part of t_review and a part of t_block, so the best
    # t_review below each t_block is a running minimum; ties go to the smaller one.
    review = F.struct((F.col("missed") - F.col("below") * _cost(review_cost)).alias("part"), "i")
    earlier = W.orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    pairs = dense.withColumn("low", F.min(review).over(earlier)).where("low is not null")
    cost = (F.col("low.part") + F.col("below") * _cost(review_cost)
            + F.col("legit_above") * _cost(false_positive_cost))
    return pairs.select(F.col("low.i").alias("i"), F.col("i").alias("j"), cost.alias("cost")).orderBy(
        "cost", "i", "j").limit(1)


def cost_curve(scored: DataFrame, step: float = 0.01, review_cost: str = REVIEW_COST,
               false_positive_cost: str = FALSE_POSITIVE_COST) -> DataFrame:
    """Cost at every t_review below the chosen (rounded) t_block: t_review, cost, t_block."""
    return _curve(score_histogram(scored, step), step, review_cost, false_positive_cost)


def _curve(cells: DataFrame, step: float, review_cost: str = REVIEW_COST,
           false_positive_cost: str = FALSE_POSITIVE_COST) -> DataFrame:
    j = _search(cells, step, review_cost, false_positive_cost).select("j").scalar()
    blocked = F.col("b4") > j
    split = cells.select(
        "b", "fraud_amount",
        F.when(blocked, 0).otherwise(F.col("n")).alias("open"),
        F.when(blocked, F.col("legit")).otherwise(0).alias("blocked_legit"))
    everywhere = W.partitionBy(F.lit(0))
    curve = _per_threshold(split, step).select(
        "i", j.alias("j"),
        _up_to("fraud_amount").alias("missed"),
        _above("open").alias("reviewed"),
        F.sum("blocked_legit").over(everywhere).alias("blocked_legit"),
    )
    t_review, t_block = F.col("i") * F.lit(step), F.round(F.col("j") * F.lit(step), 4)
    cost = (
        F.col("missed") + F.col("reviewed") * _cost(review_cost)
        + F.col("blocked_legit") * _cost(false_positive_cost)
    )
    return curve.where((F.col("i") < grid_size(step)) & (t_review < t_block)).select(
        F.round(t_review, 4).alias("t_review"), cost.cast("double").alias("cost"),
        t_block.alias("t_block"))


def policy_document(scored: DataFrame, model_run_id: str, step: float = 0.01) -> DataFrame:
    """The chosen policy as one nested row, ready to be written as a JSON document."""
    cells = score_histogram(scored, step)
    best = _best(cells, step)
    curve = _curve(cells, step).agg(
        F.array_sort(F.collect_list(F.struct("t_review", "cost"))))  # one entry per threshold
    return best.select(
        "t_review", "t_block", "total_cost", curve.scalar().alias("cost_curve"),
        F.lit(model_run_id).alias("model_run_id"),
        F.create_map(
            F.lit("review_cost"), F.lit(REVIEW_COST),
            F.lit("false_positive_cost"), F.lit(FALSE_POSITIVE_COST),
            F.lit("false_negative_cost"), F.lit("transaction amount"),
        ).alias("cost_matrix"),
    )


def cost_at(requests: DataFrame, curve: DataFrame, at: str = "t") -> DataFrame:
    """Add ``cost``: the curve read at ``at``, linear between points, flat beyond its ends.

    Without points the cost is 0. The curve has one row per grid threshold; its points become
    the split values of a Bucketizer, so each request is placed by a binary search, not a join.
    """
    found = dict(curve.select("t_review", "cost").orderBy("t_review").collect())
    if not found:
        return requests.withColumn("cost", F.lit(0.0))
    t, c = list(found), list(found.values())
    splits = [-float("inf"), *t, float("inf")]
    placed = Bucketizer(splits=splits, inputCol="__x", outputCol="__bucket",
                        handleInvalid="keep").transform(
        requests.withColumn("__x", F.col(at).cast("double")))
    # Bucket k lies between points k - 1 and k; the outer two are flat.
    pick = F.col("__bucket").cast("int")

    def ends(values: list[float]) -> tuple[Column, Column]:
        padded = F.array(*[F.lit(float(v)) for v in [values[0], *values, values[-1]]])
        return F.get(padded, pick), F.get(padded, pick + 1)

    (t0, t1), (c0, c1) = ends(t), ends(c)
    share = F.when(t1 > t0, (F.col("__x") - t0) / (t1 - t0)).otherwise(0.0)
    return placed.select(*requests.columns, (c0 + share * (c1 - c0)).alias("cost"))
