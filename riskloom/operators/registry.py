"""Comparing candidate models: newest run per name, the champion, the promotion gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of every candidate name."""
    picked = runs.groupBy("name").agg(
        F.max_by(F.struct(*runs.columns), F.struct("start_time", "run_id")).alias("r"))
    return picked.select("r.*")


def champion(runs: DataFrame, order: list[str]) -> DataFrame:
    """The best candidate by validation metric; ties go to the earlier name in ``order``."""
    place = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("name"))
    return runs.withColumn("__place", place).where(F.col("__place") > 0).orderBy(
        F.desc("val_pr_auc"), "__place").limit(1).drop("__place")


def candidate_comparison(runs: DataFrame, order: list[str]) -> DataFrame:
    """Newest run per candidate, with the one to deploy marked."""
    latest = newest_runs(runs).where(F.col("name").isin(order))
    deployed = champion(latest, order).select("name").scalar()
    return latest.select("name", "run_id", "val_pr_auc",
                         (F.col("name") == deployed).alias("is_deployed"))


def promotion_gate(candidates: DataFrame, current: DataFrame, force: bool = False) -> DataFrame:
    """Whether each candidate may replace the current champion: its metric is at least as
    good, there is no champion yet, or the promotion is forced."""
    bar = current.agg(F.max("val_pr_auc")).scalar()
    return candidates.withColumn("champion_val_pr_auc", bar).withColumn(
        "may_promote",
        F.lit(force) | F.col("champion_val_pr_auc").isNull()
        | (F.col("val_pr_auc") >= F.col("champion_val_pr_auc")),
    )


def policy_matches_model(decisions: DataFrame, policies: DataFrame) -> DataFrame:
    """Decisions per model run, and whether the policy in force was computed for that run."""
    policy_run = policies.select("model_run_id").scalar()
    return decisions.groupBy("model_run_id").agg(F.count("*").alias("decisions")).withColumn(
        "policy_matches", F.col("model_run_id").eqNullSafe(policy_run))
