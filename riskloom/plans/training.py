"""The training run: split, candidates, choice, calibration, test report, explanations."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import (
    anomaly, attribution, decisions, metrics, model, policy, registry, splits,
)
from riskloom.session import durable
from riskloom.sources import sinks


class TrainingRun:
    """Trained candidates and everything reported about them.

    A candidate is trained when it is first asked for; reports are computed when asked for.
    """

    def __init__(self, matrix: DataFrame, candidates: list[str], rounds: int, trees: int):
        self.inputs = inputs_of(matrix)
        # Read by every fit and every report, a split at a time, so written once.
        self.matrix = durable(matrix.where("fraud_label is not null"), by=["split"])
        self.candidates, self.rounds, self.trees = candidates, rounds, trees
        self._trained: dict[str, model.Classifier] = {}

    def classifier(self, name: str) -> model.Classifier:
        if name not in self._trained:
            self._trained[name] = model.train_candidate(
                name, self.part("train"), self.inputs, self.rounds, self.trees)
        return self._trained[name]

    def part(self, split: str) -> DataFrame:
        return self.matrix.where(F.col("split") == split)

    @cached_property
    def validation_metrics(self) -> DataFrame:
        """Ranking metrics of every candidate on validation, before calibration."""
        judged = None
        for name in self.candidates:
            scored = model.with_probability(self.classifier(name), self.part("val"))
            line = metrics.evaluate(scored.select("model_score", "fraud_label")).select(
                F.lit(name).alias("name"), F.col("pr_auc").alias("val_pr_auc"), "roc_auc")
            judged = line if judged is None else judged.unionByName(line)
        return durable(judged)  # one row per candidate

    def _best(self, order: list[str]) -> str:
        known = [n for n in order if n in self.candidates]
        if len(known) == 1:
            return known[0]
        return registry.champion(self.validation_metrics, known).first()["name"]

    @cached_property
    def deployed_name(self) -> str:
        return self._best(model.CANDIDATES)

    @cached_property
    def champion_name(self) -> str:
        """The better boosted candidate; the deployed one when none was trained."""
        boosted = [n for n in ("xgboost", "lightgbm") if n in self.candidates]
        return self._best(boosted) if boosted else self.deployed_name

    @cached_property
    def deployed(self) -> model.CalibratedModel:
        return model.calibrate(self.classifier(self.deployed_name), self.part("val"))

    def test_scores(self) -> DataFrame:
        """Score and label of the test rows. Written, since a report reads them several times."""
        return durable(self.deployed.score(self.part("test")).select("model_score", "fraud_label"))

    @property
    def test_metrics(self) -> DataFrame:
        return model.test_report(self.test_scores())

    @property
    def baseline_test_metrics(self) -> DataFrame:
        """The baseline after the same calibration, so that only the models differ."""
        if self.deployed_name == "baseline":
            return self.test_metrics
        baseline = model.calibrate(self.classifier("baseline"), self.part("val"))
        return model.test_report(durable(baseline.score(self.part("test")).select("model_score", "fraud_label")))

    @property
    def calibration_curve(self) -> DataFrame:
        return metrics.calibration_curve(self.test_scores())

    @cached_property
    def forest(self) -> DataFrame:
        return durable(anomaly.train(self.part("train"), self.inputs))

    @property
    def anomaly_scores(self) -> DataFrame:
        return anomaly.score(self.part("test"), self.forest, self.inputs).select(
            "transaction_id", "anomaly_score")

    @property
    def anomaly_mean(self) -> DataFrame:
        return self.anomaly_scores.agg(F.avg("anomaly_score").alias("anomaly_mean"))

    @property
    def background(self) -> DataFrame:
        return self.part("train")

    @property
    def importances(self) -> DataFrame:
        return importances(self.classifier(self.deployed_name), self.part("test"),
                           self.background, self.inputs)

    @property
    def row_counts(self) -> DataFrame:
        return self.matrix.groupBy("split").agg(F.count("*").alias("rows"))


def inputs_of(matrix: DataFrame) -> list[str]:
    return [c for c in matrix.columns if c not in ("transaction_id", "fraud_label", "split")]


def importances(classifier: model.Classifier, explained: DataFrame, background: DataFrame,
                inputs: list[str]) -> DataFrame:
    """Mean absolute attribution of each input."""
    return attribution.global_importance(
        attribution.explained(classifier, explained, inputs, background))


def run(matrix: DataFrame, candidates: list[str] = model.CANDIDATES,
        rounds: int = model.BOOSTING_ROUNDS, trees: int = model.TREES) -> TrainingRun:
    """Train the candidates on the train split of a matrix that carries transaction_id,
    fraud_label and split besides the model inputs."""
    return TrainingRun(matrix, candidates, rounds, trees)


def re_evaluate(path: str, matrix: DataFrame) -> dict[str, DataFrame]:
    """Load a stored model and rebuild its comparison figures from the given matrix."""
    stored = model.CalibratedModel.load(path)
    inputs = inputs_of(matrix)
    part = {s: matrix.where(F.col("split") == s) for s in ("train", "val", "test")}
    return {
        "validation": metrics.evaluate(stored.score(part["val"])),
        "calibration_curve": metrics.calibration_curve(durable(
            stored.score(part["test"]).select("model_score", "fraud_label"))),
        "importances": importances(stored.classifier, part["test"], part["train"], inputs),
        "background": part["train"].select(*inputs),
    }


def enrich(path: str, matrix: DataFrame, sample: int = 100) -> DataFrame:
    """Store beside a saved model what explaining and comparing it later needs: ``background``, at
    most ``sample`` training rows, and ``comparison``, one JSON document with the calibration
    curve, the importances (largest first) and the validation figure. Returns the document."""
    spark, figures = matrix.sparkSession, re_evaluate(path, matrix)
    background = decisions.sample_rows(matrix.where("split = 'train'"), sample).select(*inputs_of(matrix))
    sinks.write_parquet(background.coalesce(1), f"{path}/background")
    curve = figures["calibration_curve"].agg(F.array_sort(F.collect_list(
        F.struct("bin", "mean_predicted", "fraction_positive", "rows"))).alias("calibration_curve"))
    # One row per input.
    ranked = figures["importances"].agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("mean_abs_contribution")).alias("place"), "feature", "mean_abs_contribution"))).alias("r"))
    importances_ = ranked.select(F.transform("r", lambda x: F.struct(x["feature"], x["mean_abs_contribution"])).alias("importances"))
    document = durable(curve.select(
        "calibration_curve", importances_.scalar().alias("importances"),
        figures["validation"].select("pr_auc").scalar().alias("val_pr_auc")))
    sinks.write_json(document, f"{path}/comparison")
    return spark.read.schema(document.schema).json(f"{path}/comparison")


def choose_policy(path: str, matrix: DataFrame, amounts: DataFrame, model_run_id: str) -> DataFrame:
    """Cost-optimal thresholds of a stored model on the validation rows, as a document."""
    scored = model.CalibratedModel.load(path).score(matrix.where("split = 'val'"))
    rows = durable(scored.select("transaction_id", "fraud_label", "model_score").join(
        amounts.select("transaction_id", F.col("amount")), "transaction_id"))
    return policy.policy_document(rows, model_run_id)


def model_scorer(stored: model.CalibratedModel, inputs: list[str],
                 background: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """A scorer for batches and streams: feature rows in, ``model_score`` added.

    With a background it also adds the five largest contributions as ``shap_top_features``.
    """
    def score(rows: DataFrame) -> DataFrame:
        encoded = rows.select("*", *splits.one_hot())
        scored = stored.score(encoded)
        if background is None:
            return scored.select(*rows.columns, "model_score")
        explained = attribution.explained(stored.classifier, scored, inputs, background)
        top = attribution.as_map(attribution.top_features(k=5))
        return explained.select(*rows.columns, "model_score", top.alias("shap_top_features"))

    return score
