"""Classifiers on the model matrix: training, calibration, scoring.

All classifiers weigh classes instead of resampling them. A trained model is a
Spark ML pipeline or a table of tree nodes that starts from the matrix columns, so it can be
saved, loaded and applied to a batch or a stream alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalar import sigmoid
from riskloom.operators import boosting, forest, metrics, trees
from riskloom.operators.calibration import IsotonicMap
from riskloom.operators.forest import Forest
from riskloom.operators.trees import TreeEnsemble

LABEL = "fraud_label"
# Training settings.
SEED = 42
TREES = 200
BOOSTING_ROUNDS = 200
BOOSTING_DEPTH = 5
MAX_ITERATIONS = 1000
Classifier = PipelineModel | TreeEnsemble | Forest
CANDIDATES = ["baseline", "random_forest", "xgboost", "lightgbm"]


def _weighted(train: DataFrame, balanced: bool) -> DataFrame:
    """Add ``__weight``: n / (2 n_c) per class, or the negative/positive ratio on positives."""
    counts = train.agg(F.struct(
        F.count_if(F.col(LABEL) == 1).alias("p"), F.count_if(F.col(LABEL) == 0).alias("n")))
    p, n = F.col("__counts.p"), F.col("__counts.n")
    if balanced:
        weight = F.when(F.col(LABEL) == 1, (p + n) / (2 * F.greatest(p, F.lit(1)))).otherwise(
            (p + n) / (2 * F.greatest(n, F.lit(1))))
    else:
        weight = F.when(F.col(LABEL) == 1, n / F.greatest(p, F.lit(1))).otherwise(1.0)
    return train.withColumn("__counts", counts.scalar()).withColumn(
        "__weight", weight.cast("double")).drop("__counts")


def _fit(train: DataFrame, inputs: list[str], classifier) -> PipelineModel:
    assembler = VectorAssembler(inputCols=inputs, outputCol="__x")
    return Pipeline(stages=[assembler, classifier]).fit(train)


def _common() -> dict:
    return {"featuresCol": "__x", "labelCol": LABEL, "weightCol": "__weight"}


def train_baseline(train: DataFrame, inputs: list[str]) -> PipelineModel:
    """Logistic regression with a squared penalty of strength 1 on the summed loss.

    Spark minimises the mean loss, and balanced weights add up to the row count, so the
    penalty is divided by it. The tolerance is small because residuals add up over all rows.
    """
    rows = train.count()
    return _fit(_weighted(train, balanced=True), inputs, LogisticRegression(
        **_common(), regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False,
        maxIter=MAX_ITERATIONS, tol=1e-9))


def train_random_forest(train: DataFrame, inputs: list[str], trees: int = TREES,
                        max_depth: int = 30) -> Forest:
    return forest.train_forest(train, inputs, LABEL, forest.Settings(trees=trees, depth=max_depth, seed=SEED))


def train_boosted(train: DataFrame, inputs: list[str], rounds: int = BOOSTING_ROUNDS,
                  depth: int = BOOSTING_DEPTH, step: float = 0.3, bins: int = 64) -> TreeEnsemble:
    """Level by level, as Spark ML's boosted trees: each tree is fitted to the residuals 4 (y - p) by
    weighted variance, the first one in full and the others by ``step``; the log-odds are twice their sum."""
    settings = boosting.Settings(
        rounds=rounds, depth=depth, leaves=1 << depth, step=8 * step, bins=bins, least_rows=1, least_hessian=0.0,
        second_order=False, first_step=4.0)
    return boosting.train_leafwise(_weighted(train, balanced=False), inputs, LABEL, "__weight", settings)


def train_leafwise(train: DataFrame, inputs: list[str], rounds: int = BOOSTING_ROUNDS) -> TreeEnsemble:
    settings = boosting.Settings(rounds=rounds, depth=BOOSTING_DEPTH)
    return boosting.train_leafwise(_weighted(train, balanced=False), inputs, LABEL, "__weight", settings)


def train_candidate(name: str, train: DataFrame, inputs: list[str],
                    rounds: int = BOOSTING_ROUNDS, trees: int = TREES) -> Classifier:
    """The four candidates; of the two boosted ones one grows level by level, one leaf by leaf."""
    if name == "baseline":
        return train_baseline(train, inputs)
    if name == "random_forest":
        return train_random_forest(train, inputs, trees)
    if name == "xgboost":
        return train_boosted(train, inputs, rounds)
    if name == "lightgbm":
        return train_leafwise(train, inputs, rounds)
    raise ValueError(f"unknown candidate {name}")


def is_linear(model: Classifier) -> bool:
    return isinstance(model, PipelineModel) and hasattr(model.stages[-1], "coefficients")


def with_probability(model: Classifier, matrix: DataFrame,
                     output: str = "model_score") -> DataFrame:
    """Add the probability of class 1, before calibration."""
    if isinstance(model, TreeEnsemble):
        return matrix.select("*", sigmoid(trees.raw_score(model)).alias(output))
    if isinstance(model, Forest):
        return model.probability(matrix, output)
    scored = model.transform(matrix)
    return scored.select(*matrix.columns, vector_to_array("probability")[1].alias(output))


def _raw_score(model: PipelineModel) -> Column:
    """What calibration maps from: the margin of a linear model, else the probability."""
    return vector_to_array("rawPrediction" if is_linear(model) else "probability")[1]


def with_raw_score(model: Classifier, matrix: DataFrame) -> DataFrame:
    """Add ``__raw``, what calibration maps from."""
    if isinstance(model, TreeEnsemble):
        return matrix.select("*", trees.raw_score(model).alias("__raw"))
    if isinstance(model, Forest):
        return model.probability(matrix, "__raw")
    return model.transform(matrix).select(*matrix.columns, _raw_score(model).alias("__raw"))


def save_classifier(model: Classifier, path: str) -> None:
    if isinstance(model, TreeEnsemble):
        model.save(SparkSession.getActiveSession(), path)
    elif isinstance(model, Forest):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load_classifier(path: str) -> Classifier:
    spark = SparkSession.getActiveSession()
    if Forest.stored_at(spark, path):
        return Forest.load(spark, path)
    return TreeEnsemble.load(spark, path) if TreeEnsemble.stored_at(spark, path) else PipelineModel.load(path)


@dataclass
class CalibratedModel:
    """A frozen classifier and the monotone map from its raw score to a probability."""

    classifier: Classifier
    calibrator: IsotonicMap

    def score(self, matrix: DataFrame, output: str = "model_score") -> DataFrame:
        raw = with_raw_score(self.classifier, matrix)
        return self.calibrator.apply(raw, "__raw", "__calibrated").select(
            *matrix.columns, F.col("__calibrated").alias(output))

    def save(self, path: str) -> None:
        save_classifier(self.classifier, f"{path}/classifier")
        self.calibrator.save(SparkSession.getActiveSession(), f"{path}/calibrator")

    @staticmethod
    def load(path: str) -> "CalibratedModel":
        return CalibratedModel(load_classifier(f"{path}/classifier"),
                               IsotonicMap.load(SparkSession.getActiveSession(), f"{path}/calibrator"))


def calibrate(classifier: Classifier, validation: DataFrame) -> CalibratedModel:
    """Isotonic calibration on validation rows only."""
    raw = with_raw_score(classifier, validation).select("__raw", LABEL)
    return CalibratedModel(classifier, IsotonicMap.fit(raw, "__raw", LABEL))


def linear_coefficients(model: PipelineModel, inputs: list[str]) -> dict[str, float]:
    return dict(zip(inputs, model.stages[-1].coefficients.toArray().tolist()))


def tree_ensemble(model: Classifier, inputs: list[str]) -> TreeEnsemble:
    return model if isinstance(model, TreeEnsemble) else trees.from_spark(model, inputs)


def linear_score(coefficients: dict[str, float], intercept: float) -> Column:
    """The probability of a linear model as a plain column, for stateless scoring."""
    terms = [F.col(c) * w for c, w in coefficients.items()]
    return sigmoid(sum(terms, F.lit(intercept)))


def test_report(scored: DataFrame, **options) -> DataFrame:
    """Ranking metrics and threshold metrics of a scored set, as name/value rows."""
    ranking = metrics.evaluate(scored, **options)
    lines = ranking.select(F.inline(F.array(
        F.struct(F.lit("pr_auc").alias("metric"), F.col("pr_auc").alias("value")),
        F.struct(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value")))))
    for column in ("precision", "recall", "f1"):
        lines = lines.unionByName(metrics.threshold_metrics(scored).select(
            F.concat_ws("@", F.lit(column), F.col("threshold").cast("string")).alias("metric"),
            F.col(column).alias("value")))
    return lines
