from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import anomaly, attribution, metrics, model, ordered, registry, risk, splits
from riskloom.plans import queries, training
from util import at


def scored(spark, labels, scores):
    return spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores)],
                                 "fraud_label int, model_score double")


def test_metrics_worked_out_by_hand(spark):
    # Ranked: 1 0 1 1 0 0 0. Precision at the three hits: 1, 2/3, 3/4.
    some = scored(spark, [0, 1, 0, 1, 0, 0, 1], [.21, .47, .03, .88, .62, .33, .55])
    got = metrics.evaluate(some).first()
    assert got.pr_auc == pytest.approx((1 + 2 / 3 + 3 / 4) / 3)
    assert got.roc_auc == pytest.approx(10 / 12)  # two pairs of twelve are in the wrong order
    cut = metrics.threshold_metrics(some, thresholds=[0.5]).first()
    assert (cut.precision, cut.recall) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    # All scores equal: every ranking is as good as any other.
    flat = metrics.evaluate(scored(spark, [1, 0, 0, 0], [.4] * 4)).first()
    assert (flat.pr_auc, flat.roc_auc) == (0.25, 0.5)
    # Without a positive there is nothing to find and nothing to rank.
    none = scored(spark, [0, 0, 0], [.15, .6, .45])
    assert all((r.precision, r.recall, r.f1) == (0, 0, 0)
               for r in metrics.threshold_metrics(none).collect())
    assert metrics.roc_auc(none).first().roc_auc is None


@pytest.mark.parametrize("one_task_rows", [10**6, 0], ids=["one task", "blocks"])
def test_ranking_metrics_match_definitions_with_ties(spark, one_task_rows):
    rng = np.random.default_rng(3)
    y, s = (rng.random(300) < 0.3).astype(int), rng.integers(0, 40, 300) / 40
    order = np.unique(s)[::-1]
    recall, ap = 0.0, 0.0
    for t in order:
        hit = s >= t
        now = y[hit].sum() / y.sum()
        ap += (now - recall) * y[hit].mean()
        recall = now
    p, n = s[y == 1][:, None], s[y == 0][None, :]
    auc = ((p > n) + 0.5 * (p == n)).mean()
    got = metrics.evaluate(scored(spark, y, s), one_task_rows=one_task_rows).first()
    assert got.pr_auc == pytest.approx(ap) and got.roc_auc == pytest.approx(auc)


def test_calibration_curve_matches_numpy_bins(spark):
    rng = np.random.default_rng(4)
    s = np.round(rng.random(400) ** 2, 3)
    y = (rng.random(400) < s).astype(int)
    edges = np.percentile(s, np.linspace(0, 100, 11))[1:-1]
    which = np.searchsorted(edges, s)
    got = {r.bin: r for r in metrics.calibration_curve(scored(spark, y, s)).collect()}
    assert set(got) == set(which)
    for b, r in got.items():
        assert r.mean_predicted == pytest.approx(s[which == b].mean())
        assert r.fraction_positive == pytest.approx(y[which == b].mean())


def test_time_split_is_ordered_and_complete(spark):
    rows = spark.createDataFrame([(i, at(days=i)) for i in range(100)],
                                 "i int, timestamp timestamp_ntz")
    split = splits.with_split(rows)
    got = {r.split: (r.n, r.lo, r.hi) for r in split.groupBy("split").agg(
        F.count("*").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi")).collect()}
    assert 60 <= got["train"][0] <= 80 and sum(v[0] for v in got.values()) == 100
    assert got["train"][2] < got["val"][1] and got["val"][2] < got["test"][1]


def test_one_hot_columns_are_fixed(spark):
    rows = spark.createDataFrame([("TXN1", "card", 1.0), ("TXN2", "cheque", 2.0)],
                                 "transaction_id string, payment_method string, amount double")
    matrix = splits.model_matrix(rows)
    assert matrix.columns == ["amount", "payment_method_bank_transfer", "payment_method_card",
                              "payment_method_wallet"]
    assert sorted(tuple(r) for r in matrix.collect()) == [(1.0, 0, 1, 0), (2.0, 0, 0, 0)]


def test_class_weights(spark):
    w = splits.class_weights(scored(spark, [0, 0, 0, 1], [0] * 4)).first()
    assert (w.scale_pos_weight, w.weight_positive) == (3.0, 2.0)
    assert w.weight_negative == pytest.approx(2 / 3)


def _matrix(spark, n=600, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] - 1)))).astype(int)
    split = np.where(np.arange(n) < n * 0.6, "train", np.where(np.arange(n) < n * 0.8, "val", "test"))
    rows = [(f"TXN{i}", int(y[i]), str(split[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(
        rows, "transaction_id string, fraud_label int, split string, a double, b double, c double"
    ), x, y


def test_baseline_minimises_the_balanced_penalised_loss(spark):
    matrix, x, y = _matrix(spark)
    fitted = model.train_baseline(matrix, ["a", "b", "c"])
    n = len(y)
    weight = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    design, w = np.c_[x, np.ones(n)], np.zeros(4)
    penalty = np.diag([1.0, 1.0, 1.0, 0.0])
    for _ in range(50):  # Newton steps on 0.5 |w|^2 + sum of weighted losses
        p = 1 / (1 + np.exp(-design @ w))
        grad = design.T @ (weight * (p - y)) + penalty @ w
        w = w - np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + penalty, grad)
    assert fitted.stages[-1].coefficients.toArray() == pytest.approx(w[:3], abs=2e-3)
    assert fitted.stages[-1].intercept == pytest.approx(w[3], abs=2e-3)


def _pool(s, y):
    """Isotonic fit by pooling adjacent violators, as value per distinct score."""
    points = [[v, y[s == v].mean(), (s == v).sum()] for v in np.unique(s)]
    blocks = []
    for v, m, k in points:
        blocks.append([[v], m, k])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([a[0] + b[0], (a[1] * a[2] + b[1] * b[2]) / (a[2] + b[2]), a[2] + b[2]])
    return {v: m for vs, m, _ in blocks for v in vs}


def test_calibration_is_isotonic_and_survives_saving(spark, tmp_path):
    matrix, _, _ = _matrix(spark)
    inputs = ["a", "b", "c"]
    fitted = model.train_baseline(matrix.where("split = 'train'"), inputs)
    calibrated = model.calibrate(fitted, matrix.where("split = 'val'"))
    val = fitted.transform(matrix.where("split = 'val'")).select(
        "transaction_id", "fraud_label", model._raw_score(fitted).alias("raw")).toPandas()
    want = _pool(val["raw"].to_numpy(), val["fraud_label"].to_numpy())
    got = calibrated.score(matrix).toPandas().set_index("transaction_id")["model_score"]
    assert got.between(0, 1).all()
    for _, r in val.iterrows():
        assert got[r["transaction_id"]] == pytest.approx(want[r["raw"]])
    calibrated.save(str(tmp_path / "m"))
    again = model.CalibratedModel.load(str(tmp_path / "m")).score(matrix)
    assert again.exceptAll(calibrated.score(matrix)).count() == 0


def test_training_run_reports_everything(spark, tmp_path):
    matrix, _, _ = _matrix(spark)
    run = training.run(matrix, rounds=3, trees=10)
    judged = {r.name: r.val_pr_auc for r in run.validation_metrics.collect()}
    assert set(judged) == set(model.CANDIDATES)
    assert judged[run.deployed_name] == max(judged.values())
    assert run.champion_name in ("xgboost", "lightgbm")
    names = {r.metric: r.value for r in run.test_metrics.collect()}
    assert {"pr_auc", "roc_auc", "precision@0.5", "recall@0.3", "f1@0.7"} <= set(names)
    assert 0.5 < names["roc_auc"] <= 1
    assert run.importances.first().feature == "a"
    assert {r.split: r.rows for r in run.row_counts.collect()} == {
        "train": 360, "val": 120, "test": 120}
    assert run.anomaly_scores.count() == 120 and run.background.count() == run.part("train").count()
    run.deployed.save(str(tmp_path / "m"))
    figures = training.re_evaluate(str(tmp_path / "m"), matrix)
    assert 0 < figures["validation"].first().pr_auc <= 1
    assert figures["importances"].count() == 3 and figures["background"].columns == ["a", "b", "c"]
    amounts = matrix.select("transaction_id", F.lit(50.0).alias("amount"))
    document = training.choose_policy(str(tmp_path / "m"), matrix, amounts, "run-1").first()
    assert document.t_review < document.t_block and document.model_run_id == "run-1"


def test_outlier_has_the_highest_anomaly_score(spark):
    rng = np.random.default_rng(6)
    rows = [(f"r{i}", *map(float, v)) for i, v in enumerate(rng.normal(size=(200, 3)))]
    df = spark.createDataFrame(rows + [("odd", 50.0, 50.0, 50.0)],
                               "transaction_id string, a double, b double, c double")
    forest = anomaly.train(df, ["a", "b", "c"])
    assert forest.select("tree").distinct().count() == 100
    top = anomaly.score(df, forest, ["a", "b", "c"]).orderBy(F.desc("anomaly_score")).first()
    assert top.transaction_id == "odd" and 0 < top.anomaly_score <= 1


def test_contributions_add_up_and_rank(spark):
    matrix, x, _ = _matrix(spark, n=50)
    weights = {"a": 2.0, "b": -1.0, "c": 0.0}
    out = attribution.with_contributions(matrix, weights, matrix.limit(50))
    shifted = (x - x.mean(axis=0)) * [2.0, -1.0, 0.0]
    for r in out.collect():
        i = int(r.transaction_id[3:])
        assert [c.value for c in r.contributions] == pytest.approx(shifted[i])
    top = out.select("transaction_id", attribution.top_features(k=2).alias("t")).collect()
    for r in top:
        want = np.argsort(-np.abs(shifted[int(r.transaction_id[3:])]), kind="stable")[:2]
        assert [t.feature for t in r.t] == ["abc"[j] for j in want]
    overall = attribution.global_importance(out).collect()
    assert [r.feature for r in overall] == ["a", "b", "c"]


def test_contributions_are_ranked_without_a_lambda_per_comparison(spark):
    """Equal, missing and negative values keep their order, and the sort compares in compiled code."""
    values = [[0.5, -2.0, 2.0, 0.0, None, -0.5], [0.0, -0.0, 0.0], [], None]
    rows = spark.createDataFrame(
        [(i, None if v is None else [(f"f{j}", x) for j, x in enumerate(v)]) for i, v in enumerate(values)],
        "n int, contributions array<struct<feature string, value double>>")
    top = rows.select("n", attribution.top_features(k=4).alias("t")).orderBy("n")
    found = [None if r.t is None else [x.feature for x in r.t] for r in top.collect()]
    assert found == [["f4", "f1", "f2", "f0"], ["f0", "f1", "f2"], [], None]
    assert "array_sort" not in top._jdf.queryExecution().optimizedPlan().toString()


def test_champion_ties_go_to_the_first_and_newest_run_counts(spark):
    runs = spark.createDataFrame(
        [("xgboost", "r1", 1, 0.9), ("xgboost", "r2", 2, 0.5), ("lightgbm", "r3", 1, 0.5),
         ("baseline", "r4", 1, 0.4)], "name string, run_id string, start_time int, val_pr_auc double")
    order = ["baseline", "xgboost", "lightgbm"]
    got = {r.name: (r.run_id, r.is_deployed) for r in registry.candidate_comparison(runs, order).collect()}
    assert got == {"xgboost": ("r2", True), "lightgbm": ("r3", False), "baseline": ("r4", False)}
    gate = registry.promotion_gate(runs, runs.where("run_id = 'r3'"))
    assert {r.run_id: r.may_promote for r in gate.collect()} == {
        "r1": True, "r2": True, "r3": True, "r4": False}
    forced = registry.promotion_gate(runs, runs.where("run_id = 'r3'"), force=True)
    assert all(r.may_promote for r in forced.collect())
    assert all(r.may_promote for r in registry.promotion_gate(runs, runs.limit(0)).collect())


def test_zscores_and_prior_shift(spark):
    rng = np.random.default_rng(7)
    z = rng.normal(size=500)
    df = spark.createDataFrame([(float(v), 3.0) for v in z], "z double, flat double")
    scaled = risk.with_zscores(df, ["z", "flat"]).toPandas()
    assert scaled["z_z"].std(ddof=0) == pytest.approx(1) and (scaled["z_flat"] == 0).all()
    lo, hi = -15.0, 5.0
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if np.mean(1 / (1 + np.exp(-(mid + z)))) < 0.015 else (lo, mid)
    got = risk.prior_shift(df, 0.015).first()
    assert got.intercept == pytest.approx((lo + hi) / 2, abs=1e-9)
    assert got.mean_probability == pytest.approx(0.015)


def test_fingerprint_ignores_order_but_not_content(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("y", 2), ("x", 1)], "k string, v int")
    c = spark.createDataFrame([("y", 2), ("x", 2)], "k string, v int")
    assert risk.fingerprint(a).first() == risk.fingerprint(b).first()
    assert risk.fingerprint(a).first() != risk.fingerprint(c).first()


def test_cut_off_leaves_the_share_above(spark):
    scores = np.random.default_rng(9).random(501)
    rows = spark.createDataFrame([(float(v),) for v in [*scores, 0.5]], "anomaly_score double").union(
        spark.createDataFrame([(None,)], "anomaly_score double"))
    cut = anomaly.cut_off(rows, 0.1)
    assert cut == pytest.approx(np.quantile([*scores, 0.5], 0.9))
    got = [r.is_anomaly for r in anomaly.flagged(rows, cut).collect()]
    assert sum(got) == (np.array([*scores, 0.5]) > cut).sum() and got[-1] == 0
    assert anomaly.cut_off(rows.limit(0)) is None
    assert [r.is_anomaly for r in anomaly.flagged(rows.limit(2), None).collect()] == [0, 0]


def test_enriched_model_keeps_what_comparisons_need(spark, tmp_path):
    matrix, _, _ = _matrix(spark)
    run = training.run(matrix, candidates=["baseline"])
    path = str(tmp_path / "m")
    run.deployed.save(path)
    document = training.enrich(path, matrix, sample=20).first()
    assert [i.feature for i in document.importances][0] == "a" and len(document.importances) == 3
    assert sum(b.rows for b in document.calibration_curve) == 120 and 0 < document.val_pr_auc <= 1
    assert spark.read.parquet(f"{path}/background").count() == 20


def test_residuals_of_the_baseline_are_summed_over_all_rows(small):
    """As many weighted positives, and as much weighted score, as half the rows of train."""
    rows = small.training_run.part("train").count()
    got = queries.QUERIES["baseline_residual"](small.spark, "/root/testdata/sf0.001").first()
    assert got.weighted_positives == got.weighted_scores == rows / 2


def test_isolation_trees_are_walked_by_many_rows_at_once():
    import numpy as np
    import pandas as pd

    # Trees of different depth, one of a single leaf; node 0 of the second parts off its own leaf at once.
    nodes = pd.DataFrame([
        (0, 0, -1, 0.0, -1, -1, 2.5), (1, 0, 1, 0.5, 1, 2, 0.0), (1, 1, -1, 0.0, -1, -1, 1.0),
        (1, 2, 0, -1.0, 3, 4, 0.0), (1, 3, -1, 0.0, -1, -1, 2.25), (1, 4, -1, 0.0, -1, -1, 3.75),
    ], columns=["tree", "node", "feature", "cut", "below", "above", "depth"])
    data = np.array([[0.0, 0.5], [-1.0, 0.6], [2.0, 9.0], [np.nan, 1.0], [0.0, np.nan]])
    trees = [anomaly._steps(g.sample(frac=1, random_state=1)) for _, g in nodes.groupby("tree")]
    assert [t[-1] for t in trees] == [0, 2]
    assert anomaly._path_lengths(data, trees).tolist() == [3.5, 4.75, 6.25, 6.25, 6.25]
    assert anomaly._path_lengths(data[:0], trees).tolist() == []


def test_a_part_of_the_matrix_is_read_by_itself(spark):
    """Reports read one split at a time, so the others' files stay closed."""
    matrix, _, _ = _matrix(spark)
    run = training.run(matrix, candidates=["baseline"])
    assert run.matrix.columns == matrix.columns and run.matrix.exceptAll(matrix).isEmpty()
    for name in ("train", "val", "test"):
        plan = run.part(name)._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"PartitionFilters: \[[^\]]*= {name}\)", plan)


def test_rows_are_scored_once_for_their_metrics(spark):
    """Scores are counted once: measuring how many there are must not score the rows again."""
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def scorer(x: pd.Series) -> pd.Series:
        calls.add(len(x))
        return (x % 7) / 7

    rows = spark.range(100).select(
        scorer.asNondeterministic()(F.col("id").cast("double")).alias("model_score"), (F.col("id") % 3 == 0).cast("int").alias("fraud_label"))
    for report in (metrics.evaluate, metrics.average_precision, metrics.roc_auc,
                   lambda r: ordered.exact_quantiles(r, [], "model_score", [0.5])):
        before = calls.value
        assert len(report(rows).collect()) == 1
        assert calls.value == before + 100
