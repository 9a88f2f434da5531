"""Leaf-wise boosting against a plain build, one leaf after the other."""

from __future__ import annotations

import numpy as np
import pytest

from riskloom.operators import boosting, metrics, model, trees
from riskloom.operators.boosting import Settings

INPUTS = ["a", "b", "c"]


def rows(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 2)
    x[:, 2] = rng.integers(0, 3, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 * x[:, 0] + x[:, 1] * (x[:, 2] - 1) - 1)))).astype(int)
    return x, y, np.where(y == 1, 3.0, 1.0)


def frame(spark, x, y, w):
    data = [(f"T{i}", int(y[i]), float(w[i]), *map(float, x[i])) for i in range(len(x))]
    return spark.createDataFrame(data, "transaction_id string, fraud_label int, w double, a double, b double, c double")


def plain(x, y, w, edges, s):
    """Trees as nested tuples, grown one leaf at a time from the rows themselves."""
    codes = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], axis=1)
    margin = np.full(len(x), np.log((w * y).sum() / (w * (1 - y)).sum()))
    out = []
    for _ in range(s.rounds):
        g, h = (v / boosting._UNIT for v in boosting.gradients(margin, y.astype(float), w))

        def split(own):
            best = (0.0, 0, 0)
            score = lambda r: g[r].sum() ** 2 / h[r].sum()
            for f in range(codes.shape[1]):
                for cut in range(len(edges[f])):
                    below = own & (codes[:, f] <= cut)
                    above = own & ~below
                    if min(below.sum(), above.sum()) < s.least_rows or min(h[below].sum(), h[above].sum()) < s.least_hessian:
                        continue
                    gain = score(below) + score(above) - score(own)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, cut)
            return best

        leaves = [(np.ones(len(x), bool), 0, split(np.ones(len(x), bool)))]
        while len(leaves) < s.leaves:
            i = max(range(len(leaves)), key=lambda k: leaves[k][2][0] if leaves[k][1] < s.depth else 0.0)
            own, depth, (gain, f, cut) = leaves[i]
            if gain <= 0 or depth >= s.depth:
                break
            below = own & (codes[:, f] <= cut)
            leaves[i:i + 1] = [(part, depth + 1, split(part)) for part in (below, own & ~below)]
        step = np.zeros(len(x))
        for own, *_ in leaves:
            step[own] = -s.step * g[own].sum() / h[own].sum()
        margin = margin + step
        out.append(sorted((int(own.sum()), round(float(step[own][0]), 9)) for own, *_ in leaves))
    return out, margin


@pytest.mark.parametrize("settings", [
    Settings(rounds=4, margin_every=3), Settings(rounds=3, leaves=5, depth=4), Settings(rounds=2, depth=1),
    Settings(rounds=3, bins=8, least_rows=60)])
def test_same_trees_as_a_plain_build(spark, settings):
    x, y, w = rows()
    train = frame(spark, x, y, w).repartition(5)
    got = boosting.train_leafwise(train, INPUTS, "fraud_label", "w", settings)
    edges = boosting.bin_edges(train, INPUTS, settings.bins)
    want, margin = plain(x, y, w, edges, settings)
    assert got.raw(x) == pytest.approx(margin)
    for number, tree in got.nodes.groupby("tree"):
        leaves = tree[tree.feature < 0]
        assert sorted((int(r.cover), round(r.value, 9)) for r in leaves.itertuples()) == want[number]
    assert got.contributions(x[:20]).sum(axis=1) + got.expected() == pytest.approx(margin[:20])


def test_layout_does_not_change_the_trees(spark):
    x, y, w = rows(400, 2)
    settings = Settings(rounds=3)
    one, many = (boosting.train_leafwise(frame(spark, x, y, w).repartition(n), INPUTS, "fraud_label", "w", settings) for n in (1, 7))
    assert one.nodes.equals(many.nodes) and one.base == many.base


def test_missing_values_unlabelled_rows_and_nothing_to_learn(spark):
    x, y, w = rows(300, 3)
    x[::7, 0] = np.nan
    train = frame(spark, x, y, w)
    fitted = boosting.train_leafwise(train.unionByName(train.limit(0)), INPUTS, "fraud_label", "w", Settings(rounds=2))
    assert np.isfinite(fitted.raw(x)).all()
    for only in (0, 1):
        constant = boosting.train_leafwise(train.where(f"fraud_label = {only}"), INPUTS, "fraud_label", "w")
        assert constant.raw(x[:2]).tolist() == [constant.base] * 2 and (constant.base > 0) == bool(only)
    empty = boosting.train_leafwise(train.limit(0), INPUTS, "fraud_label", "w")
    assert empty.raw(x[:1]).tolist() == [0.0] and empty.expected() == 0.0


def test_candidate_ranks_calibrates_and_is_stored(spark, tmp_path):
    x, y, w = rows(800, 4)
    train, val = frame(spark, x[:500], y[:500], w[:500]), frame(spark, x[500:], y[500:], w[500:])
    fitted = model.train_candidate("lightgbm", train, INPUTS, rounds=8)
    scored = model.with_probability(fitted, val)
    assert metrics.evaluate(scored.select("model_score", "fraud_label")).first().roc_auc > 0.75
    stored = model.calibrate(fitted, val)
    stored.save(str(tmp_path / "m"))
    again = model.CalibratedModel.load(str(tmp_path / "m"))
    assert isinstance(again.classifier, trees.TreeEnsemble)
    assert again.score(val).exceptAll(stored.score(val)).count() == 0


def test_a_level_is_one_job(spark):
    """Work beside the sums, which small data has most of, stays the same few jobs for any number of trees."""
    x, y, w = rows(300, 5)
    train, sc, jobs = frame(spark, x, y, w), spark.sparkContext, {}
    for rounds in (1, 5):
        sc.setJobGroup(f"boost-{rounds}", "")
        boosting.train_leafwise(train, INPUTS, "fraud_label", "w", Settings(rounds=rounds, depth=3))
        jobs[rounds] = len(sc.statusTracker().getJobIdsForGroup(f"boost-{rounds}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[5] - jobs[1] <= 4 * 3


def test_level_wise_candidate_is_boosting_on_residuals(spark):
    """Against a plain build of Spark ML's rule, first tree in full, and Spark ML itself."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    x, y, w = rows(900, 6)
    x = x.round(0)  # few values, so that both cut at all of them
    train = frame(spark, x, y, w)
    got = model.train_boosted(train, INPUTS, rounds=2, depth=3)
    assert isinstance(got, trees.TreeEnsemble)
    spark_ml = Pipeline(stages=[VectorAssembler(inputCols=INPUTS, outputCol="__x"), GBTClassifier(
        featuresCol="__x", labelCol="fraud_label", weightCol="__weight", maxIter=2, maxDepth=3, stepSize=0.3, maxBins=64)]).fit(
        model._weighted(train, balanced=False))
    both = model.with_probability(got, spark_ml.transform(train).select("*", vector_to_array("probability")[1].alias("ml"))
                                  .drop("probability", "rawPrediction")).select("ml", "model_score").toPandas()
    assert np.abs(both.ml - both.model_score).max() < 1e-5


def test_columns_of_few_bins_share_a_code():
    """A pass counts over codes, fewer than columns, and finds the sums of every column and the rows of every node in them."""
    rng = np.random.default_rng(9)
    edges = [np.arange(k - 1.0) for k in (2, 254, 3, 2, 25, 2, 9, 4, 2, 255)]
    bins = np.stack([rng.integers(0, len(e) + 1, 5000) for e in edges], axis=1).astype(np.uint8)
    codes = boosting.Codes.of(edges)
    assert len(codes.sizes) == 4 and max(codes.sizes) <= 256
    label, weight, margin = rng.integers(0, 2, 5000), rng.choice([1.0, 2.5, 7.0], 5000), rng.normal(size=5000)
    block, = boosting._blocks([(codes.joined(bins).tobytes(), label.astype(float).tobytes(), weight.tobytes())], 4, 0.0)
    block.margin = margin
    tree = boosting.BinTree([4, 7, -1, -1, -1], [11, 1, 0, 0, 0], [1, 3, -1, -1, -1], [2, 4, -1, -1, -1], [0.0, 0.0, 1.0, 2.0, 3.0], [0] * 5)
    of = {2: bins[:, 4] > 11, 3: (bins[:, 4] <= 11) & (bins[:, 7] <= 1), 4: (bins[:, 4] <= 11) & (bins[:, 7] > 1)}
    (cell, *sums), = boosting._sums(iter([block]), tree, [3, 2], codes, True)
    total = np.zeros((3, 2 * 4 * 256), dtype=np.int64)
    total[:, cell] = sums
    got = codes.by_column(total.reshape(3, 2, 4, 256))
    g, h = boosting.gradients(margin, label, weight)
    for node, part in zip((3, 2), np.moveaxis(got, 1, 0)):
        for column in range(10):
            for values, v in zip(part[:, column], (None, g, h)):
                own = np.bincount(bins[of[node], column], None if v is None else v[of[node]], 256)
                assert values.tolist() == own.tolist()
    moved = boosting._moved(block, tree, codes).margin - margin
    assert all(moved[rows] == pytest.approx(float(node - 1)) for node, rows in of.items())
    assert block.kind.dtype == np.uint8
