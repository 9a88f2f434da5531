"""Tree ensembles: scores and attributions against enumeration and Spark's own predictions."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import attribution, model, trees
from riskloom.plans import training


def random_tree(rng, depth, features, number=0):
    rows, count = [], [0]

    def grow(level, cover):
        node = count[0]
        count[0] += 1
        if level == depth or rng.random() < 0.15 and level:
            rows.append((number, node, -1, 0.0, -1, -1, float(rng.normal()), cover))
            return node
        share = rng.uniform(0.1, 0.9)
        below, above = grow(level + 1, cover * share), grow(level + 1, cover * (1 - share))
        rows.append((number, node, int(rng.integers(features)), float(rng.normal()), below, above, 0.0, cover))
        return node

    grow(0, 100.0)
    return rows


def ensemble(rng, n=3, depth=4, features=4):
    rows = [r for t in range(n) for r in random_tree(rng, depth, features, t)]
    return trees.TreeEnsemble(pd.DataFrame(rows, columns=trees.NODES), [f"f{i}" for i in range(features)], base=0.25)


def known_value(e, x, known):
    """The prediction when only some features are known."""
    total = e.base
    for tree in e._trees():
        rows = {n: r for n, r in zip(tree.index, tree.itertuples(index=False))}

        def value(node):
            r = rows[node]
            if r.feature < 0:
                return r.value
            if r.feature in known:
                return value(r.below if x[r.feature] <= r.cut else r.above)
            return sum(rows[c].cover / r.cover * value(c) for c in (r.below, r.above))

        total += value(tree.index[0])
    return total


def by_subsets(e, x):
    d, out = len(e.inputs), []
    for f in range(d):
        rest = [j for j in range(d) if j != f]
        out.append(sum(
            math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d)
            * (known_value(e, x, {*s, f}) - known_value(e, x, set(s)))
            for k in range(d) for s in combinations(rest, k)))
    return out


@pytest.mark.parametrize("depth,features,tabled", [(2, 3, 6), (5, 4, 6), (7, 6, 2), (6, 1, 6)])
def test_contributions_equal_the_sum_over_subsets(monkeypatch, depth, features, tabled):
    monkeypatch.setattr(trees, "_TABLED", tabled)
    rng = np.random.default_rng(depth)
    e = ensemble(rng, depth=depth, features=features)
    x = rng.normal(size=(12, features))
    x[0, 0] = np.nan
    got = e.contributions(x)
    for row, values in zip(x, got):
        assert values == pytest.approx(by_subsets(e, row), abs=1e-10)
    assert got.sum(axis=1) + e.expected() == pytest.approx(e.raw(x))
    assert e.raw(x) == pytest.approx([known_value(e, row, set(range(features))) for row in x])


def test_a_tree_without_splits(spark):
    e = trees.TreeEnsemble(pd.DataFrame([(0, 0, -1, 0.0, -1, -1, 2.0, 5.0)], columns=trees.NODES), ["a"])
    assert e.raw(np.zeros((2, 1))).tolist() == [2.0, 2.0] and e.expected() == 2.0
    assert e.contributions(np.zeros((2, 1))).tolist() == [[0.0], [0.0]]


def matrix(spark, n=400):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] * x[:, 2] - 1)))).astype(int)
    part = ["train"] * (n // 2) + ["val"] * (n // 4) + ["test"] * (n // 4)
    rows = [(f"TXN{i}", int(y[i]), part[i], *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "transaction_id string, fraud_label int, split string, a double, b double, c double")


@pytest.mark.parametrize("kind", ["random_forest", "xgboost"])
def test_spark_models_are_explained_in_full(spark, kind):
    rows, inputs = matrix(spark), ["a", "b", "c"]
    fitted = model.train_candidate(kind, rows.where("split = 'train'"), inputs, rounds=15, trees=20)
    e = trees.from_spark(fitted, inputs)
    column = "probability" if kind == "random_forest" else "rawPrediction"
    scored = fitted.transform(rows).select(
        "transaction_id", *inputs, vector_to_array(column)[1].alias("raw")).withColumn("own", trees.raw_score(e))
    got = trees.with_tree_contributions(scored, e).collect()
    assert len(got) == 400
    for r in got:
        assert [c.feature for c in r.contributions] == inputs
        assert r.own == pytest.approx(r.raw) and e.expected() + sum(c.value for c in r.contributions) == pytest.approx(r.raw)
    ranked = attribution.global_importance(attribution.explained(fitted, rows, inputs, rows)).collect()
    assert [r.feature for r in ranked][0] == "a" and len(ranked) == 3


def test_a_deployed_tree_model_explains_its_decisions(spark):
    rows, inputs = matrix(spark), ["a", "b", "c"]
    run = training.run(rows, candidates=["xgboost"], rounds=5)
    assert run.importances.count() == 3
    scored = attribution.explained(run.deployed.classifier, run.part("test"), inputs, run.background)
    top = scored.select(attribution.as_map(attribution.top_features(k=2)).alias("top"))
    assert top.where(F.size("top") == 2).count() == 100


def test_leaves_of_a_tree_share_their_comparisons(monkeypatch):
    """A split is compared with the rows once, not once for each leaf below it."""
    rng = np.random.default_rng(8)
    nodes = [(0, i, int(rng.integers(0, 4)), float(rng.normal()), 2 * i + 1, 2 * i + 2, 0.0, 2.0 ** (6 - (i + 1).bit_length())) for i in range(15)]
    nodes += [(0, i, -1, 0.0, -1, -1, float(rng.normal()), 2.0) for i in range(15, 31)]
    e, seen = trees.TreeEnsemble(pd.DataFrame(nodes, columns=trees.NODES), list("abcd")), []

    class Counted(np.ndarray):
        def __le__(self, other):
            seen.append(float(other))
            return np.asarray(self) <= other

    monkeypatch.setattr(trees.np, "ascontiguousarray", lambda a: np.array(a, order="C").view(Counted))
    x = rng.normal(size=(50, 4))
    x[::9, 2] = np.nan
    got = np.asarray(e.contributions(x.view(Counted)))
    assert got.sum(axis=1) + e.expected() == pytest.approx(e.raw(x)) and 0 < len(seen) <= 15


def test_leaves_below_a_node_share_a_table():
    """A row looks up far fewer values than its trees have leaves, a lone node and rows of no splits included."""
    rng = np.random.default_rng(4)
    e = ensemble(rng, n=4, depth=5, features=8)
    lone = (9, 0, -1, 0.0, -1, -1, 1.5, 3.0)
    e = trees.TreeEnsemble(pd.DataFrame([*e.nodes.itertuples(index=False, name=None), lone], columns=trees.NODES), e.inputs, 0.25)
    x = rng.normal(size=(40, 8))
    x[::5, 3] = np.nan
    got, groups = e.contributions(x), e.groups()
    assert got.sum(axis=1) + e.expected() == pytest.approx(e.raw(x)) and got[1] == pytest.approx(by_subsets(e, x[1]), abs=1e-10)
    assert all(g.table.shape == (len(g.features), 1 << len(g.comparisons)) and len(g.comparisons) <= 9 for g in groups)
    assert sum(len(g.leaves) for g in groups) == int((e.nodes.feature < 0).sum()) > 3 * len(groups)
