"""Tree ensembles as node tables: scoring, and exact attribution along their paths.

The attribution of a feature is its average effect over all orders in which features become
known, where a split on an unknown feature follows both branches in proportion to the training
weight that went down each. For one leaf only the features on its path matter. With ``z`` the
share of weight that a feature's splits on the path let through, and ``o`` whether the row itself passes
them, the leaf adds

    value * (o_f - z_f) * integral over u in [0, 1] of  prod_{j != f} (z_j (1 - u) + o_j u)

to feature f: the integral is the sum over all subsets of the other features with their
weights. Its integrand is a polynomial, so a few Gauss-Legendre points give it exactly, in time that
grows with the path and not with the subsets. Contributions and the base value add up to the
raw prediction of every row.

What the leaves below a node give follows from the outcomes of the comparisons on the way to it and below it. Where
these are few, a table has the sum for every set of outcomes, so a row looks it up instead of meeting each leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import new_shared_path

#: Columns of a node table. Rows with x <= cut go below; a leaf has feature -1. ``cover`` is the
#: training weight that reached the node.
NODES = ["tree", "node", "feature", "cut", "below", "above", "value", "cover"]
#: Comparisons up to which the leaves below a node share a table.
_TABLED = 9
_ROWS = 8192
_KEPT = 256


@dataclass
class _Leaf:
    """One leaf as conditions on the distinct features of its path."""

    features: np.ndarray
    above: np.ndarray
    upto: np.ndarray
    shares: np.ndarray
    value: float

    def comparisons(self) -> set[tuple[int, float]]:
        sides = [(self.above, self.above > -np.inf), (self.upto, self.upto < np.inf)]
        return {pair for cuts, split in sides for pair in zip(self.features[split].tolist(), cuts[split].tolist())}

    def passed(self, rows: int, upto) -> np.ndarray:
        """Whether rows pass the splits of each feature, (features, rows), from ``upto(feature, cut)``: which lie below or at it."""
        out = np.ones((len(self.features), rows), dtype=bool)
        for j, f in enumerate(self.features.tolist()):
            # A missing value takes the branch above.
            if self.above[j] > -np.inf:
                out[j] = ~upto(f, self.above[j])
            if self.upto[j] < np.inf:
                out[j] &= upto(f, self.upto[j])
        return out


@dataclass
class _Group:
    """Leaves below one node. ``table`` has what they give to each of ``features`` together, for every set of
    outcomes of ``comparisons``; without one the leaf, then a single one, is worked out row by row."""

    leaves: list[_Leaf]
    comparisons: list[tuple[int, float]] = field(default_factory=list)
    features: list[int] = field(default_factory=list)
    table: np.ndarray | None = None

    def fill(self) -> None:
        self.comparisons = sorted(set().union(*(leaf.comparisons() for leaf in self.leaves)))
        self.features = sorted(set().union(*(leaf.features.tolist() for leaf in self.leaves)))
        outcomes = (np.arange(1 << len(self.comparisons))[:, None] >> np.arange(len(self.comparisons)) & 1).astype(bool)
        known = {c: outcomes[:, i] for i, c in enumerate(self.comparisons)}
        self.table = np.zeros((len(self.features), len(outcomes)))
        for leaf in self.leaves:
            if m := len(leaf.features):
                patterns = np.arange(1 << m)[:, None] >> np.arange(m) & 1
                which = (1 << np.arange(m)) @ leaf.passed(len(outcomes), lambda f, cut: known[f, cut])
                self.table[np.searchsorted(self.features, leaf.features)] += (leaf.value * leaf_shares(patterns, leaf.shares))[which].T


_gauss = cache(np.polynomial.legendre.leggauss)


def leaf_shares(passed: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """What a leaf of value 1 gives to each feature: (patterns, features), from whether each
    pattern of rows passes a feature's splits, and the share of weight that does."""
    m = len(shares)
    points, weights = _gauss((m + 1) // 2)
    u, weights = (points + 1) / 2, weights / 2
    o = passed.astype(np.float64)
    factors = shares[None, :, None] * (1 - u) + o[:, :, None] * u
    rest = factors.prod(axis=1)[:, None, :] / factors
    return (o - shares) * (rest * weights).sum(axis=2)


@dataclass
class TreeEnsemble:
    """A sum of trees over named inputs, plus ``base``."""

    nodes: pd.DataFrame
    inputs: list[str]
    base: float = 0.0
    _groups: list[_Group] = field(default_factory=list, repr=False)
    _walks: list[tuple] = field(default_factory=list, repr=False)

    def _trees(self) -> Iterator[pd.DataFrame]:
        for _, tree in self.nodes.sort_values(["tree", "node"]).groupby("tree", sort=True):
            yield tree.set_index("node")

    def raw(self, x: np.ndarray) -> np.ndarray:
        """The raw prediction of each row of inputs."""
        if not self._walks:
            for tree in self._trees():
                place = {node: i for i, node in enumerate(tree.index)}
                self._walks.append((tree["feature"].to_numpy(), tree["cut"].to_numpy(), *(
                    np.array([place.get(n, -1) for n in tree[side]]) for side in ("below", "above")), tree["value"].to_numpy()))
        out = np.full(len(x), self.base)
        for feature, cut, below, above, value in self._walks:
            at = np.zeros(len(x), dtype=np.int64)
            inner = np.flatnonzero(feature[at] >= 0)
            while len(inner):
                node = at[inner]
                down = x[inner, feature[node]] <= cut[node]
                at[inner] = np.where(down, below[node], above[node])
                inner = inner[feature[at[inner]] >= 0]
            out += value[at]
        return out

    def groups(self) -> list[_Group]:
        """All leaves; those below a node are one group where they share a table."""
        if self._groups:
            return self._groups
        for tree in self._trees():
            rows = {n: r for n, r in zip(tree.index, tree.itertuples(index=False))}
            # Children first: node, by feature: lower end, upper end, share
            walk, order, found = [(tree.index[0], {}, None)], [], {}
            while walk:
                node, path, parent = walk.pop()
                order.append((node, parent))
                r = rows[node]
                if r.feature < 0:
                    found[node] = [_Group([_Leaf(
                        np.array(list(path), dtype=np.int64), *(np.array([p[k] for p in path.values()]) for k in range(3)), r.value)])]
                    continue
                low, high, share = path.get(r.feature, (-np.inf, np.inf, 1.0))
                for child, ends in ((r.below, (low, min(high, r.cut))), (r.above, (max(low, r.cut), high))):
                    part = max(rows[child].cover / r.cover if r.cover else 0.0, 1e-12)
                    walk.append((child, {**path, r.feature: (*ends, share * part)}, node))
            for node, _ in reversed(order):
                if rows[node].feature >= 0:
                    parts = [g for child in (rows[node].below, rows[node].above) for g in found.pop(child)]
                    if len(parts) == 2:
                        together = [leaf for g in parts for leaf in g.leaves]
                        if len(set().union(*(leaf.comparisons() for leaf in together))) <= _TABLED:
                            parts = [_Group(together)]
                    found[node] = parts
            self._groups += found[tree.index[0]]
        return self._groups

    def expected(self) -> float:
        """The base value of the attribution: the prediction when nothing is known."""
        return self.base + sum(leaf.value * leaf.shares.prod() for group in self.groups() for leaf in group.leaves)

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """(rows, inputs)"""
        columns, out = np.ascontiguousarray(x.T), np.zeros((len(self.inputs), len(x)))
        # Leaves of a tree share their splits, so few comparisons are kept for the leaves that follow.
        known: dict[tuple[int, float], np.ndarray] = {}

        def upto(f: int, cut: float) -> np.ndarray:
            if (f, cut) not in known:
                if len(known) >= _KEPT:
                    known.clear()
                known[f, cut] = columns[f] <= cut
            return known[f, cut]

        for group in self.groups():
            if group.table is None and (len(group.leaves) > 1 or len(group.leaves[0].comparisons()) <= _TABLED):
                group.fill()
            if group.table is not None:
                which = np.zeros(len(x), dtype=np.uint16)
                for i, (f, cut) in enumerate(group.comparisons):
                    which |= np.left_shift(upto(f, cut), i, dtype=np.uint16)
                which = which.astype(np.intp)
                for f, values in zip(group.features, group.table):
                    out[f] += values.take(which)
                continue
            leaf, = group.leaves
            bits, which = np.unique((1 << np.arange(len(leaf.features))) @ leaf.passed(len(x), upto), return_inverse=True)
            patterns = bits[:, None] >> np.arange(len(leaf.features)) & 1
            out[leaf.features] += (leaf.value * leaf_shares(patterns, leaf.shares))[which].T
        return out.T

    def ensemble(self) -> TreeEnsemble:
        return self

    def transform(self, rows: DataFrame) -> DataFrame:
        """Add ``rawPrediction`` and ``probability`` (of a margin) as Spark's classifiers do."""
        p, raw = 1 / (1 + F.exp(-F.col("__raw"))), F.col("__raw")
        return rows.withColumn("__raw", raw_score(self)).withColumns({
            "rawPrediction": array_to_vector(F.array(-raw, raw)), "probability": array_to_vector(F.array(1 - p, p))}).drop("__raw")

    def save(self, spark: SparkSession, path: str) -> None:
        kinds = "tree int, node int, feature int, cut double, below int, above int, value double, cover double"
        spark.createDataFrame(self.nodes[NODES], kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = spark.createDataFrame([(self.inputs, self.base)], "inputs array<string>, base double")
        about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def stored_at(spark: SparkSession, path: str) -> bool:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/nodes")
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeEnsemble:
        about = spark.read.parquet(f"{path}/about").first()
        return TreeEnsemble(spark.read.parquet(f"{path}/nodes").toPandas(), list(about["inputs"]), about["base"])


def from_spark(classifier: PipelineModel, inputs: list[str]) -> TreeEnsemble:
    """The node table of a trained Spark ML forest or boosted classifier, by way of its stored form;
    a forest of ``operators/forest.py`` has its own.

    The raw prediction is the probability of class 1 for a forest and the margin (half the
    log-odds) for boosted trees.
    """
    if hasattr(classifier, "ensemble"):
        return classifier.ensemble()
    spark, stage = SparkSession.getActiveSession(), classifier.stages[-1]
    path = new_shared_path(spark, "trees")
    stage.write().overwrite().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight")
    n, stats = F.col("nodeData"), F.col("nodeData.impurityStats")
    forest = hasattr(stage, "getFeatureSubsetStrategy") and stage.numClasses == 2 and not hasattr(stage, "evaluateEachIteration")
    if forest:
        cover = stats[0] + stats[1]
        value = stats[1] / F.greatest(cover, F.lit(1e-300)) / len(stage.trees)
    else:
        cover, value = stats[0], n["prediction"] * F.col("weight")
    # As many rows as the model has nodes; the model itself is as large.
    nodes = spark.read.parquet(f"{path}/data").withColumnRenamed("treeID", "tree").join(
        F.broadcast(weights.select("tree", "weight")), "tree").select(
        "tree", n["id"].alias("node"),
        F.when(n["leftChild"] >= 0, n["split"]["featureIndex"]).otherwise(-1).alias("feature"),
        F.when(n["leftChild"] >= 0, n["split"]["leftCategoriesOrThreshold"][0]).otherwise(0.0).alias("cut"),
        n["leftChild"].alias("below"), n["rightChild"].alias("above"), value.alias("value"), cover.alias("cover"))
    return TreeEnsemble(nodes.toPandas(), list(inputs))


def _over_inputs(ensemble: TreeEnsemble, returns: str, work):
    """A column computed from all inputs, in bounded batches; the ensemble is broadcast once."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(ensemble)

    @F.pandas_udf(returns)
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trees = sent.value
        for rows in batches:
            parts = []
            for s in range(0, len(rows), _ROWS):
                x = np.array(rows.iloc[s:s + _ROWS].tolist(), dtype=np.float64).reshape(-1, len(trees.inputs))
                parts += list(work(trees, x))
            yield pd.Series(parts, index=rows.index)

    return column(F.array(*[F.col(c).cast("double") for c in ensemble.inputs]))


def raw_score(ensemble: TreeEnsemble) -> Column:
    return _over_inputs(ensemble, "double", lambda trees, x: trees.raw(x))


def with_tree_contributions(matrix: DataFrame, ensemble: TreeEnsemble) -> DataFrame:
    """Add ``contributions``: an array of (feature, value) in the order of the inputs."""
    values = _over_inputs(ensemble, "array<double>", lambda trees, x: trees.contributions(x))
    names = F.array(*[F.lit(c) for c in ensemble.inputs])
    return matrix.select("*", values.alias("__values")).withColumn(
        "contributions", F.zip_with(names, "__values", lambda n, v: F.struct(n.alias("feature"), v.alias("value")))
    ).drop("__values")
