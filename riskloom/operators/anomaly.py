"""Isolation forest: unsupervised anomaly scores, higher is stranger.

Trees grow on small samples, one group of at most ``sample`` rows per tree, and the
forest is a node table of bounded size that every scoring task can hold.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators.ordered import exact_quantiles

# Forest settings.
TREES = 100
SAMPLE_ROWS = 256
SEED = 42

_NODE = ("tree int, node int, feature int, cut double, below int, above int, depth double,"
         " sample int")


def _mean_path(n: float) -> float:
    """Expected path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def samples(rows: DataFrame, key: str, trees: int = TREES, size: int = SAMPLE_ROWS,
            seed: int = SEED) -> DataFrame:
    """``size`` rows for each tree, chosen by hash, so the same ones on every run.

    One pass picks a pool of at most trees x size rows in hash order, which is random with
    respect to the data. Tree t takes a run of ``size`` neighbours of the pool, starting
    t / trees of the way round; runs overlap only when the pool is smaller than that.
    """
    order = [F.xxhash64(F.col(key), F.lit(seed)), F.col(key)]
    pool = rows.orderBy(*order).limit(trees * size)
    ranked = pool.select(  # the windows run over the bounded pool
        "*", (F.row_number().over(W.orderBy(*order)) - 1).alias("__rank"),
        F.count("*").over(W.partitionBy(F.lit(0))).alias("__pool"))
    start = lambda t: F.floor(t * F.col("__pool") / trees)
    mine = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)),
                    lambda t: F.pmod(F.col("__rank") - start(t), F.col("__pool")) < size)
    return ranked.withColumn("tree", F.explode(mine)).drop("__rank", "__pool")


def train(rows: DataFrame, inputs: list[str], key: str = "transaction_id", trees: int = TREES,
          size: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """The forest as a node table (at most trees x (2 size - 1) rows)."""
    drawn = samples(
        rows.select(key, F.array(*[F.col(c).cast("double") for c in inputs]).alias("x")),
        key, trees, size, seed)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        data = np.stack(group.sort_values(key)["x"].to_numpy())
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(data), 2)))
        nodes, open_nodes = [], [(0, np.arange(len(data)), 0)]
        count = 1
        while open_nodes:
            node, members, depth = open_nodes.pop()
            here = data[members]
            low, high = here.min(axis=0), here.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(members) <= 1 or len(usable) == 0:
                nodes.append((tree, node, -1, 0.0, -1, -1, depth + _mean_path(len(members)),
                              len(data)))
                continue
            feature = int(rng.choice(usable))
            cut = float(rng.uniform(low[feature], high[feature]))
            left = here[:, feature] <= cut
            nodes.append((tree, node, feature, cut, count, count + 1, 0.0, len(data)))
            open_nodes += [(count, members[left], depth + 1), (count + 1, members[~left], depth + 1)]
            count += 2
        return pd.DataFrame(nodes, columns=[c.split()[0] for c in _NODE.split(",")])

    return drawn.groupBy("tree").applyInPandas(grow, _NODE)


def _steps(tree: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """A tree for many rows at once: features, cuts, the node after each node (two a node: above and
    below its cut; a leaf stays where it is), depths, and how many steps reach every leaf."""
    tree = tree.sort_values("node")
    feature, below, above = (tree[c].to_numpy(np.int64) for c in ("feature", "below", "above"))
    leaf, after = feature < 0, np.repeat(np.arange(len(feature)), 2)
    after[0::2][~leaf], after[1::2][~leaf] = above[~leaf], below[~leaf]
    steps, inner = 0, np.flatnonzero(~leaf[:1])
    while len(inner):
        reached = np.concatenate([below[inner], above[inner]])
        steps, inner = steps + 1, reached[~leaf[reached]]
    return np.maximum(feature, 0), tree["cut"].to_numpy(), after, tree["depth"].to_numpy(), steps


def _path_lengths(data: np.ndarray, trees: list[tuple]) -> np.ndarray:
    """Per row of ``data`` the sum of its path lengths over all trees; a missing value goes above."""
    flat, at_row, total = np.ascontiguousarray(data.T).ravel(), np.arange(len(data)), np.zeros(len(data))
    for feature, cut, after, depth, steps in trees:
        column, node = feature * len(data), np.zeros(len(data), np.int64)
        for _ in range(steps):
            below = flat.take(column.take(node) + at_row) <= cut.take(node)
            node = after.take(2 * node + below)
        total += depth.take(node)
    return total


def score(rows: DataFrame, forest: DataFrame, inputs: list[str],
          output: str = "anomaly_score") -> DataFrame:
    """Add the anomaly score 2^(-mean path length / expected path length).

    The expected length follows from the rows each tree really grew on. Trees of a single
    row tell nothing apart, and neither does an empty forest: the score is then 0.5.
    """
    table = forest.toPandas().sort_values(["tree", "node"])  # bounded, see train
    trees = [_steps(g) for _, g in table.groupby("tree")]
    grown = table.groupby("tree")["sample"].first()
    expected = float(grown.map(_mean_path).mean()) if len(grown) else 0.0
    if expected == 0.0:
        return rows.withColumn(output, F.lit(0.5))

    @F.pandas_udf("double")
    def strangeness(x: pd.Series) -> pd.Series:
        data = np.stack(x.to_numpy()) if len(x) else np.empty((0, len(inputs)))
        return pd.Series(2.0 ** (-(_path_lengths(data, trees) / len(trees)) / expected))

    x = F.array(*[F.col(c).cast("double") for c in inputs])
    return rows.withColumn(output, strangeness(x))


# Fixed value: the share of training rows taken for anomalies.
CONTAMINATION = 0.02


def cut_off(scored: DataFrame, contamination: float = CONTAMINATION, score: str = "anomaly_score", **options) -> float | None:
    """The score above which ``contamination`` of the scored rows lie, interpolated between ranks;
    None without rows."""
    found = exact_quantiles(scored, [], score, [1 - contamination], **options).first()
    return None if found is None else found["quantile"]


def flagged(scored: DataFrame, cut: float | None, score: str = "anomaly_score") -> DataFrame:
    """Add ``is_anomaly``: 1 where the score is above the cut-off, 0 elsewhere and without one."""
    above = F.lit(False) if cut is None else F.col(score) > cut
    return scored.withColumn("is_anomaly", F.coalesce(above, F.lit(False)).cast("int"))
