"""Centroid clustering in exact integers, with a vantage-point tree over the centroids.

Each round the driver builds a vantage-point tree over the few centroids and broadcasts it.
Every vector walks the tree best first: the open node of the smallest lower bound comes next,
and a node is passed over only when its bound lies beyond the best distance so far, so that
centroids at exactly that distance are still seen and ties go to the smaller number. Bounds
come from the triangle inequality in floating point and give way by more than their rounding
error; the distances that decide are exact integers. All vectors of a batch take their steps
side by side.

A task returns one sum per centroid and component, split into 30-bit limbs so that sums of any
size stay exact; Spark adds them up, and ``k * (dimension + 1)`` numbers reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import table
from riskloom.session import durable

#: Centroids in a leaf of the tree.
LEAF = 2
#: Vectors that walk the tree side by side.
SIDE_BY_SIDE = 4096
_LIMB = 30
_SUMS = "cluster int, place int, limb int, total bigint"
_LARGEST = 2**63 - 1


def whole_numbers(column: pa.Array, dimension: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, whole numbers held as doubles."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dimension)
    return np.floor(x * scale)


def number_type(dimension: int, largest: float) -> type:
    """The fastest type in which squared distances of such components are exact."""
    reach = dimension * (2 * largest) ** 2 if largest < 2.0**40 else float("inf")
    return np.float64 if reach < 2.0**53 else np.int64 if reach < 2.0**62 else object


def as_type(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return values.astype(kind)
    out = np.empty(values.shape, dtype=object)
    out.ravel()[:] = [int(v) for v in values.ravel()]
    return out


class VantageTree:
    """Vantage-point tree over centroids given as lists of Python integers.

    A node holds one centroid, its vantage point, and two children with the nearest and the
    farthest distance of their centroids from it; a leaf holds a few centroids.
    """

    def __init__(self, centroids: list[list[int]], leaf: int = LEAF) -> None:
        self.centroids = centroids
        self.largest = float(max((abs(v) for c in centroids for v in c), default=0))
        self.nodes: list[tuple] = []
        self._build(list(range(len(centroids))), leaf)

    def _squared(self, a: int, b: int) -> int:
        return sum((x - y) ** 2 for x, y in zip(self.centroids[a], self.centroids[b]))

    def _build(self, members: list[int], leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(members) <= leaf:
            self.nodes[at] = ("leaf", members)
            return at
        point, rest = members[0], members[1:]
        away = sorted((self._squared(point, m), m) for m in rest)
        middle = (len(away) + 1) // 2
        halves = []
        for part in (away[:middle], away[middle:]):
            if part:
                near, far = _root(part[0][0]), _root(part[-1][0])
                halves.append((self._build([m for _, m in part], leaf), near, far))
        self.nodes[at] = ("point", point, halves)
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of each row of whole numbers held as doubles."""
        largest = max(self.largest, float(np.abs(vectors).max(initial=0)))
        kind = number_type(vectors.shape[1], largest)
        x = as_type(vectors, kind)
        centres = as_type(np.array(self.centroids, dtype=object), kind)
        number = np.empty(len(x), dtype=np.int32)
        squared = np.empty(len(x), dtype=object if kind is object else np.int64)
        for s in range(0, len(x), SIDE_BY_SIDE):
            part = slice(s, s + SIDE_BY_SIDE)
            number[part], squared[part] = self._walk(x[part], centres, kind)
        return number, squared

    def _walk(self, x: np.ndarray, centres: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
        n = len(x)
        bound = np.full((n, len(self.nodes)), np.inf)
        bound[:, 0] = 0
        best = np.full(n, None if kind is object else np.inf if kind is np.float64 else _LARGEST, dtype=kind)
        number = np.full(n, len(centres), dtype=np.int32)

        def meet(rows: np.ndarray, c: int) -> np.ndarray:
            away = ((x[rows] - centres[c]) ** 2).sum(axis=1)
            if kind is object:
                closer = np.array([number[r] == len(centres) or (d, c) < (best[r], number[r])
                                   for r, d in zip(rows.tolist(), away)], dtype=bool)
            else:
                closer = (away < best[rows]) | ((away == best[rows]) & (c < number[rows]))
            best[rows[closer]], number[rows[closer]] = away[closer], c
            return away

        alive = np.arange(n)
        while len(alive):
            node = bound[alive].argmin(axis=1)
            lowest = bound[alive, node]
            # A node at exactly the best distance is still opened. Numbers too large for floating
            # point have bounds of zero, so all of their nodes are opened.
            reach = np.inf if kind is object else np.sqrt(best[alive].astype(np.float64)) * (1 + 1e-9)
            open_ = (lowest <= reach) & (lowest < np.inf)
            alive, node = alive[open_], node[open_]
            for v in np.unique(node).tolist():
                rows = alive[node == v]
                own = bound[rows, v]
                bound[rows, v] = np.inf
                what, *content = self.nodes[v]
                if what == "leaf":
                    for c in content[0]:
                        meet(rows, c)
                    continue
                point, halves = content
                away = meet(rows, point)
                for child, near, far in halves:
                    if kind is object:
                        bound[rows, child] = 0
                    else:
                        d = np.sqrt(away.astype(np.float64))
                        gap = np.maximum(near - d, d - far) - 1e-9 * (far + d)
                        bound[rows, child] = np.maximum(own, np.maximum(gap, 0))
        return number, best if kind is object else best.astype(np.int64)


def _root(squared: int) -> float:
    return float(squared) ** 0.5 if squared < 1 << 1000 else float("inf")


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
    while value:
        value, low = value >> _LIMB, value & ((1 << _LIMB) - 1)
        if low:
            yield limb, sign * low
        limb += 1


def _sums(batches: Iterator[pa.RecordBatch], tree: VantageTree, dimension: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Exact sums by cluster and component; place -1 counts the vectors."""
    totals: dict[int, list] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        x = whole_numbers(batch.column(0), dimension, scale)
        cluster, _ = tree.nearest(x)
        # Sums over a batch are exact as doubles while they stay under 2^53.
        exact = np.abs(x).max(initial=0) * len(x) < 2.0**53
        for c in np.unique(cluster).tolist():
            own = x[cluster == c]
            part = own.sum(axis=0).tolist() if exact else as_type(own, object).sum(axis=0).tolist()
            kept = totals.setdefault(c, [0] * (dimension + 1))
            for i, v in enumerate([*map(int, part), len(own)]):
                kept[i] += v
    rows = [(c, i if i < dimension else -1, limb, v)
            for c, values in totals.items() for i, value in enumerate(values) for limb, v in _limbs(value)]
    cluster, place, limb, total = zip(*rows) if rows else ((), (), (), ())
    yield pa.RecordBatch.from_arrays(
        [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(limb, pa.int32()), pa.array(total, pa.int64())],
        names=["cluster", "place", "limb", "total"])


def _assigned(batches: Iterator[pa.RecordBatch], tree: VantageTree, dimension: int, scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            cluster, squared = tree.nearest(whole_numbers(batch.column(1), dimension, scale))
            fits = pa.array([int(d) if d <= _LARGEST else None for d in squared.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), fits], names=["_id", "cluster", "distance"])


def good_vectors(rows: DataFrame, key: str, vector: str, dimension: int, scale: int) -> DataFrame:
    """``_id, _vector`` of the vectors that take part."""
    wide = F.col(vector).cast("array<double>")
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * float(scale)) == float("inf")))
    return rows.select(F.col(key).alias("_id"), F.col(vector).alias("_vector")).where(
        F.coalesce((F.size(vector) == dimension) & ~bad, F.lit(False)))


def centroid_clusters(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10,
                      dimension: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """Clusters of the vectors with exactly ``dimension`` components, none null or non-finite.

    A component x counts as floor(scale * x); one whose product leaves the range of a double
    counts as non-finite. Centroids start as the ``k`` vectors with the smallest
    sha256 of ``seed:key``, in that order; a null key is hashed as empty, and rows that repeat
    a key are ordered by their vectors. Each round assigns every vector to the nearest centroid (squared
    Euclidean distance, ties to the smaller number) and moves every non-empty centroid to the
    floor of its vectors' mean; empty ones stay. A last assignment follows.

    Returns a row per vector, repeated rows included: the key, ``cluster``, ``distance``
    (squared), ``cluster_inertia`` and ``inertia`` (distances summed over the cluster and over
    all) and ``centroid_sha256`` (of the final centroid's components joined by commas).
    Clusters are found exactly at any magnitude; a distance or sum beyond a long is null. With fewer vectors than ``k``
    there are as many centroids as vectors; no vector, no row. Other columns are ignored.
    ``k`` centroids and their sums, ``k * (dimension + 1)`` numbers, are all that passes through the driver.
    """
    spark = rows.sparkSession
    vectors = durable(good_vectors(rows, key, vector, dimension, scale))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    # The k first of every task, then the first k of those.
    first = vectors.select(digest.alias("digest"), "_vector").orderBy("digest", "_vector").limit(k).collect()
    centroids = [[int(v) for v in np.floor(np.array(r["_vector"], dtype=np.float64) * scale)] for r in first]
    out = T.StructType([T.StructField(key, vectors.schema["_id"].dataType), *T.StructType.fromDDL(
        "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string").fields])
    if not centroids:
        return spark.createDataFrame([], out)
    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))
        sums = vectors.select("_vector").mapInArrow(
            lambda b, t=tree: _sums(b, t.value, dimension, scale), _SUMS)
        found: dict[int, list[int]] = {}
        for r in sums.groupBy("cluster", "place", "limb").agg(F.sum("total").alias("total")).collect():
            found.setdefault(r["cluster"], [0] * (dimension + 1))[r["place"]] += int(r["total"]) << (_LIMB * r["limb"])
        tree.unpersist()
        moved = [[s // found[c][-1] for s in found[c][:-1]] if c in found else old for c, old in enumerate(centroids)]
        if moved == centroids:
            break  # every further round would find the same
        centroids = moved
    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    schema = T.StructType([vectors.schema["_id"], *T.StructType.fromDDL("cluster int, distance bigint").fields])
    assigned = durable(vectors.mapInArrow(lambda b: _assigned(b, tree.value, dimension, scale), schema))
    # One row per cluster.
    sums = {r["cluster"]: None if r["lost"] else int(r["total"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.max(F.col("distance").isNull()).alias("lost")).collect()}
    whole = None if None in sums.values() else sum(sums.values())
    fits = lambda v: None if v is None or v > _LARGEST else v
    about = spark.createDataFrame(
        [(c, fits(v), fits(whole), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, v in sums.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(
        F.col("_id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clusters(spark, sf_dir):
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def _sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds one after the other, over one row per vector and component."""
    assign = """a{r} AS MATERIALIZED (
  SELECT rid, c, d FROM (SELECT x.rid, m.c, sum((x.x - m.x) * (x.x - m.x)) AS d
    FROM x JOIN c{before} m USING (i) GROUP BY x.rid, m.c)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)"""
    move = """c{r} AS MATERIALIZED (
  SELECT m.c, m.i, CASE WHEN n IS NULL THEN m.x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM c{before} m LEFT JOIN (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{r} JOIN x USING (rid) GROUP BY c, i) t
    ON m.c = t.c AND m.i = t.i)"""
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor(1024 * e::DOUBLE)::BIGINT for e in embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len([e for e in embedding if e IS NULL OR NOT isfinite(e)]) = 0),
x AS MATERIALIZED (SELECT rid, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM v),
c0 AS MATERIALIZED (
  SELECT place - 1 AS c, i, x FROM x JOIN (SELECT rid, row_number() OVER (
    ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) AS place FROM v) USING (rid) WHERE place <= {k})"""]
    for r in range(1, rounds + 2):
        steps.append(assign.format(r=r, before=r - 1))
        if r <= rounds:
            steps.append(move.format(r=r, before=r - 1))
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a.c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds + 1} a JOIN v USING (rid)
JOIN (SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c) m ON a.c = m.c
"""


OP11_SQL = _sql()
