"""Embedding near-dedup by Euclidean p-stable hashing.

Equal vectors are collapsed. The others, normalised, are projected on random Gaussian
directions, shifted and quantised; ``projections`` of these numbers make the bucket of one of
``tables`` hash tables. Vectors that share a bucket are compared exactly. Both counts follow
from the number of vectors and the wanted recall at the threshold, so that a vector meets a
bounded number of strangers in a table at any size.

A bucket of more than ``TILE`` vectors is dealt in tiles, and every pair of tiles is a task of
its own, so a bucket of any size is compared whole. Pairs are counted in the first table in
which they meet, and leave a tile as link counts and as one link from each vector to the
smallest of its component inside the tile, never as all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import components, table
from riskloom.session import durable

THRESHOLD = 0.9
#: Chance that a pair right at the threshold meets; closer pairs meet almost surely.
RECALL = 0.93
#: Width of a quantisation step, for vectors of length one.
WIDTH = 1.5
#: Vectors that are compared with each other in one piece.
TILE = 1024
_SMALL = 48


def meeting_chance(distance: float, width: float = WIDTH) -> float:
    """Chance that two vectors at a distance share one quantised projection."""
    if distance <= 0:
        return 1.0
    c = width / distance
    tail = 0.5 * math.erfc(c / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


def tuned(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL, strangers: float = 32.0) -> tuple[int, int]:
    """(projections, tables): an unrelated vector meets about ``strangers`` of all in a table,
    and a pair at the threshold meets in one of them with the chance ``recall``."""
    unrelated = meeting_chance(math.sqrt(2))
    projections = max(2, math.ceil(math.log(max(vectors / strangers, 2)) / -math.log(unrelated)))
    near = meeting_chance(math.sqrt(max(0.0, 2 - 2 * threshold))) ** projections
    tables = 1 if near >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - near))
    return projections, max(1, tables)


class Hashing:
    """The hash tables for vectors of one dimension."""

    def __init__(self, dimension: int, projections: int, tables: int, seed: int = 17) -> None:
        rng = np.random.default_rng([seed, dimension])
        self.directions = rng.standard_normal((dimension, projections * tables))
        self.shifts = rng.random(projections * tables) * WIDTH
        self.mix = rng.integers(1, 2**63, size=(tables, projections), dtype=np.uint64) | np.uint64(1)
        self.salt = rng.integers(0, 2**63, size=tables, dtype=np.uint64)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table (rows, tables)."""
        steps = np.floor((unit @ self.directions + self.shifts) / WIDTH).astype(np.int64)
        steps = steps.reshape(len(unit), *self.mix.shape).view(np.uint64)
        mixed = (steps * self.mix).sum(axis=2, dtype=np.uint64) + self.salt
        mixed ^= mixed >> np.uint64(31)
        return (mixed * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _unit(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # The largest component goes to between 1/2 and 1 first, by a power of two, which loses
    # nothing: squares of very large or very small components would leave the range of doubles.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _bucketed(batches: Iterator[pa.RecordBatch], projections: int, tables: int) -> Iterator[pa.RecordBatch]:
    made: dict[int, Hashing] = {}
    for batch in batches:
        sizes = np.array([len(v) for v in batch.column(1)])
        for size in np.unique(sizes).tolist():
            mine = np.flatnonzero(sizes == size)
            hashing = made.setdefault(size, Hashing(size, projections, tables))
            for i in range(0, len(mine), 4096):
                own = batch.take(pa.array(mine[i:i + 4096]))
                keys = hashing.keys(_unit(own.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(own.column(0).to_numpy(), tables))], names=["bucket", "cls"])


def _spread(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest class of the component of each vector on either side of a link matrix."""
    none = np.iinfo(np.int64).max
    x, y = left.copy(), right.copy()
    while True:
        near_y = np.where(linked, x[:, None], none).min(axis=0)
        new_y = np.minimum(y, near_y)
        new_x = np.minimum(x, np.where(linked, new_y[None, :], none).min(axis=1))
        if (new_x == x).all() and (new_y == y).all():
            return x, y
        x, y = new_x, new_y


class _Found:
    """Link counts and links, summed up before they are handed on."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> None:
        if len(a):
            self.parts.append((a, b, n))
            self.size += len(a)

    def batch(self) -> pa.RecordBatch:
        a, b, n = (np.concatenate(c) for c in zip(*self.parts))
        frame = pd.DataFrame({"a": a, "b": b, "n": n}).groupby(["a", "b"], as_index=False).sum()
        self.__init__()
        return pa.RecordBatch.from_pandas(frame, preserve_index=False)


def _first_meeting(keys_x: np.ndarray, keys_y: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether the first table in which each pair meets has that bucket."""
    same = keys_x == keys_y
    first = same.argmax(axis=1)
    rows = np.arange(len(same))
    return same[rows, first] & (keys_x[rows, first] == bucket)


def _compare(batches: Iterator[pa.RecordBatch], projections: int, tables: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Compare the vectors of each (bucket, left, right), rows of which follow each other.

    Output: (class, -1, links) and (class, class, 0). A group may go on in the next batch.
    """
    made: dict[int, Hashing] = {}
    found = _Found()
    none = np.int64(-1)

    def small(group: np.ndarray, bucket: np.ndarray, cls: np.ndarray, n: np.ndarray, unit: np.ndarray, keys: np.ndarray) -> None:
        """All pairs within groups of a few rows, rows sorted by group."""
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        ends = np.repeat(np.r_[starts[1:], len(group)], np.diff(np.r_[starts, len(group)]))
        after = ends - np.arange(len(group)) - 1
        i = np.repeat(np.arange(len(group)), after)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
        for s in range(0, len(i), 65_536):
            a, b = i[s:s + 65_536], j[s:s + 65_536]
            near = (np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold) & (cls[a] != cls[b])
            a, b = a[near], b[near]
            if len(a):
                fresh = _first_meeting(keys[a], keys[b], bucket[a])
                a, b = a[fresh], b[fresh]
                found.add(np.r_[cls[a], cls[b]], np.full(2 * len(a), none), np.r_[n[b], n[a]])
                found.add(np.minimum(cls[a], cls[b]), np.maximum(cls[a], cls[b]), np.zeros(len(a), np.int64))

    def tiles(bucket: int, left: np.ndarray, right: np.ndarray, same: bool, cls, n, unit, keys) -> None:
        linked = unit[left] @ unit[right].T >= threshold
        linked &= cls[left][:, None] != cls[right][None, :]
        x, y = np.nonzero(linked)
        for s in range(0, len(x), 65_536):
            a, b = left[x[s:s + 65_536]], right[y[s:s + 65_536]]
            fresh = _first_meeting(keys[a], keys[b], np.full(len(a), bucket))
            a, b = a[fresh], b[fresh]
            found.add(cls[a], np.full(len(a), none), n[b])
            if not same:
                found.add(cls[b], np.full(len(b), none), n[a])
            if found.size > 500_000:
                found.parts = [_merged(found.parts)]
                found.size = len(found.parts[0][0])
        if len(x):
            to_x, to_y = _spread(linked, cls[left], cls[right])
            for own, to in ((cls[left], to_x), (cls[right], to_y)):
                moved = own != to
                found.add(to[moved], own[moved], np.zeros(moved.sum(), np.int64))

    def handle(rows: pa.Table) -> None:
        sizes = pa.compute.list_value_length(rows["embedding"]).to_numpy()
        for size in np.unique(sizes).tolist():
            mine = rows.take(pa.array(np.flatnonzero(sizes == size)))
            hashing = made.setdefault(size, Hashing(size, projections, tables))
            unit = _unit(mine["embedding"].combine_chunks())
            keys = hashing.keys(unit)
            bucket, left, right, tile, cls, n = (mine[c].to_numpy() for c in ("bucket", "left", "right", "tile", "cls", "n"))
            border = np.r_[True, (bucket[1:] != bucket[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])]
            group = np.cumsum(border) - 1
            count = np.bincount(group)
            few = np.repeat(count <= _SMALL, count) & (left == right)
            if few.any():
                small(group[few], bucket[few], cls[few], n[few], unit[few], keys[few])
            starts = np.flatnonzero(border)
            for g in np.unique(group[~few]).tolist():
                at = np.arange(starts[g], starts[g] + count[g])
                same = left[at[0]] == right[at[0]]
                ours = at if same else at[tile[at] == left[at[0]]]
                theirs = at if same else at[tile[at] == right[at[0]]]
                for p in range(0, len(ours), TILE):
                    for q in range(p if same else 0, len(theirs), TILE):
                        tiles(int(bucket[at[0]]), ours[p:p + TILE], theirs[q:q + TILE], same and p == q, cls, n, unit, keys)

    held: pa.Table | None = None
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        # Small batches are put together.
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) < 4096:
            continue
        rows = pa.Table.from_batches(waiting)
        waiting = []
        rows = rows if held is None else pa.concat_tables([held, rows])
        bucket, left, right = (rows[c].to_numpy() for c in ("bucket", "left", "right"))
        # The last group may go on.
        last = (bucket == bucket[-1]) & (left == left[-1]) & (right == right[-1])
        end = int(np.argmax(last)) if len(rows) else 0
        handle(rows.slice(0, end)) if end else None
        held = rows.slice(end)
        if found.size > 200_000:
            yield found.batch()
    if waiting:
        rows = pa.Table.from_batches(waiting)
        held = rows if held is None else pa.concat_tables([held, rows])
    if held is not None and len(held):
        handle(held)
    if found.size:
        yield found.batch()


def _merged(parts):
    a, b, n = (np.concatenate(c) for c in zip(*parts))
    frame = pd.DataFrame({"a": a, "b": b, "n": n}).groupby(["a", "b"], as_index=False).sum()
    return tuple(frame[c].to_numpy() for c in ("a", "b", "n"))


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                 recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``rows(vec_id, embedding)``.

    ``n_links`` counts the other rows linked directly, copies included; ``component_id`` is the
    smallest identifier reachable over links; ``kept`` says that it is the row's own. Null,
    empty and zero vectors and those with a null or non-finite component link with nothing.
    Vectors link only with vectors of the same length. Rows that repeat an identifier count
    as rows. A null identifier is passed over as a component's name where there is another.
    An empty table gives an empty result; other columns are ignored.
    """
    wide = F.col(vector).cast("array<double>")
    finite = ~F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(wide, lambda x: x != 0)
    good = F.coalesce((F.size(vector) > 0) & finite & some, F.lit(False))
    rows = rows.select(F.col(key).alias("vec_id"), F.when(good, F.col(vector)).alias("embedding"))
    classes = rows.where("embedding is not null").groupBy("embedding").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = durable(classes.withColumn("cls", F.monotonically_increasing_id()))
    projections, tables = tuned(classes.count(), threshold, recall)

    met = durable(classes.select("cls", "embedding").mapInArrow(
        lambda b: _bucketed(b, projections, tables), "bucket bigint, cls bigint").distinct())
    sizes = met.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").withColumn(
        "tiles", F.ceil(F.col("size") / TILE).cast("int"))
    dealt = met.join(sizes.select("bucket", "tiles"), "bucket").withColumn(
        "tile", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int"))
    # Every vector meets every tile of its bucket once.
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "bucket", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"), "tile", "cls")
    full = dealt.join(classes.select("cls", "n", "embedding"), "cls").select(
        "bucket", "left", "right", "tile", "cls", "n", "embedding")
    compared = full.repartition("bucket", "left", "right").sortWithinPartitions("bucket", "left", "right", "cls").mapInArrow(
        lambda b: _compare(b, projections, tables, threshold), "a bigint, b bigint, n bigint")
    compared = durable(compared.groupBy("a", "b").agg(F.sum("n").alias("n")))

    counts = compared.where("b = -1").select(F.col("a").alias("cls"), F.col("n").alias("links"))
    roots = durable(components(compared.where("b >= 0").select("a", "b")).withColumnRenamed("node", "cls"))
    names = roots.join(classes.select("cls", "least"), "cls").groupBy("root").agg(F.min("least").alias("name"))
    named = roots.join(names, "root").select("cls", "name")
    known = durable(classes.join(counts, "cls", "left").join(named, "cls", "left").select(
        F.col("embedding"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("name", "least").alias("component_id")))
    out = rows.join(known, "embedding", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op6_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))
