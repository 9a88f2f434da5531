"""Hard-negative mining with Kronecker-packed products.

Components become whole numbers. Several candidates travel in one wide integer: the bias
``b``, the largest magnitude of any component, makes their i-th components non-negative, and
each gets a bit field of its own, wide enough for a whole sum of products. One multiplication
by the anchor's biased i-th component then multiplies all of them, the sum over i never
carries from field to field, and each field holds

    sum (a_i + b)(c_i + b) = a.c + b * sum a_i + b * sum c_i + n * b * b

of which all but the exact score ``a.c`` are known sums. The wide integer is the 53-bit whole
part of a double where two fields fit, so that a matrix product does the multiplications; else
64 bits; else a Python integer of sixteen fields.

The anchors are a stated query set and meet all rows in blocks: a block of bounded bytes is
broadcast, and one scan over the stored rows leaves a task's best few per anchor. A first scan
finds the positives of a block, a second one the negatives, whose bounds follow from the
scores of the positives. Rows are never shuffled; the best of every task are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.session import durable

#: Bytes of anchors that are broadcast at a time.
BLOCK_BYTES = 32 << 20
#: Rows and anchors that are multiplied at a time.
ROWS, ANCHORS = 2048, 1024
_FIELDS = 16


class Packing:
    """Bit fields for vectors of one length whose components are at most ``bias`` in magnitude."""

    def __init__(self, length: int, bias: int) -> None:
        self.length, self.bias = length, bias
        self.width = max(1, (length * (2 * bias) ** 2).bit_length())
        if 2 * self.width <= 53:
            self.kind, self.fields = np.float64, 53 // self.width
        elif 2 * self.width <= 64:
            self.kind, self.fields = np.uint64, 64 // self.width
        else:
            self.kind, self.fields = object, _FIELDS
        self.score_type = object if self.kind is object else np.int64

    def whole(self, column: pa.Array, scale: int) -> np.ndarray:
        """floor(scale * x) of every component."""
        x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
        x = x.reshape(len(column), self.length)
        if self.kind is not object:
            return x.astype(np.int64)
        out = np.empty(x.shape, dtype=object)
        out.ravel()[:] = [int(v) for v in x.ravel()]
        return out

    def packed(self, x: np.ndarray) -> np.ndarray:
        """(length, wide integers): field j of wide integer q is row ``j * wide + q``."""
        wide = -(-len(x) // self.fields)
        out = np.zeros((wide, self.length), dtype=object if self.kind is object else np.uint64)
        for j in range(self.fields):
            own = x[j * wide:(j + 1) * wide] + self.bias
            out[:len(own)] += own << (self.width * j) if self.kind is object else own.astype(np.uint64) << np.uint64(self.width * j)
        return out.astype(self.kind).T

    def scores(self, anchors: np.ndarray, x: np.ndarray, packed: np.ndarray) -> np.ndarray:
        """Exact inner products (anchors, rows)."""
        products = (anchors + self.bias).astype(self.kind) @ packed
        if self.kind is np.float64:
            products = products.astype(np.uint64)
        out = np.empty((len(anchors), len(x)), dtype=self.score_type)
        wide, mask = packed.shape[1], (1 << self.width) - 1
        for j in range(self.fields):
            part = out[:, j * wide:(j + 1) * wide]
            own = products[:, :part.shape[1]]
            if self.kind is object:
                part[:] = (own >> (self.width * j)) & mask
            else:
                part[:] = ((own >> np.uint64(self.width * j)) & np.uint64(mask)).astype(np.int64)
        known = self.bias * x.sum(axis=1) + self.length * self.bias**2
        out -= (self.bias * anchors.sum(axis=1))[:, None] + known[None, :]
        return out


class Top:
    """The ``k`` best of each slot: higher scores first, then smaller keys, null keys last."""

    def __init__(self, k: int, least: np.ndarray) -> None:
        self.k = k
        #: A score below this can't be among the best of its slot any more.
        self.least = least.copy()
        self.held = [np.empty(0, np.int64), least[:0].copy(), np.empty(0, np.int64), np.empty(0, bool)]
        self.fresh: list[list[np.ndarray]] = []

    def add(self, slot: np.ndarray, score: np.ndarray, key: np.ndarray, nameless: np.ndarray) -> None:
        if len(slot):
            self.fresh.append([slot, score, key, nameless])

    def settle(self) -> None:
        if not self.fresh:
            return
        slot, score, key, nameless = (np.concatenate(c) for c in zip(self.held, *self.fresh))
        self.fresh = []
        place = np.unique(score, return_inverse=True)[1] if score.dtype == object else score
        order = np.lexsort((key, nameless, -place, slot))
        slot = slot[order]
        starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(starts, np.diff(np.r_[starts, len(slot)]))
        best = rank < self.k
        self.held = [slot[best], score[order][best], key[order][best], nameless[order][best]]
        full = rank[best] == self.k - 1
        self.least[self.held[0][full]] = self.held[1][full]


class Block:
    """Anchors of one length: whole components, labels as small numbers, row numbers ascending."""

    def __init__(self, rows: pa.Table, packing: Packing, scale: int) -> None:
        rows = rows.sort_by("_row")
        self.packing = packing
        self.row = rows["_row"].to_numpy()
        self.whole = packing.whole(rows["_vector"].combine_chunks(), scale)
        names = rows["_label"].to_pylist()
        self.codes = {name: i for i, name in enumerate(dict.fromkeys(names))}
        self.label = np.array([self.codes[name] for name in names], dtype=np.int64)

    def coded(self, column: pa.Array) -> np.ndarray:
        """Labels no anchor has count as -1."""
        return np.array([self.codes.get(name, -1) for name in column.to_pylist()], dtype=np.int64)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of ROWS rows; the first ones are smaller, so that good bounds are known early."""
    waiting, size, want = [], 0, 64
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= want:
            rows, at = pa.Table.from_batches(waiting), 0
            while len(rows) - at >= want:
                yield rows.slice(at, want)
                at, want = at + want, min(2 * want, ROWS)
            waiting = rows.slice(at).to_batches()
            size = len(rows) - at
    if size:
        yield pa.Table.from_batches(waiting)


def _meetings(batches: Iterator[pa.RecordBatch], blocks: dict[int, Block], scale: int):
    """(block, row numbers, keys, nameless, label codes, whole components) of rows of one length."""
    for rows in _put_together(batches):
        sizes = pc.list_value_length(rows["_vector"]).to_numpy()
        for size in np.unique(sizes).tolist():
            if size not in blocks:
                continue
            own = rows.take(pa.array(np.flatnonzero(sizes == size)))
            block = blocks[size]
            key = own["_id"].combine_chunks()
            yield (block, own["_row"].to_numpy(), key.fill_null(0).to_numpy(zero_copy_only=False),
                   key.is_null().to_numpy(zero_copy_only=False), block.coded(own["_label"]),
                   block.packing.whole(own["_vector"].combine_chunks(), scale))


def _coded_scores(score: np.ndarray, offset: int | None) -> list[pa.Array]:
    """The score, null beyond a long, and, where scores may be longer, text that sorts like it."""
    if offset is None:
        return [pa.array(score.astype(np.int64))]
    digits = len(f"{2 * offset:x}")
    return [pa.array([v if -2**63 <= v < 2**63 else None for v in map(int, score)], pa.int64()),
            pa.array([f"{int(v) + offset:0{digits}x}" for v in score], pa.string())]


def _out(best: dict[int, Top], blocks: dict[int, Block], per_anchor: int, offset: int | None) -> Iterator[pa.RecordBatch]:
    for size, top in best.items():
        top.settle()
        slot, score, key, nameless = top.held
        if len(slot):
            scores = _coded_scores(score, offset)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks[size].row[slot // per_anchor]), pa.array((slot % per_anchor + 1).astype(np.int32)),
                 pa.array(key, mask=nameless), *scores],
                names=["row", "place", "id", "score", "exact"][:3 + len(scores)])


def _positives(batches: Iterator[pa.RecordBatch], blocks: dict[int, Block], k: int, scale: int, offset: int | None) -> Iterator[pa.RecordBatch]:
    best: dict[int, Top] = {}
    for block, row, key, nameless, label, x in _meetings(batches, blocks, scale):
        packing = block.packing
        if packing.length not in best:
            lowest = -packing.length * packing.bias**2
            best[packing.length] = Top(k, np.full(len(block.row), lowest, dtype=packing.score_type))
        top = best[packing.length]
        for code in np.unique(label[label >= 0]).tolist():
            mine = np.flatnonzero(label == code)
            theirs = np.flatnonzero(block.label == code)
            packed = packing.packed(x[mine])
            for s in range(0, len(theirs), ANCHORS):
                anchors = theirs[s:s + ANCHORS]
                score = packing.scores(block.whole[anchors], x[mine], packed)
                good = (score >= top.least[anchors][:, None]).astype(bool)
                _, i, j = np.intersect1d(block.row[anchors], row[mine], return_indices=True)
                good[i, j] = False  # an anchor is no positive of its own
                i, j = np.nonzero(good)
                top.add(anchors[i], score[i, j], key[mine[j]], nameless[mine[j]])
        top.settle()
    yield from _out(best, blocks, 1, offset)


def _negatives(batches: Iterator[pa.RecordBatch], blocks: dict[int, Block], given: dict[int, tuple], places: int, k: int,
               low: int, high: int, scale: int, offset: int | None) -> Iterator[pa.RecordBatch]:
    """``given``: by length, whether each (anchor, place) has a positive, and its score."""
    best: dict[int, Top] = {}
    ends: dict[int, np.ndarray] = {}
    for block, _, key, nameless, label, x in _meetings(batches, blocks, scale):
        packing = block.packing
        there, positive = given[packing.length]
        if packing.length not in best:
            best[packing.length] = Top(k, -((-low * positive) // 100))
            ends[packing.length] = (high * positive) // 100
        top, most = best[packing.length], ends[packing.length]
        packed = packing.packed(x)
        for s in range(0, len(block.row), ANCHORS):
            anchors = np.arange(s, min(s + ANCHORS, len(block.row)))
            score = packing.scores(block.whole[anchors], x, packed)
            other = block.label[anchors][:, None] != label[None, :]
            for place in range(places):
                slot = anchors * places + place
                good = other & (score >= top.least[slot][:, None]).astype(bool)
                good &= (score <= most[slot][:, None]).astype(bool) & there[slot][:, None]
                i, j = np.nonzero(good)
                top.add(slot[i], score[i, j], key[j], nameless[j])
        top.settle()
    yield from _out(best, blocks, places, offset)


def _best(found: DataFrame, k: int, name: str, wide: bool, by: list[str]) -> DataFrame:
    """The first ``k`` of each group over all tasks, numbered from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("exact" if wide else "score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def hard_negatives(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                   anchor: Column | None = None, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hard negatives of each anchor and positive.

    A component x counts as floor(scale * x); the score of two rows of equal length is the
    inner product, exact at any size. Anchors are the rows for which ``anchor`` holds (default: key divisible
    by 50). Positives of an anchor are its first ``positives`` other rows of the same label,
    higher scores first, then smaller keys. For each of them the first ``negatives`` rows of
    another label follow for which ``low * positive_score <= 100 * score <= high * positive_score``.

    Returns ``anchor_id, positive_id, rank`` (from 1), ``negative_id, positive_score,
    negative_score``; a score beyond a long is null, its order still exact. Rows with a null
    label or vector, or a component that is null or non-finite, or not finite once scaled, take
    no part. Rows that repeat a key, copies too, are rows of their own; a null key is no anchor
    and comes last among equal scores. Rows of different lengths never meet. No anchor, or an empty table, gives no row.
    Other columns are ignored. The key is a whole number; a label may be of any type that a
    string tells apart.
    """
    spark = rows.sparkSession
    wide = F.col(vector).cast("array<double>")
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * float(scale)) == float("inf")))
    chosen = F.col(key) % 50 == 0 if anchor is None else anchor
    stored = durable(rows.select(
        F.col(key).cast("bigint").alias("_id"), (F.col(label) if isinstance(label, str) else label).cast("string").alias("_label"),
        F.col(vector).alias("_vector"), F.coalesce(chosen, F.lit(False)).alias("_anchor"),
        bad.alias("_bad")).where("_label is not null and _vector is not null and not _bad").drop("_bad")
        .withColumn("_row", F.monotonically_increasing_id()))
    about = stored.agg(
        F.max(F.array_max(F.transform(F.col("_vector").cast("array<double>"), F.abs))).alias("largest"),
        F.max(F.size("_vector")).alias("length"), F.sum(F.col("_anchor").cast("int")).alias("anchors")).first()
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not about["anchors"]:
        return spark.createDataFrame([], out)
    bias = int(np.ceil((about["largest"] or 0.0) * scale))
    most = about["length"] * bias**2
    offset = most if most >= 2**62 else None
    scheme = "row bigint, place int, id bigint, score bigint" + (", exact string" if offset else "")
    parts = -(-about["anchors"] * (about["length"] * 8 + 64) // block_bytes)

    found = None
    anchors = stored.where("_anchor").withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)))
    for part in range(parts):
        mine = anchors.where(F.col("_part") == part).select("_row", "_id", "_label", "_vector").toArrow()
        sizes = pc.list_value_length(mine["_vector"]).to_numpy()
        blocks = {size: Block(mine.take(pa.array(np.flatnonzero(sizes == size))), Packing(size, bias), scale)
                  for size in np.unique(sizes).tolist()}
        sent = spark.sparkContext.broadcast(blocks)
        near = stored.mapInArrow(lambda b, s=sent: _positives(b, s.value, positives, scale, offset), scheme)
        near = durable(_best(near.drop("place"), positives, "place", offset is not None, ["row"]))
        # At most `positives` rows per anchor of the block.
        known, given = near.select("row", "place", "exact" if offset else "score").toArrow(), {}
        for size, block in blocks.items():
            there = np.zeros(len(block.row) * positives, dtype=bool)
            score = np.zeros(len(there), dtype=block.packing.score_type)
            at = np.searchsorted(block.row, known["row"].to_numpy())
            own = block.row[np.minimum(at, len(block.row) - 1)] == known["row"].to_numpy()
            slot = at[own] * positives + known["place"].to_numpy()[own] - 1
            there[slot] = True
            values = known.column(2).filter(pa.array(own)).to_pylist()
            score[slot] = [int(v, 16) - offset for v in values] if offset else values
            given[size] = (there, score)
        told = spark.sparkContext.broadcast(given)
        far = stored.mapInArrow(lambda b, s=sent, g=told: _negatives(
            b, s.value, g.value, positives, negatives, low, high, scale, offset), scheme)
        far = _best(far, negatives, "rank", offset is not None, ["row", "place"]).select(
            "row", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        names = anchors.where(F.col("_part") == part).select(F.col("_row").alias("row"), F.col("_id").alias("anchor_id"))
        # Both have a bounded number of rows: the block's anchors and their positives.
        done = durable(far.join(F.broadcast(near.select(
            "row", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))), ["row", "place"])
            .join(F.broadcast(names), "row").select(
                "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
        found = done if found is None else found.unionByName(done)
    return found


def op12_hard_negatives(spark, sf_dir):
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=changed)


OP12_SQL = """
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS MATERIALIZED (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.rid <> b.rid AND len(a.v) = len(b.v)),
p AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM s WHERE same QUALIFY place <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY p.rid, place ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.rid = n.rid AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
