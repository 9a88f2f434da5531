"""Leaf-wise gradient boosting of decision trees for a 0/1 label.

Columns are cut into bins once. A tree grows best first: of all open leaves the one whose best
split gains most is split next, up to ``leaves`` leaves. What a leaf gains depends on nothing
but its own rows, so the leaves of a level are worked out together, one pass over the rows for
each level, and the order of the splits, hence which of them fit the limit, is settled
afterwards.

In a pass every task sums gradients and hessians per node, column and bin, and only those
sums, a number that follows from the settings and not from the rows, come to the driver. Just
the smaller child of a split is summed; its sibling is the difference to their
parent. Gradients are whole numbers of 2^-20, so the sums do not depend on any order and the
same rows always grow the same trees. Columns of few bins share a code (``Codes``): one count over it
serves them all, and its margins are the sums of each. Rows lie side by side in blocks with their codes
and their margin, kept between passes; a lost block is worked out again from the stored bins or from the last
checkpoint of the margins, which are written every few trees.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.trees import NODES, TreeEnsemble
from riskloom.session import durable, shared_dir

_UNIT = 1 << 20
_WIDTH = 256
#: Rows worked through together, few enough for a processor's cache.
_BLOCK_ROWS = 1 << 16
#: Rows of a partition beyond which there are more partitions than slots.
_PART_ROWS = 1 << 23
#: A smaller gain is rounding.
_LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class Settings:
    # The settings of the training job.
    rounds: int = 200
    depth: int = 5
    leaves: int = 31
    step: float = 0.1
    bins: int = 255
    least_rows: int = 20
    least_hessian: float = 1e-3
    penalty: float = 0.0
    #: Trees after which margins are written anew.
    margin_every: int = 10
    #: Whether leaves weigh rows by the second derivative of the loss, and margins start at the log-odds of
    #: the labels. Without it trees are fitted to the residuals, leaves are weighted means of these, and
    #: margins start at 0 with a tree of ``first_step``.
    second_order: bool = True
    first_step: float | None = None


# Bins

def bin_edges(rows: DataFrame, inputs: list[str], bins: int) -> list[np.ndarray]:
    """Upper ends of the bins of each column but the last, values that occur in it."""
    shares = [i / bins for i in range(1, bins)]
    cut = rows.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), shares).alias(c)
                     for c in inputs]).first()
    return [np.unique(np.array(cut[c] or [], dtype=np.float64)) for c in inputs]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of each cell; a missing value lies in the last one."""
    return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)


@dataclass(frozen=True)
class Codes:
    """Columns put together to codes of one byte: ``place`` has the code of each column, how much a bin of it
    counts there, and its number of bins; ``sizes`` the number of values of each code."""

    place: list[tuple[int, int, int]]
    sizes: list[int]

    @staticmethod
    def of(edges: list[np.ndarray]) -> Codes:
        """Every column goes to the first code that has room for it."""
        place, sizes = [], []
        for bins in (len(e) + 1 for e in edges):
            code = next((i for i, size in enumerate(sizes) if size * bins <= _WIDTH), len(sizes))
            if code == len(sizes):
                sizes.append(1)
            place.append((code, sizes[code], bins))
            sizes[code] *= bins
        return Codes(place, sizes)

    def joined(self, bins: np.ndarray) -> np.ndarray:
        """(codes, rows) from (rows, columns)."""
        out = np.zeros((len(self.sizes), len(bins)), dtype=np.uint8)
        for column, (code, step, _) in enumerate(self.place):
            out[code] += bins[:, column] * np.uint8(step)
        return out

    def above(self, column: int, cut: int) -> tuple[int, np.ndarray]:
        """The code of a column, and which of its values lie above a bin."""
        code, step, bins = self.place[column]
        return code, np.arange(_WIDTH) // step % bins > cut

    def by_column(self, sums: np.ndarray) -> np.ndarray:
        """(..., columns, bins) from sums (..., codes, values)."""
        out = np.zeros((*sums.shape[:-2], len(self.place), _WIDTH), dtype=sums.dtype)
        for column, (code, step, bins) in enumerate(self.place):
            cells = sums[..., code, :self.sizes[code]]
            out[..., column, :bins] = cells.reshape(*cells.shape[:-1], -1, bins, step).sum(axis=(-3, -1))
        return out


@dataclass
class _Block:
    """Rows side by side: codes, margins, and of each row label and weight as a place in a list of weights, twice plus label."""

    codes: np.ndarray
    kind: np.ndarray
    weights: np.ndarray
    margin: np.ndarray

    def gradients(self, rows: np.ndarray | None, second_order: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of some rows, or of all."""
        kind, margin = _of(self.kind, rows), _of(self.margin, rows)
        return gradients(margin, kind & 1, self.weights.take(kind >> 1), second_order)


def _of(values: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
    return values if rows is None else values.take(rows)


def _bin_rows(batches: Iterator[pa.RecordBatch], edges: list[np.ndarray], codes: Codes) -> Iterator[pa.RecordBatch]:
    """One row for each batch: its codes one after the other, its labels and its weights as bytes."""
    for batch in batches:
        if batch.num_rows:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[2:]], axis=1)
            parts = [codes.joined(binned(x, edges)), *(batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["bins", "label", "weight"])


def _blocks(parts: Iterator, codes: int, margin: float) -> Iterator[_Block]:
    """Stored batches as blocks of bounded size."""
    held, size = [], 0

    def joined() -> _Block:
        weights, kind = np.unique(np.concatenate([w for *_, w in held]), return_inverse=True)
        kind = (2 * kind + np.concatenate([label for _, label, _ in held]).astype(np.int64)).astype(np.min_scalar_type(2 * len(weights)))
        return _Block(np.concatenate([c for c, *_ in held], axis=1), kind, weights, np.full(len(kind), margin))

    for bins, label, weight in parts:
        held.append((np.frombuffer(bins, np.uint8).reshape(codes, -1), np.frombuffer(label), np.frombuffer(weight)))
        size += len(held[-1][1])
        if size >= _BLOCK_ROWS:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


# Trees over bins

@dataclass
class BinTree:
    """Nodes as columns: feature (-1 at a leaf), last bin that goes below, children, value, rows."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    below: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)

    def add(self, value: float = 0.0, rows: int = 0) -> int:
        for column, v in ((self.feature, -1), (self.cut, 0), (self.below, -1), (self.above, -1), (self.value, value), (self.rows, rows)):
            column.append(v)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, below: int, above: int) -> None:
        self.feature[node], self.cut[node], self.below[node], self.above[node] = feature, cut, below, above

    def rows_of(self, wanted: list[int], block: _Block, codes: Codes) -> Iterator[tuple[int, np.ndarray | None]]:
        """The rows of each wanted node that has some; of the root None, which stands for all."""
        wanted, above_of = set(wanted), {c: (n, side) for n in range(len(self.feature)) for side, c in enumerate((self.below[n], self.above[n]))}
        needed = set(wanted)
        for node in wanted:
            while node:
                node = above_of[node][0]
                needed.add(node)
        waiting: list[tuple[int, np.ndarray | None]] = [(0, None)]
        while waiting:
            node, rows = waiting.pop()
            if node in wanted:
                yield node, rows
            sides = [c in needed for c in (self.below[node], self.above[node])]
            if any(sides):
                code, goes = codes.above(self.feature[node], self.cut[node])
                up = goes.take(_of(block.codes[code], rows))
                for child, side in ((self.below[node], ~up), (self.above[node], up)):
                    if child in needed:
                        mine = np.flatnonzero(side) if rows is None else rows.compress(side)
                        if len(mine):
                            waiting.append((child, mine))

def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, second_order: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the log loss, in whole units; without ``second_order`` the weight for the latter."""
    p = 1 / (1 + np.exp(-margin))
    curve = weight * p * (1 - p) if second_order else weight
    return np.rint(weight * (p - label) * _UNIT), np.rint(curve * _UNIT)


def _sums(blocks: Iterator[_Block], tree: BinTree, build: list[int], codes: Codes, second_order: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """Cells with rows (by node to build, code and its value), and their rows, gradients and hessians."""
    total = np.zeros((3, len(build), len(codes.sizes), _WIDTH))
    slot = {node: i for i, node in enumerate(build)}
    for block in blocks:
        for node, rows in tree.rows_of(build, block, codes):
            g, h = block.gradients(rows, second_order)
            for code, values in enumerate(block.codes):
                mine = _of(values, rows).astype(np.intp)
                for i, v in enumerate((None, g, h)):
                    total[i, slot[node], code] += np.bincount(mine, v, _WIDTH)
    flat = total.reshape(3, -1)
    cell = np.flatnonzero(flat[0])
    if len(cell):
        yield (cell.astype(np.int32), *flat[:, cell].astype(np.int64))


def _moved(block: _Block, tree: BinTree, codes: Codes) -> _Block:
    margin = block.margin.copy()
    for leaf, rows in tree.rows_of([n for n, f in enumerate(tree.feature) if f < 0], block, codes):
        margin[slice(None) if rows is None else rows] += tree.value[leaf]
    return replace(block, margin=margin)


# Growing

@dataclass
class _Open:
    """A node of a growing tree with the sums over its rows: (columns, bins, 3)."""

    sums: np.ndarray | None
    n: int
    g: int
    h: int
    depth: int
    gain: float = 0.0
    split: tuple[int, int] | None = None
    children: tuple[int, int] | None = None


def best_split(sums: np.ndarray, s: Settings) -> tuple[float, int, int, np.ndarray]:
    """(gain, column, last bin below, sums below) of the best split; the gain is 0 where there is none.
    Ties go to the first column and bin."""
    below = sums.cumsum(axis=1)
    all_ = below[:, -1:, :]
    above = all_ - below

    def score(part):
        g, h = part[..., 1] / _UNIT, part[..., 2] / _UNIT
        return g * g / np.maximum(h + s.penalty, 1e-300)

    allowed = np.ones(below.shape[:2], dtype=bool)
    for part in (below, above):
        allowed &= (part[..., 0] >= s.least_rows) & (part[..., 2] / _UNIT >= s.least_hessian)
    gain = np.where(allowed, score(below) + score(above) - score(all_), 0.0)
    column, last = np.unravel_index(int(gain.argmax()), gain.shape)
    return float(gain[column, last]), int(column), int(last), below[column, last]


class _Grower:
    """One tree, level by level; ``sums_of`` makes one pass for the nodes it is given."""

    def __init__(self, settings: Settings, sums_of) -> None:
        self.s, self.sums_of = settings, sums_of

    def grow(self) -> BinTree:
        tree = BinTree()
        root = tree.add()
        sums = self.sums_of(tree, [root])[root]
        n, g, h = (int(v) for v in sums[0].sum(axis=0))
        nodes = [_Open(sums, n, g, h, 0)]
        level = [root]
        for depth in range(self.s.depth):
            nxt, build, parents = [], [], {}
            for node in level:
                o = nodes[node]
                if o.sums is None:
                    continue
                gain, column, last, below = best_split(o.sums, self.s)
                if gain <= _LEAST_GAIN:
                    continue
                o.gain, o.split = gain, (column, last)
                pair = []
                for n, g, h in (below, np.array([o.n, o.g, o.h]) - below):
                    pair.append(tree.add())
                    nodes.append(_Open(None, int(n), int(g), int(h), depth + 1))
                o.children = tuple(pair)
                tree.split(node, column, last, *pair)
                nxt += pair
                # A node of fewer rows than two leaves need is not split any more.
                if depth + 1 < self.s.depth and max(nodes[c].n for c in pair) >= 2 * self.s.least_rows:
                    small = min(pair, key=lambda c: (nodes[c].n, c))
                    build.append(small)
                    parents[small] = (node, pair[0] + pair[1] - small)
            found = self.sums_of(tree, build) if build else {}
            for small, (parent, large) in parents.items():
                nodes[small].sums = found[small]
                nodes[large].sums = nodes[parent].sums - found[small]
            for node in level:
                nodes[node].sums = None
            level = nxt
        return self._best_first(nodes)

    def _best_first(self, nodes: list[_Open]) -> BinTree:
        """The splits in the order of their gains, as long as leaves are left."""
        def leaf(o: _Open) -> int:
            h = o.h / _UNIT + self.s.penalty
            return out.add(-self.s.step * (o.g / _UNIT) / h if h > 0 else 0.0, o.n)

        out = BinTree()
        waiting = [(-nodes[0].gain, 0, leaf(nodes[0]))]
        leaves = 1
        while waiting and leaves < self.s.leaves:
            gain, node, place = heapq.heappop(waiting)
            if gain >= 0:
                break
            o = nodes[node]
            places = [leaf(nodes[c]) for c in o.children]
            out.split(place, *o.split, *places)
            for c, p in zip(o.children, places):
                heapq.heappush(waiting, (-nodes[c].gain, c, p))
            leaves += 1
        return out


def ensemble(trees: list[BinTree], edges: list[np.ndarray], inputs: list[str], base: float) -> TreeEnsemble:
    """The trees over the columns' own values. A last bin has no end, so nothing lies above it."""
    rows = []
    for t, tree in enumerate(trees):
        for node in range(len(tree.feature)):
            f = tree.feature[node]
            cut = float(edges[f][tree.cut[node]]) if f >= 0 else 0.0
            rows.append((t, node, f, cut, tree.below[node], tree.above[node], tree.value[node], float(tree.rows[node])))
    return TreeEnsemble(pd.DataFrame(rows, columns=NODES), list(inputs), base)


def train_leafwise(train: DataFrame, inputs: list[str], label: str, weight: str, settings: Settings = Settings()) -> TreeEnsemble:
    """Boosted trees over ``inputs``; the raw prediction is the log-odds of label 1.

    Rows without a label don't count. Without rows of both labels there is nothing to learn:
    the ensemble is a constant.
    """
    rows = train.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("label"), F.col(weight).cast("double").alias("weight"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)])
    positive, everything, count = rows.agg(F.sum(F.col("weight") * F.col("label")), F.sum("weight"), F.count("*")).first()
    if not everything or not 0 < positive < everything:
        base = 0.0 if not everything else 20.0 if positive else -20.0
        return TreeEnsemble(pd.DataFrame([], columns=NODES), list(inputs), base)
    base = float(np.log(positive / (everything - positive))) if settings.second_order else 0.0
    edges = bin_edges(rows, [f"x{i}" for i in range(len(inputs))], settings.bins)
    codes = Codes.of(edges)
    table = durable(rows.mapInArrow(lambda b: _bin_rows(b, edges, codes), "bins binary, label binary, weight binary"))
    sc = train.sparkSession.sparkContext
    shared_dir(train.sparkSession)  # names the folder of checkpoints
    # A partition answers each pass with one set of sums and costs a task each time, so there are no more of them than slots
    # keep busy, all of one size, and few rows have few.
    stored = table.repartition(max(min(sc.defaultParallelism, -(-count // _BLOCK_ROWS)), count // _PART_ROWS)).rdd
    state = stored.mapPartitions(lambda parts: _blocks(parts, len(codes.sizes), base)).persist(StorageLevel.MEMORY_AND_DISK)
    before = None
    trees: list[BinTree] = []

    def sums_of(tree: BinTree, build: list[int]) -> dict[int, np.ndarray]:
        out = np.zeros((3, len(build) * len(codes.sizes) * _WIDTH), dtype=np.int64)
        for cell, *sums in state.mapPartitions(lambda blocks: _sums(blocks, tree, build, codes, settings.second_order)).collect():
            out[:, cell] += sums
        return dict(zip(build, np.moveaxis(codes.by_column(out.reshape(3, len(build), -1, _WIDTH)), 0, -1)))

    for number in range(1, settings.rounds + 1):
        step = settings.first_step if number == 1 and settings.first_step else settings.step
        tree = _Grower(replace(settings, step=step), sums_of).grow()
        trees.append(tree)
        if before is not None:
            before.unpersist()
            before = None
        if len(tree.feature) == 1 and not tree.value[0]:
            break  # nothing is left to learn
        if number == settings.rounds:
            break
        # The next tree's first pass moves the margins; the blocks before are kept until then.
        before, state = state, state.map(partial(_moved, tree=tree, codes=codes)).persist(StorageLevel.MEMORY_AND_DISK)
        if number % settings.margin_every == 0:
            state.checkpoint()
    for kept in (before, state):
        if kept is not None:
            kept.unpersist()
    return ensemble(trees, edges, inputs, base)
